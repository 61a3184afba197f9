"""Byte-level BPE encoding and decoding by tree concatenation.

A long text is cut into pieces that different tasks encode; neighbouring pieces
are then concatenated pairwise up a tree.  Cuts fall behind a pre-token that
ends in no white space wherever one ends in the piece, and such halves join as
they are.  Text without such a place for a whole piece (one very long pre-token)
is cut inside: at that join the tokens on both sides are re-encoded in a window
that grows until its first token is the left side's and its last the right
side's, at the places where they stood.  BPE tokens are a text's encoding
exactly when each pair of neighbours is the encoding of its own two; all pairs
outside the window stand as they stood, so the joined ids are exact.

Inside a piece merges never cross pre-tokens, so distinct pre-tokens are encoded
once by each worker, many as one text, and kept in a table bounded in entries.
A text with a special token's string, and any text of a tokenizer that isn't
plain byte-level BPE with the usual pre-token pattern, is encoded as it is.

Defined results: a null text counts as empty; an empty text has no ids; null
ids stay; repeated rows get a row each; a text of any length is encoded whole;
strings of special tokens become these tokens, as the library does by default;
an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import python_tasks

#: Characters of a piece, above which a text is cut; tokens on either side of a join re-encoded at first.
PIECE, WINDOW = 1 << 15, 16
#: Entries after which a worker's table starts anew, characters up to which a pre-token is kept, and of texts encoded at once.
TABLE_ENTRIES, KEPT_CHARS, RUN_CHARS = 800_000, 64, 1 << 19
#: Pre-tokens encoded as one text.
JOINED = 256
#: Fixed: the pre-tokens of the usual byte-level pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pre-tokens for texts of common characters alone, without any of those of the second pattern.
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_COMMON = re.compile(rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")
_RARE = re.compile(rf"[^\x20-\x7e\n\t\r{_LETTERS}\u2010-\u2027\u2030-\u205e]")
_workers: dict[str, ByteTable] = {}


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTable:
    """A byte-level BPE tokenizer, the ids of pre-tokens it has met, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.plain = self._plain(spec)
        self.pattern = regex.compile(PRE_TOKEN)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = _bytes_of_letters()
        self.surface: dict[int, bytes] = {}
        if self.plain:
            for piece, i in self.tok.get_vocab(with_added_tokens=False).items():
                self.surface[i] = bytes(letters[c] for c in piece)
            self.surface |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
            self.lengths = np.zeros(max(self.surface) + 1, np.int64)
            for i, b in self.surface.items():
                self.lengths[i] = len(b)
        self.table: dict[str, bytes] = {}

    @staticmethod
    def _plain(spec: dict) -> bool:
        """No normaliser; the usual pre-tokens; merges by rank; special tokens match as they are and hold no blank."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                and (spec.get("decoder") or {}).get("type") == "ByteLevel" and model["type"] == "BPE"
                and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or not t["special"]
                            or re.search(r"\s", t["content"]) for t in spec["added_tokens"]))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as 32-bit numbers."""
        if not self.plain:
            return self._encode(texts)
        cut = [None if any(x in t for x in self.special) else (self.pattern if _RARE.search(t) else _COMMON).findall(t) for t in texts]
        # this call's pre-tokens in a table of their own, small enough to stay in the processor's cache
        distinct = list(set().union(*[c for c in cut if c is not None]))
        known = dict(zip(distinct, map(self.table.get, distinct)))
        found = self._learn([c for c, ids in known.items() if ids is None])
        known.update(found)
        if len(self.table) + len(found) > TABLE_ENTRIES:
            self.table = {}
        self.table.update((c, ids) for c, ids in found.items() if len(c) <= KEPT_CHARS)
        get = known.__getitem__
        return [b"".join(map(get, c)) if c is not None else self._encode([t])[0] for t, c in zip(texts, cut)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens that the table lacks.  Those that start with a blank, and others with a line
        feed between, are the pre-tokens of one text too, so many are encoded at once."""
        blank = [w for w in new if w[0] == " " and not w[-1].isspace()]
        plain = [w for w in new if not w[0].isspace() and not w[-1].isspace()]
        other = [w for w in new if w[-1].isspace() or w[0].isspace() and w[0] != " "]
        got = dict(zip(other, self._encode(other)))
        for words, mark in ((blank, ""), (plain, "\n")):
            groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
            for group, ids in zip(groups, self._encode([mark.join(g) for g in groups])):
                at = np.cumsum(self.lengths[np.frombuffer(ids, np.uint32)])
                size = np.array([len(w.encode()) for w in group])
                ends = np.cumsum(size + len(mark)) - len(mark)
                last = (4 * (np.searchsorted(at, ends) + 1)).tolist()
                first = (4 * np.searchsorted(at, ends - size, "right")).tolist()
                got.update((w, ids[a:z]) for w, a, z in zip(group, first, last))
        return got

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8."""
        if not self.plain:
            return self.tok.decode(np.frombuffer(ids, np.uint32).tolist(), skip_special_tokens=False).encode()
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()

    def pieces(self, text: str, size: int = PIECE) -> list[tuple[str, int, int]]:
        """(piece, bytes before, bytes after): consecutive pieces of a text.  Where a cut lies inside a
        pre-token, the bytes that this has before and after the cut, else 0."""
        if not self.plain or len(text) <= size:
            return [(text, 0, 0)]
        out, start, safe, before, after = [], 0, 0, 0, 0

        def cut(at: int) -> None:
            nonlocal start
            out.append((text[start:at], before, after))
            start = at

        at = 0
        for part in self.cut_special.split(text) if self.cut_special else [text]:
            ends = [len(part)] if part in self.special else (m.end() for m in self.pattern.finditer(part))
            base = at
            for end in ends:
                end += base
                if end - start > size and safe > start:
                    cut(safe)
                    before, after = 0, 0
                # a pre-token that no piece can hold is cut inside; what stays of it has two characters at least
                if end - start > size and end - at > size and part not in self.special:
                    for c in range(max(start, at) + size, end - 1, size):
                        cut(c)
                        before, after = len(text[at:c].encode()), len(text[c:end].encode())
                at = end
                if not text[end - 1].isspace():
                    safe = end
        cut(len(text))
        return out

    def join(self, left: np.ndarray, right: np.ndarray, before: int, after: int) -> np.ndarray:
        """Ids of two halves' text.  ``before`` and ``after``: bytes of the pre-token that the cut
        divides; 0 where it stands between pre-tokens."""
        if not before or not len(left) or not len(right):
            return np.concatenate([left, right])
        a = b = WINDOW
        while True:
            a, left_ends = self._edge(left[::-1], a, before, True)
            b, right_ends = self._edge(right, b, after, False)
            window = np.concatenate([left[len(left) - a:], right[:b]])
            new = np.frombuffer(self._encode([b"".join(map(self.surface.__getitem__, window.tolist())).decode()])[0], np.uint32)
            agree_left, agree_right = left_ends or new[0] == window[0], right_ends or new[-1] == window[-1]
            if agree_left and agree_right:
                return np.concatenate([left[:len(left) - a], new, right[b:]])
            a, b = a if agree_left else 2 * a, b if agree_right else 2 * b

    def _edge(self, ids: np.ndarray, n: int, limit: int, backward: bool) -> tuple[int, bool]:
        """At least ``n`` tokens away from the join, up to a whole character; True if the pre-token or the side ends there."""
        while True:
            total = np.cumsum(self.lengths[ids[:n]])
            inside = int(np.searchsorted(total, limit, "left")) + 1
            if inside <= n or n >= len(ids):
                return min(inside, len(ids)), True
            # the byte behind the edge must start a character
            first = self.surface[int(ids[n - 1])] if backward else self.surface[int(ids[n])]
            if not 0x80 <= first[0] < 0xC0:
                return n, False
            n += 1

    def concatenate(self, parts: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        """Ids of a text from those of its (ids, bytes before, bytes after) pieces, pair by pair up a tree."""
        while len(parts) > 1:
            pairs = [(self.join(l[0], r[0], *r[1:]), *l[1:]) for l, r in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2:]
        return parts[0][0]


def _worker(path: str) -> ByteTable:
    if path not in _workers:
        _workers[path] = ByteTable(path)
    return _workers[path]


def _runs(texts: list[str]) -> Iterator[list[str]]:
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= RUN_CHARS:
            yield run
            run, n = [], 0
    if run:
        yield run


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, piece: int = PIECE) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row.  Texts up to ``piece`` characters
    are encoded where they are read.  The pieces of longer ones are dealt to all tasks, and their ids
    meet again by id and digest of the text; rows that repeat both are given out as often."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    id_type = rows.schema["__id"].dataType.simpleString()
    arrow_id = pa.schema([("x", _arrow(rows))]).field("x").type
    out_schema = f"__id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def result(keys: pa.Array, found: list[bytes], table: ByteTable) -> pa.RecordBatch:
        out = {"__id": keys, "n_tokens": pa.array([len(x) // 4 for x in found], pa.int64()),
               "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()),
               "decoded_sha256": pa.array([hashlib.sha256(table.decode(x)).hexdigest() for x in found], pa.string())}
        if ids:
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]), pa.int32())
            out["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), np.int32)))
        return pa.record_batch(list(out.values()), list(out))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(tokenizer)
        for b in batches:
            at = 0
            for some in _runs(b.column(1).to_pylist()):
                yield result(b.column(0).slice(at, len(some)), table.encode(some), table)
                at += len(some)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(tokenizer)
        for b in batches:
            for i, text in enumerate(b.column(1).to_pylist()):
                parts, digest = table.pieces(text, piece), hashlib.sha256(text.encode()).digest()
                n = len(parts)
                yield pa.record_batch([pa.concat_arrays([b.column(0).slice(i, 1)] * n), pa.array([digest] * n), pa.array(range(n), pa.int32()),
                                       *[pa.array(c) for c in zip(*parts)]], ["__id", "digest", "part", "text", "before", "after"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(tokenizer)
        for b in batches:
            at = 0
            for some in _runs(b.column(3).to_pylist()):
                kept = b.slice(at, len(some))
                yield pa.record_batch([*kept.columns[:3], pa.array(table.encode(some), pa.binary()), *kept.columns[4:]],
                                      ["__id", "digest", "part", "ids", "before", "after"])
                at += len(some)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted pieces; a part that repeats belongs to a row that repeats."""
        table, at, parts, times = _worker(tokenizer), None, [], 0

        def done() -> pa.RecordBatch:
            return result(pa.array([at[0]] * times, arrow_id), [table.concatenate(parts).tobytes()] * times, table)

        for b in batches:
            for key, digest, part, found, before, after in zip(*[c.to_pylist() for c in b.columns]):
                if at != (key, digest):
                    if at:
                        yield done()
                    at, parts, times = (key, digest), [], 0
                if part == 0:
                    times += 1
                if part == len(parts):
                    parts.append((np.frombuffer(found, np.uint32), before, after))
        if at:
            yield done()

    long = F.char_length("__text") > piece
    cuts = rows.filter(long).mapInArrow(cut, f"__id {id_type}, digest binary, part int, text string, before long, after long")
    dealt = cuts.repartition("__id", "digest", "part").mapInArrow(pieces, f"__id {id_type}, digest binary, part int, ids binary, before long, after long")
    met = dealt.repartition("__id", "digest").sortWithinPartitions("__id", "digest", "part").mapInArrow(joined, out_schema)
    return rows.filter(~long).mapInArrow(whole, out_schema).unionByName(met).withColumnRenamed("__id", id_col)


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["__id"].dataType)


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows with id arrays; null ids decode to the empty text."""
    rows = encoded.select(F.col(id_col).alias("__id"), F.col(ids_col).cast("array<int>").alias("__ids"))
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(tokenizer)
        for b in batches:
            texts = [table.decode(np.array(x or [], np.uint32).tobytes()).decode() for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], ["__id", "text"])

    return rows.mapInArrow(run, f"__id {id_type}, text string").withColumnRenamed("__id", id_col)
