"""Token files: a concatenated id array with Elias-Fano document boundaries.

File layout (little-endian): the ids as unsigned 16- or 32-bit numbers, the
Elias-Fano sections of the n + 1 document boundaries, those of the n document
keys, a JSON footer, its length (8 bytes) and the magic ``TLEF0001``.  An
Elias-Fano section holds the low bits packed, the high bits in unary, and the
bit position of every 256th one as the select structure.

Writing range-partitions the rows by (id, text hash), so ties of one id spread
too, and every task streams one file to shared storage under a name of its
task attempt; the stored manifest names the files of the successful attempts
only, so lost executors and repeated attempts leave no wrong file in use.
Reading deals blocks of documents of each file to tasks, which find them with
select.

Defined results: null text is empty and has the end id only; null ids come
first (as in Spark's order) and are read back as null; repeated ids are
documents of their own, ordered by their text's hash; an empty table writes
no file and reads back no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import python_tasks, partitions, scratch, store

MAGIC = b"TLEF0001"
SAMPLE = 256
#: Documents read back by one task at a time.
BLOCK = 4096
#: Ids of several documents read from a file at once; a longer document is read whole.
READ_IDS = 1 << 20
#: Characters that may stand on either side of a word without a merge or an apostrophe's suffix across.
_PUNCT = ".,!?;:%&*$#-|()"
#: Control characters that Python's split() takes for blanks and the tokenizer does not.
_CONTROL = re.compile("[\x1c-\x1f]")
#: Signs that end a word, all of them behind a letter or digit and before a blank: a pre-token of their own.
_ENDING = re.compile(r"[.,!?;:%&*#$](?<=[a-z0-9\xdf-\xf6\xf8-\xff].)[.,!?;:%&*#$]*(?=\s)")
#: Letters beyond Latin-1, whose case and composition are left to the tokenizer.
_WIDE = re.compile("[^\x00-\xff]")
TABLE_ENTRIES, WORD_CHARS = 1_000_000, 64
#: Words of letters that are encoded as one text, and characters of texts encoded at once.
JOINED, RUN_CHARS = 256, 1 << 18


class EliasFano:
    """A sorted sequence of n numbers up to u in about n * (2 + log2(u / n)) bits."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.l, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        u = int(values[-1]) if n else 0
        l = max(0, (u // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(l)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        low = np.zeros((n, l), np.uint8)
        for k in range(l):
            low[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        # samples are offsets of ones above 256 * their number, so 32 bits do for 4e9 high bits
        return cls(n, l, np.packbits(low.reshape(-1), bitorder="little"), np.packbits(bits, bitorder="little"),
                   ones[::SAMPLE].astype(np.uint32 if not n or ones[-1] < 1 << 32 else np.uint64))

    def range(self, first: int, last: int) -> np.ndarray:
        """Numbers first..last-1: select of the first one, then a scan of the bits up to the last."""
        first, last = max(first, 0), min(last, self.n)
        if first >= last:
            return np.zeros(0, np.int64)
        block, end = first // SAMPLE, -(-last // SAMPLE)
        start = int(self.samples[block])
        stop = int(self.samples[end]) if end < len(self.samples) else len(self.high) * 8
        base = start // 8 * 8
        bits = np.unpackbits(self.high[base // 8:-(-stop // 8)], bitorder="little")
        bits[:start - base] = 0
        ones = np.flatnonzero(bits)[first - block * SAMPLE:last - block * SAMPLE].astype(np.int64) + base
        high = ones - np.arange(first, last)
        if not self.l:
            return high
        a, b = first * self.l, last * self.l
        low = np.unpackbits(self.low[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].reshape(-1, self.l)
        return (high << self.l) | (low.astype(np.int64) << np.arange(self.l)).sum(1)

    def select(self, i: int) -> int:
        return int(self.range(i, i + 1)[0])

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high, self.samples]


def _open(path: str):
    """A file system of pyarrow and the path in it, for any store it knows."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")


class WordTable:
    """Ids of distinct words of a tokenizer that drops white space, each encoded once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.by_word = self._drops_blanks(json.loads(self.tok.to_str()))
        self.added = [t["content"].lower() for t in json.loads(self.tok.to_str())["added_tokens"]]
        self.words: dict[str, bytes] = {}
        self.ends: np.ndarray | None = None

    @staticmethod
    def _drops_blanks(spec: dict) -> bool:
        """Blanks become one blank, are dropped by the first split, and no later step joins words."""
        norm = spec.get("normalizer") or {}
        steps = norm.get("normalizers", [])
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = pre[0] if pre else {}
        pattern = (split.get("pattern") or {}).get("Regex", "")
        return ([s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
                and [p.get("type") for p in pre] == ["Split", "ByteLevel"] and split.get("invert") is True
                and split.get("behavior") == "Removed" and not pre[1].get("use_regex") and not pre[1].get("add_prefix_space")
                and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
                and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                and spec["model"].get("end_of_word_suffix") == "</w>" and not spec["model"].get("ignore_merges"))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only.  Each is one pre-token, so the ids of many words in one
        text are cut after every piece that ends a word."""
        if self.ends is None:
            self.ends = np.zeros(1 << 16 if self.dtype is np.uint16 else self.tok.get_vocab_size(), bool)
            self.ends[[i for piece, i in self.tok.get_vocab().items() if piece.endswith("</w>")]] = True
        out: list[bytes] = []
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for group, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()
            if len(cuts) == len(group) and cuts[-1] == ids.nbytes:
                data = ids.tobytes()
                out += [data[i:j] for i, j in zip([0, *cuts], cuts)]
            else:  # some letter became several pre-tokens
                out += self._encode(group)
        return out

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Encode words that the table lacks.  A word of letters between plain signs is three
        runs of pre-tokens that never merge, so signs and letters are encoded apart, once each."""
        words, letters, signs, other = self.words, set(), set(), []
        cased, signed = [], []
        for w in new:
            if w.isalpha():
                if w.isascii() and not w.islower():
                    cased.append((w, w.lower()))
                else:
                    letters.add(w)
            elif (core := w.strip(_PUNCT)).isalpha() and core.lower().isalpha():  # U+0130 ends in a sign in lower case
                at = w.index(core)
                signed.append((w, w[:at], core.lower() if core.isascii() else core, w[at + len(core):]))
            else:
                other.append(w)
        letters.update(c for _, c in cased)
        for _, a, c, z in signed:
            letters.add(c)
            signs.update((a, z))
        found = {w: words[w] for w in (letters | signs) & words.keys()} if signed or cased else {}
        learn = [c for c in letters if c not in found]
        found.update(zip(learn, self._letters(learn)))
        other += [x for x in signs if x not in found]
        found.update(zip(other, self._encode(other)))
        for w, c in cased:
            found[w] = found[c]
        for w, a, c, z in signed:
            found[w] = found[a] + found[c] + found[z]
        return found

    def _cut(self, text: str) -> list[str] | None:
        """The words of a text, in lower case and apart from the signs behind them where that
        changes no pre-token; None where its blanks are not the tokenizer's."""
        if _CONTROL.search(text):
            return None
        if not _WIDE.search(text):
            low = text.lower()
            if not any(a in low for a in self.added):
                text = _ENDING.sub(r" \g<0>", low)
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        cut = [self._cut(t) for t in texts]
        # this call's words in a table of their own, small enough to stay in the processor's cache
        distinct = list(set().union(*[c for c in cut if c is not None]))
        known = dict(zip(distinct, map(self.words.get, distinct)))
        found = self._learn([w for w, ids in known.items() if ids is None])
        known.update(found)
        if len(self.words) + len(found) > TABLE_ENTRIES:
            self.words = {}
        self.words.update(found if max(map(len, found), default=0) <= WORD_CHARS else {w: ids for w, ids in found.items() if len(w) <= WORD_CHARS})
        get = known.__getitem__
        return [b"".join(map(get, c)) if c is not None else self._encode([t])[0] for t, c in zip(texts, cut)]


_workers: dict[str, WordTable] = {}


def _worker(path: str) -> WordTable:
    if path not in _workers:
        _workers[path] = WordTable(path)
    return _workers[path]


MANIFEST = "part int, file string, n_docs long, n_null long, n_tokens long"


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write token files of ``docs`` in ascending id order to ``folder`` on shared storage; the
    stored manifest (part, file, n_docs, n_null, n_tokens) in the order of the files."""
    spark = docs.sparkSession
    python_tasks(spark)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(partitions(spark), "id", "tie").sortWithinPartitions("id", "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, part = _worker(tokenizer), TaskContext.get().partitionId()
        filesystem, top = _open(folder)
        name = f"part-{part:06d}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}.tokens"
        end = np.array([end_id], table.dtype).tobytes()
        out, lengths, keys, nulls = None, [], [], 0
        for b in batches:
            if out is None:
                filesystem.create_dir(top, recursive=True)
                out = filesystem.open_output_stream(f"{top}/{name}", compression=None)
            ids = b.column(0)
            nulls += ids.null_count
            keys.append(ids.drop_null().to_numpy(zero_copy_only=False))
            for some in _runs(b.column(1).to_pylist()):
                data = table.encode(some)
                lengths.append(np.fromiter((len(d) for d in data), np.int64, len(data)) // table.dtype().itemsize + 1)
                out.write(b"".join(x for d in data for x in (d, end)))
        if out is None:
            return
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        keys = np.concatenate(keys)
        least = int(keys[0]) if len(keys) else 0
        sections = [EliasFano.build(bounds), EliasFano.build((keys - least).astype(np.uint64))]
        for ef in sections:
            for x in ef.parts():
                out.write(x.tobytes())
        footer = {"width": table.dtype().itemsize, "n_docs": len(bounds) - 1, "n_null": nulls, "n_tokens": int(bounds[-1]), "least": least,
                  "sections": [{"n": ef.n, "l": ef.l, "bytes": [x.nbytes for x in ef.parts()], "sample": ef.samples.dtype.str} for ef in sections]}
        tail = json.dumps(footer).encode()
        out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
        out.close()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(bounds) - 1], pa.int64()),
                               pa.array([nulls], pa.int64()), pa.array([int(bounds[-1])], pa.int64())],
                              ["part", "file", "n_docs", "n_null", "n_tokens"])

    return store(rows.select("id", "text").mapInArrow(run, MANIFEST), "manifest")


def _runs(texts: list[str], size: int = RUN_CHARS) -> Iterator[list[str]]:
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


class TokenFile:
    """Random access to one token file: boundaries and keys by select, ids by range."""

    def __init__(self, path: str):
        filesystem, where = _open(path)
        self.f = filesystem.open_input_file(where)
        size = self.f.size()
        tail = self.f.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        n = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self.f.read_at(n, size - 16 - n))
        at = self.footer["n_tokens"] * self.footer["width"]
        self.sections = []
        for s in self.footer["sections"]:
            parts = []
            for nbytes, kind in zip(s["bytes"], ("u1", "u1", s["sample"])):
                parts.append(np.frombuffer(self.f.read_at(nbytes, at), kind))
                at += nbytes
            self.sections.append(EliasFano(s["n"], s["l"], *parts))
        self.dtype = np.dtype("<u2" if self.footer["width"] == 2 else "<u4")

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Boundaries of documents first..last-1, one more than those."""
        return self.sections[0].range(first, last + 1)

    def keys(self, first: int, last: int) -> list[int | None]:
        nulls = self.footer["n_null"]
        found = self.sections[1].range(first - nulls, last - nulls) + self.footer["least"]
        return [None] * max(0, min(last, nulls) - first) + found.tolist()

    def ids(self, start: int, stop: int) -> np.ndarray:
        w = self.footer["width"]
        return np.frombuffer(self.f.read_at((stop - start) * w, start * w), self.dtype)


def read(spark: SparkSession, folder: str, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document, from the files alone."""
    # one row per file: the running sum over the manifest is small whatever the corpus
    placed = manifest.withColumn("base", F.sum("n_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["base"])
    blocks = (placed.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(BLOCK).cast("long"))))
              .select("part", "file", "base", "n_docs", "first").repartitionByRange(partitions(spark), "part", "first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["file"] != name:
                    name, file = r["file"], TokenFile(f"{folder}/{r['file']}")
                first, last = r["first"], min(r["first"] + BLOCK, r["n_docs"])
                bounds = file.bounds(first, last)
                crc, arrays, i = [], [], 0
                while i < last - first:
                    j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + READ_IDS, "right")) - 1)
                    some = file.ids(int(bounds[i]), int(bounds[j])).astype("<u4")
                    for a, z in zip(bounds[i:j] - bounds[i], bounds[i + 1:j + 1] - bounds[i]):
                        crc.append(zlib.crc32(some[a:z]))
                        if ids:
                            arrays.append(some[a:z].astype(np.int32))
                    i = j
                out = [pa.array(file.keys(first, last), pa.int64()), pa.array(bounds[:-1] + r["base"], pa.int64()),
                       pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())]
                yield pa.record_batch(out + ([pa.array(arrays, pa.list_(pa.int32()))] if ids else []),
                                      ["id", "start", "n_tokens", "ids_crc32"] + (["ids"] if ids else []))

    return blocks.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""))
