"""Token counts with a digest cache, and SentencePiece encoding by a distinct-chunk table.

Chunks.  A model without pieces that hold a whitespace marker after another
character cannot merge across the start of a marked word, so a text can be
cut before each run of blanks and every chunk be segmented on its own; the
ids of a text are its chunks' ids in order.  ``ChunkTable`` verifies those
conditions from the model file, segments the distinct chunks that its Python
worker's table lacks, and joins ids back by position; the joined ids of each
text are then decoded.  A model that doesn't meet them is encoded text by text.

Digest cache.  ``count_tokens`` joins sha-256 digests of the normalised
content and of the tokenizer file to stored counts, encodes one text of each
distinct miss, and appends those counts to the cache table, so that a later
run over the same or overlapping data encodes only what is new.

Defined results: a null text counts as empty; null ids stay; repeated rows
and copies get the same counts; empty tables give no rows; other input
columns are ignored; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import python_tasks, release, store

MARK = "▁"
#: Entries after which a worker's table starts anew, and characters up to which a chunk is kept.
TABLE_ENTRIES, CHUNK_CHARS = 120_000, 64
#: Characters of texts cut at once: their chunks stay in the processor's cache, and few at a time in memory.
RUN_CHARS = 1 << 19
_CHUNK = re.compile(" +[^ ]*")
_workers: dict = {}


def _spec(model) -> tuple[bool, bool]:
    """(identity normaliser with a dummy prefix and kept blanks, no piece crosses a marker)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    n, t = proto.normalizer_spec, proto.trainer_spec
    plain = (not n.precompiled_charsmap and not n.normalization_rule_tsv and n.add_dummy_prefix
             and not n.remove_extra_whitespaces and n.escape_whitespaces and not t.treat_whitespace_as_suffix)
    inner = re.compile(f"[^{MARK}]{MARK}")
    return plain, not any(inner.search(p.piece) or p.type == p.USER_DEFINED for p in proto.pieces)


class ChunkTable:
    """Distinct marked words of a sentencepiece model, segmented where the table lacks them and joined back by position."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_chunk = all(_spec(self.model))
        self._clear()

    def _clear(self) -> None:
        # the chunk of a lone marker: encoding an empty text gives no ids at all
        lone = self.model.piece_to_id(MARK)
        self.ids: dict[str, str] = {"": str(lone)}
        self.counts: dict[str, int] = {"": 1}
        self.packed: dict[str, bytes] = {"": np.int32(lone).tobytes()}

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text without the one blank that the dummy prefix gives back."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if text[0] != " " and "  " not in text:
            return text.split(" ")
        return [c[1:] for c in _CHUNK.findall(" " + text)]

    def _learn(self, distinct: set[str]) -> list[str]:
        """Segment the chunks that the table lacks; returns those too long to stay."""
        if len(self.ids) > TABLE_ENTRIES:
            self._clear()
        new = [c for c in distinct if c not in self.ids]
        for chunk, ids in zip(new, self.model.encode(new, num_threads=1)):
            self.ids[chunk] = ",".join(map(str, ids))
            self.counts[chunk] = len(ids)
            self.packed[chunk] = np.array(ids, np.int32).tobytes()
        return [c for c in new if len(c) > CHUNK_CHARS]

    def _forget(self, chunks: list[str]) -> None:
        for c in chunks:
            del self.ids[c], self.counts[c], self.packed[c]

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_chunk:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        out = []
        for some in _runs(texts):
            cut = [self.chunks(t) for t in some]
            long = self._learn(set().union(*cut))
            get = self.counts.__getitem__
            out += [sum(map(get, c)) for c in cut]
            self._forget(long)
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes, str]]:
        """(decimal ids joined by commas, ids as 32-bit numbers, text decoded from these ids) of each text."""
        if not self.by_chunk:
            for t in texts:
                ids = self.model.encode(t)
                yield ",".join(map(str, ids)), np.array(ids, np.int32).tobytes(), self.model.decode(ids)
            return
        for some in _runs(texts):
            cut = [self.chunks(t) for t in some]
            long = self._learn(set().union(*cut))
            decimal, packed = self.ids.__getitem__, self.packed.__getitem__
            for c in cut:
                numbers = b"".join(map(packed, c))
                yield ",".join(map(decimal, c)), numbers, self.model.decode(np.frombuffer(numbers, np.int32).tolist())
            self._forget(long)


def _runs(texts: list[str], size: int = RUN_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters, so that a run's chunks stay small."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def _worker(path: str):
    """This Python worker's tokenizer; it lives as long as the worker."""
    if path not in _workers:
        if path.endswith(".json"):
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            _workers[path] = lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
        else:
            _workers[path] = ChunkTable(path)
    return _workers[path]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content(text: Column) -> Column:
    """The default normalisation, which changes no count: null becomes the empty text."""
    return F.coalesce(text, F.lit(""))


CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] = content) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row.  ``cache_path`` is a Parquet folder on shared
    storage, made where it is missing; counts of distinct misses are appended to it.  Two runs that
    append the same digest at once do no harm: readers take one row per digest.  ``normalise`` must
    keep null-free text; counts are those of the normalised text."""
    spark = docs.sparkSession
    python_tasks(spark)
    version = tokenizer_digest(tokenizer)
    text = normalise(F.col(text_col))
    base = docs.select(F.col(id_col).alias("__id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
                       text.alias("__text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    keys = store(base.select("__id", "n_bytes", "digest"), "digests")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    def cached() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    # one row stands for all copies of a content; ids and digests only, combined before the shuffle
    misses = store(keys.groupBy("digest").agg(F.min("__id").alias("__rep"))
                   .join(cached().select("digest"), "digest", "left_anti"), "misses")
    chosen = base.join(misses.withColumnRenamed("digest", "__d"),
                       F.col("__id").eqNullSafe(F.col("__rep")) & (F.col("digest") == F.col("__d")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(tokenizer)
        count = table.count if isinstance(table, ChunkTable) else table
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(count(b.column(1).to_pylist()), pa.int64())], ["digest", "n_tokens"])

    (chosen.select("digest", "__text").mapInArrow(encode, "digest binary, n_tokens long")
     .select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path))
    return keys.join(cached(), "digest").select(F.col("__id").alias(id_col), "n_bytes", "n_tokens")


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, texts: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded]) of every row.  No shuffle: chunk
    tables live in the workers, bounded in entries, and a lost one is rebuilt from the texts."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), content(F.col(text_col)).alias("__text"))
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker(model)
        for b in batches:
            n, ids_sha, text_sha, packed, decoded = [], [], [], [], []
            for decimal, numbers, text in table.encode(b.column(1).to_pylist()):
                n.append(len(numbers) // 4)
                ids_sha.append(hashlib.sha256(decimal.encode()).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                if ids:
                    packed.append(numbers)
                if texts:
                    decoded.append(text)
            out = {"__id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                   "decoded_sha256": pa.array(text_sha, pa.string())}
            if ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                out["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), np.int32)))
            if texts:
                out["decoded"] = pa.array(decoded, pa.string())
            yield pa.record_batch(list(out.values()), list(out))
        release()

    schema = f"__id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids + ", decoded string" * texts
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_col)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows with id arrays; null ids decode to the empty text."""
    rows = encoded.select(F.col(id_col).alias("__id"), F.col(ids_col).cast("array<int>").alias("__ids"))
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _worker(model).model
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([sp.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], ["__id", "text"])

    return rows.mapInArrow(run, f"__id {id_type}, text string").withColumnRenamed("__id", id_col)
