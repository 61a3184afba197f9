"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct word shingles (64-bit hashes of them).

1. ``shingle_sets`` finds every shingle's document frequency exactly.  A task
   packs the shingles of an Arrow batch of texts by hash bucket; a shingle of
   several of the batch's documents is sent once, with its count.  Buckets add
   up the counts and answer each batch with the shingles that two or more
   documents have.  A document with more than 1 - t of its shingles of its own
   can have no partner; the others keep their shared shingles, rarest first.
2. Equal sets become one representative.
3. Prefixes (the rarest shingles that any partner must touch) are indexed by
   shingle, each entry with the size of the largest partner that can have this
   shingle as the first in common: the length and the positional filter in one
   number; and with the set's marks, the parity of its shingles in each of 512
   hash ranges.  Two sets differ by at least as many shingles as their marks by
   bits: a suffix filter that runs inside the join, in codegen.
4. For components, ``WAVES`` waves come first: each document is verified against
   the most alike, by marks, of those drawn for its prefix shingles (in the
   first wave the document with the fewest shingles of its own, then random
   ones of other components).  Groups of near copies fall into one component.
5. Then the join: components meet by shingle and band of set size, so that sets
   too unlike in size never meet, and only where they differ; of two that meet
   the one with fewer sets at the shingle is opened first.  Candidates are made
   distinct and verified once, after a suffix filter by exact counts of 64 hash
   ranges.  No link between components is lost, as the join comes after the
   waves.  k documents that just miss a group of m near copies cost k * m
   comparisons for each shared prefix shingle, but rows only where marks pass.

Defined results: a null or wordless text has the empty set, links with
nothing; fewer than ``size`` words are one shingle; a null id gets its set's
size, no links and a null component; rows that repeat an id are one node;
an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .bytewords import buffers, mix, pieces, word_hashes
from .shared import fresh, partitions, python_tasks, release, store

SIZE, PERCENT = 5, 75
#: Bands of set sizes that meet, for each power of e.
BANDS = 8.0
#: Waves of checks, each document against one, before components are joined.
WAVES = 2
#: Hash buckets for each shuffle partition; rows of one packed batch (their numbers are 16 bits).
BUCKETS_PER_PARTITION, BATCH_ROWS = 4, 50_000
_PACKED = "bucket int, batch long, own boolean, a binary, b binary, c binary, d binary, e binary, f binary"
#: Longs of a set's marks, whose bits hold the parity of its shared shingles by hash range.
MARKS = [f"m{k}" for k in range(8)]
_SETS = "id long, n int, alone int, shared binary, sig binary, " + ", ".join(f"{m} long" for m in MARKS)


def shingles(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles of each text, by text and hash."""
    raw, off = buffers(column)
    texts, hashes = [], []
    for first, last in pieces(off):
        t, _, h = word_hashes(raw[off[first]:off[last]], off[first:last + 1] - off[first])
        if not len(h):
            continue
        bounds = np.searchsorted(t, np.arange(last - first + 1))
        words = np.diff(bounds)
        keep = np.zeros(len(h), bool)
        width = np.zeros(len(h), np.int64)
        full = bounds[:-1][words > 0]
        keep[full] = True  # the first shingle of every text with words
        width[full] = np.minimum(words[words > 0], size)
        inner = np.arange(len(h)) + size <= bounds[t + 1]
        keep |= inner
        width[inner] = size
        acc = np.zeros(len(h), np.uint64)
        for k in range(size):
            part = np.zeros(len(h), np.uint64)
            part[:max(len(h) - k, 0)] = h[k:]
            part[width <= k] = 0
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + part
        s = mix(acc + width.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))[keep]
        t = t[keep]
        cuts = np.searchsorted(t, np.arange(last - first + 1))
        for a, z in zip(cuts[:-1], cuts[1:]):
            s[a:z].sort()
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        texts.append(t[new] + first)
        hashes.append(s[new])
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(texts), np.concatenate(hashes)


def _pack(ids: pa.Array, column: pa.Array, batch: int, buckets: int, size: int) -> pa.RecordBatch:
    """One row per hash bucket, (a, b) shingles of one document and its number and (c, d) shingles
    of several documents and their count, and the batch's own row: ids, set sizes, documents of
    the shingles of several, and which ids are null."""
    text, h = shingles(column, size)
    n = np.bincount(text, minlength=len(column)).astype(np.uint32)
    order = np.argsort(h, kind="stable")
    h, text = h[order], text[order].astype(np.uint16)
    head = np.ones(len(h), bool)
    head[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(head)
    count = np.diff(np.append(at, len(h)))
    single, multi = at[count == 1], at[count > 1]
    several = np.repeat(count > 1, count) if len(count) else np.zeros(0, bool)
    bucket = lambda x: ((x >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    rows = {name: [] for name in ("bucket", "batch", "own", "a", "b", "c", "d", "e", "f")}

    def add(*values):
        for name, v in zip(rows, values):
            rows[name].append(v)

    cut1 = np.searchsorted(bucket(h[single]), np.arange(buckets + 1))
    cut2 = np.searchsorted(bucket(h[multi]), np.arange(buckets + 1))
    counts = count[count > 1].astype(np.uint32)
    for b in range(buckets):
        s, m = single[cut1[b]:cut1[b + 1]], slice(cut2[b], cut2[b + 1])
        if len(s) or cut2[b] < cut2[b + 1]:
            add(b, batch, False, _planes(h[s]), text[s].tobytes(), h[multi[m]].tobytes(), counts[m].tobytes(), None, None)
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    add(batch % buckets, batch, True, known.tobytes(), n.tobytes(), h[multi].tobytes(), counts.tobytes(), text[several].tobytes(),
        ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
    types = [pa.int32(), pa.int64(), pa.bool_()] + [pa.binary()] * 6
    return pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))


def _planes(h: np.ndarray) -> bytes:
    """Sorted hashes byte by byte, the leading bytes of all first: runs that the shuffle compresses."""
    return h.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _hashes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _cat(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All binary values of a column as one array, and each one's number of entries."""
    parts = [np.frombuffer(x or b"", dtype) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, dtype), np.array([len(p) for p in parts], np.int64)


def _answer(rows: pa.Table) -> pa.Table:
    """A bucket's answers: for each batch the shingles that several documents have, with their frequency."""
    asks = rows.filter(pc.invert(rows["own"]))
    own = rows.filter(rows["own"])
    parts = [_hashes(x) for x in asks["a"].to_pylist()]
    h1, len1 = np.concatenate([np.zeros(0, np.uint64), *parts]), np.array([len(p) for p in parts], np.int64)
    doc, _ = _cat(asks["b"], np.uint16)
    h2, len2 = _cat(asks["c"], np.uint64)
    n2, _ = _cat(asks["d"], np.uint32)
    names, inverse = np.unique(np.concatenate([h1, h2]), return_inverse=True)
    df = np.bincount(inverse, weights=np.concatenate([np.ones(len(h1)), n2]), minlength=len(names)).astype(np.uint32)
    df1, df2 = df[inverse[:len(h1)]], df[inverse[len(h1):]]
    out = {name: [] for name in ("batch", "a", "b", "c", "d", "e")}
    at1, at2 = np.concatenate([[0], np.cumsum(len1)]), np.concatenate([[0], np.cumsum(len2)])
    for i, batch in enumerate(asks["batch"].to_pylist()):
        a, z = at1[i], at1[i + 1]
        m = slice(at2[i], at2[i + 1])
        hit = np.flatnonzero(df1[a:z] > 1) + a
        if len(hit) or at2[i] < at2[i + 1]:
            for name, v in zip(out, (batch, h1[hit].tobytes(), doc[hit].tobytes(), h2[m].tobytes(), df2[m].tobytes(), df1[hit].tobytes())):
                out[name].append(v)
    n = len(out["batch"])
    answers = pa.table({"batch": pa.array(out["batch"], pa.int64()), "own": pa.array([False] * n, pa.bool_()),
                        **{c: pa.array(out[c], pa.binary()) for c in "abcde"}, "f": pa.nulls(n, pa.binary())})
    return pa.concat_tables([answers, own.select(answers.column_names).cast(answers.schema)])


def _assemble(percent: int):
    """A batch's documents: set sizes, and for those that can have partners the shared shingles, rarest first."""

    def run(rows: pa.Table) -> pa.Table:
        own = rows.filter(rows["own"]).to_pylist()[0]
        rest = rows.filter(pc.invert(rows["own"]))
        ids, n = np.frombuffer(own["a"], np.int64), np.frombuffer(own["b"], np.uint32).astype(np.int64)
        null = np.frombuffer(own["f"], np.uint8).astype(bool)
        h1, _ = _cat(rest["a"], np.uint64)
        doc1, _ = _cat(rest["b"], np.uint16)
        df1, _ = _cat(rest["e"], np.uint32)
        h2, _ = _cat(rest["c"], np.uint64)
        df2, _ = _cat(rest["d"], np.uint32)
        names, times = np.frombuffer(own["c"], np.uint64), np.frombuffer(own["d"], np.uint32)
        doc2 = np.frombuffer(own["e"], np.uint16)
        order = np.argsort(h2)  # the batch's shingles of several documents are in hash order
        h = np.concatenate([h1, np.repeat(names, times)])
        df = np.concatenate([df1, np.repeat(df2[order], times)])
        doc = np.concatenate([doc1, doc2]).astype(np.int64)
        order = np.lexsort((h, df, doc))
        h, doc = h[order], doc[order]
        cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
        out = []
        for i in range(len(ids)):
            a, z = cuts[i], cuts[i + 1]
            can = n[i] and not null[i] and 100 * (z - a) >= percent * n[i]
            shared = h[a:z].tobytes() if can else None
            # only a set without a shingle of its own can equal another
            sig = hashlib.md5(np.sort(h[a:z]).tobytes()).digest() if can and z - a == n[i] else None
            out.append((None if null[i] else int(ids[i]), int(n[i]), int(n[i] - (z - a)), shared, sig, *(_marks(h[a:z]) if can else [None] * len(MARKS))))
        columns = list(zip(*out)) if out else [[]] * (5 + len(MARKS))
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * len(MARKS))
        return pa.table({name: pa.array(c, t) for name, c, t in zip(("id", "n", "alone", "shared", "sig", *MARKS), columns, types)})

    return run


def _marks(h: np.ndarray) -> list[int]:
    """The parities of the shingles of each of 64 * len(MARKS) hash ranges: two sets differ by at least
    as many shingles as their marks differ by bits."""
    odd = np.bincount((h >> np.uint64(32)) % np.uint64(64 * len(MARKS)), minlength=64 * len(MARKS)).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).tolist()


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The stored (id, n, alone, shared, sig) of every row: set size, shingles of its own, and for
    rows that can have partners the packed shared shingles in ascending (frequency, hash) order;
    sig where none is its own."""
    spark = docs.sparkSession
    python_tasks(spark)
    buckets = BUCKETS_PER_PARTITION * partitions(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                some = b.slice(at, BATCH_ROWS)
                yield _pack(some.column(0), some.column(1), number, buckets, size)
                number += 1
        release()

    packed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(pack, _PACKED)
    answered = packed.groupBy("bucket").applyInArrow(_answer, "batch long, own boolean, a binary, b binary, c binary, d binary, e binary, f binary")
    return store(answered.groupBy("batch").applyInArrow(_assemble(percent), _SETS), "shingle-sets")


class Join:
    """The self-join of a table's shingle sets."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT):
        self.percent = percent
        self.sets = shingle_sets(docs, id_col, text_col, size, percent)
        able = self.sets.filter("shared is not null")
        #: (sig, rep, copies) of equal sets without a shingle of their own
        self.copies = store(able.filter("sig is not null").groupBy("sig").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "copies")
        firsts = able.filter("sig is not null").join(self.copies.select("sig", F.col("rep").alias("id")), ["sig", "id"]).dropDuplicates(["sig"])
        columns = ["id", "n", "alone", "shared", *MARKS]
        self.reps = store(able.filter("sig is null").select(columns).unionByName(firsts.select(columns)), "representatives")
        self.index = store(self._index(), "prefixes")

    def _index(self) -> DataFrame:
        """(h, id, n, alone, up, marks) of the prefix shingles of each representative.  ``up``: the largest
        set that can link if this shingle is the first in common, as what comes before it is not shared."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for i, n, alone, shared, *marks in zip(*[c.to_pylist() for c in b.columns]):
                    h = np.frombuffer(shared, np.int64)[:n - -(-percent * n // 100) + 1 - alone]
                    rest = n - alone - np.arange(len(h))
                    up = np.minimum(100 * n // percent, ((100 + percent) * rest - percent * n) // percent)
                    rows.append((h, *[np.full(len(h), x, np.int64) for x in (i, n, alone)], up, *[np.full(len(h), x, np.int64) for x in marks]))
                if rows:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*rows)], ["h", "id", "n", "alone", "up", *MARKS])

        return self.reps.select("id", "n", "alone", "shared", *MARKS).mapInArrow(run, "h long, id long, n long, alone long, up long, " + ", ".join(f"{m} long" for m in MARKS))

    def _differ(self):
        """A lower bound of the shingles that only one of two sets has: bits of the marks, and those of their own."""
        return sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}2"))) for m in MARKS), F.col("alone") + F.col("alone2"))

    def _alike(self):
        """The lengths, the positions and the marks leave it possible that two sets link."""
        lengths = (F.col("n") <= F.col("up2")) & (F.col("n2") <= F.col("up"))
        return lengths & (self._differ() * (100 + self.percent) <= (100 - self.percent) * (F.col("n") + F.col("n2")))

    def _across(self, live: DataFrame, small: DataFrame) -> DataFrame:
        """(h, part, part2, low2, top2, few): components that share a prefix shingle and hold sets there
        of lengths that may link, the lengths that sets of the second may link with, and if the
        first has no more sets there.  They meet in the bands of those lengths, each pair in the
        first band of both only.  Rounding loses none, as a band never falls with the length."""
        band = lambda n: F.floor(F.log(n.cast("double")) * BANDS).cast("int")
        one = (live.groupBy("h", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("up").alias("top"), F.count(F.lit(1)).alias("many"))
               .withColumn("first_band", band(F.col("low"))).withColumn("band", F.explode(F.sequence("first_band", band(F.col("high"))))))
        two = (small.groupBy("h", "part2").agg(F.min("n2").alias("low2"), F.max("up2").alias("top2"), F.count(F.lit(1)).alias("many2"))
               .withColumn("first_band2", band(F.col("low2")))
               .withColumn("band2", F.explode(F.sequence("first_band2", band(F.col("top2"))))).withColumnRenamed("h", "h2"))
        may = (F.col("low2") <= F.least("high", "top")) & (F.col("low") <= F.col("top2"))
        return (one.join(two, (F.col("h") == F.col("h2")) & (F.col("band") == F.col("band2")) & (F.col("part") != F.col("part2"))
                         & (F.col("band") == F.greatest("first_band", "first_band2")) & may)
                .select("h", "part", "part2", "low2", "top2", (F.col("many") <= F.col("many2")).alias("few")))

    def _live(self, component: DataFrame | None) -> DataFrame:
        """The stored index with each entry's component (``part``), where a shingle has entries of several."""
        if component is None:
            index = self.index.withColumn("part", F.col("id"))
        else:
            index = self.index.join(component, F.col("id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "id")).drop("node", "component")
        mixed = index.groupBy("h").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("h")
        return store(index.join(mixed, "h"), "live-prefixes")

    def wave(self, component: DataFrame | None, number: int) -> DataFrame:
        """(a, b): each representative with one of another component, of those drawn for its prefix
        shingles the one whose marks are the most alike, if the two may link.  Wave 0 draws the set
        with the fewest shingles of its own for each shingle, later ones a random set."""
        # the first wave reads the whole index once, which is less than to find its shared shingles before
        live = self.index.withColumn("part", F.col("id")) if component is None else self._live(component)
        first = F.col("alone") if number == 0 else F.xxhash64("id", F.lit(number))
        names = ["id", "part", "n", "alone", "up", *MARKS]
        drawn = live.groupBy("h").agg(F.min(F.struct(first.alias("first"), *names)).alias("hub")).select("h", *[F.col(f"hub.{c}").alias(f"{c}2") for c in names])
        best = (live.join(drawn, "h").filter((F.col("part") != F.col("part2")) & self._alike())
                .groupBy("id").agg(F.min(F.struct(self._differ().alias("differ"), "id2")).alias("best")))
        return best.select(F.least("id", "best.id2").alias("a"), F.greatest("id", "best.id2").alias("b")).distinct()

    def cross_pairs(self, component: DataFrame | None = None) -> DataFrame:
        """(a, b): all pairs that share a prefix shingle and pass the filters.  Given (node, component),
        only pairs across components.  Of two components that meet, the one with fewer sets at the
        shingle is opened first: what meets the other's sets has passed no more rows than it has."""
        live = self._live(component)
        # the smaller of two must be able to link with one of its own size or larger
        small = live.filter("up >= n").select("h", *[F.col(c).alias(f"{c}2") for c in ("part", "id", "n", "alone", "up", *MARKS)])
        across = store(self._across(live, small), "component-pairs")
        smaller = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("id2") < F.col("id")))
        within = F.col("n").between(F.col("low2"), F.col("top2")) & (F.col("up") >= F.col("low2"))
        few = across.filter("few").join(live, ["h", "part"]).filter(within).drop("low2", "top2", "few").join(small, ["h", "part2"])
        many = across.filter("not few").select("h", "part", "part2").join(small, ["h", "part2"]).join(live, ["h", "part"])
        met = few.filter(smaller & self._alike()).select("id", "id2").union(many.filter(smaller & self._alike()).select("id", "id2"))
        return met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()

    def verify(self, pairs: DataFrame, name: str = "links") -> DataFrame:
        """The stored (a, b, overlap) of the pairs that reach the bound."""
        left = self.reps.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"))
        right = self.reps.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"))
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for a, z, n1, n2, s1, s2 in zip(*[c.to_pylist() for c in b.columns]):
                    need = -(-percent * (n1 + n2) // (100 + percent))
                    x, y = np.frombuffer(s1, np.uint64), np.frombuffer(s2, np.uint64)
                    if _suffix_bound(x, y) < need:
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= need:
                        rows.append((a, z, both))
                if rows:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b", "overlap"])

        data = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "shared_a", "shared_b")
        return store(data.mapInArrow(run, "a long, b long, overlap long"), name)

    def pairs(self) -> DataFrame:
        """All links between representatives, each verified once; ``members`` has the copies."""
        return self.verify(self.cross_pairs())

    def members(self) -> DataFrame:
        """(id, rep) of every row with an id."""
        keyed = self.sets.filter("id is not null and sig is not null").select("id", "sig").join(self.copies, "sig").select("id", "rep")
        return keyed.unionByName(self.sets.filter("id is not null and sig is null").select("id", F.col("id").alias("rep")))

    def components(self) -> DataFrame:
        """(id, n_shingles, component_id) of every row."""
        near, found = None, None
        for number in range(WAVES):
            links = self.verify(self.wave(found, number), f"wave-{number}").select("a", "b")
            near = links if near is None else near.unionByName(links)
            found = store(graph.components(near), "wave-components")
        far = self.verify(self.cross_pairs(found)).select("a", "b")
        part = store(graph.components(near.unionByName(far)), "components")
        copies = (self.copies.join(part, F.col("rep") == F.col("node"), "left")
                  .select("sig", F.coalesce("component", "rep").alias("component_id")))
        n = F.col("n").cast("long").alias("n_shingles")
        apart = self.sets.filter("shared is null").select("id", n, F.col("id").alias("component_id"))
        keyed = self.sets.filter("sig is not null").select("id", "n", "sig").join(copies, "sig").select("id", n, "component_id")
        other = (self.sets.filter("shared is not null and sig is null").select("id", "n").join(part, F.col("id") == F.col("node"), "left")
                 .select("id", n, F.coalesce("component", "id").alias("component_id")))
        return apart.unionByName(keyed).unionByName(other)


def _suffix_bound(x: np.ndarray, y: np.ndarray, ranges: int = 64) -> int:
    """The overlap is at most the sum over hash ranges of the lesser count."""
    shift = np.uint64(64 - ranges.bit_length() + 1)
    return int(np.minimum(np.bincount((x >> shift).astype(np.int64), minlength=ranges), np.bincount((y >> shift).astype(np.int64), minlength=ranges)).sum())


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    return Join(docs, id_col, text_col, size, percent).components().withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with all columns, one document of each component: that with the smallest id.  Of
    rows that repeat an id, each different text stays once; rows with a null id stay."""
    id_, mine = fresh(docs, "__id"), F.col(id_col)
    parts = store(components(docs, id_col, text_col, size, percent).select(F.col(id_col).alias(id_), "component_id"), "parts")
    copies = parts.filter(F.col(id_) != F.col("component_id")).select(id_).distinct()
    kept = docs.join(copies, mine == F.col(id_), "left_anti")
    repeats = store(parts.filter(F.col(id_).isNotNull()).groupBy(id_).count().filter("count > 1").select(id_), "repeats")
    if repeats.isEmpty():
        return kept
    return (kept.join(repeats, mine == F.col(id_), "left_anti")
            .unionByName(kept.join(repeats, mine == F.col(id_), "left_semi").dropDuplicates([id_col, text_col])))
