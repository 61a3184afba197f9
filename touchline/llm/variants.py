"""Spelling variants by dynamic programming over sorted word lists.

1. Words.  Tasks count the letter runs of whole texts in tables bounded in
   entries; partial counts are added up by word.
2. Sorted lists.  Two words one edit apart, the shorter of m letters, agree in
   their first m // 2 letters or in their last m - m // 2, as the edit lies in one
   half only.  So every word stands in lists by length m, once as written and
   once reversed, and meets in them only words with the same half.  The lists are
   range-partitioned into sorted blocks, so that a half with a third of all
   words spans blocks, and stored.
3. A block's scan.  Ranges of words with a common prefix share the rows of the
   edit matrix over that prefix, found from the longest common prefixes of
   neighbours; each row keeps a band of three entries.  A range whose entries all
   exceed one edit is left at once, with all its words.  The rows of many words'
   scans advance together, letter by letter.
4. A word whose half goes on in another block visits that block too, unless the
   edit matrix over the block's common prefix already exceeds one edit.  Block
   bounds are one row per partition.
5. Roots follow forms by pointer jumping: n at least doubles with each form, so
   six rounds do.

Defined results: a null or wordless text gives no words; a null doc_id counts as
the empty string; rows that repeat are occurrences of their own; of near words
with equal n the smallest in code-point order is the form; no words, no rows;
other input columns are ignored; words of any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, partitions, python_tasks, scratch, store

LETTERS, LEAST_CHARS, LEAST_COUNT, EVERY, RATIO = r"a-zÀ-ÿ", 5, 3, 97, 2
#: Words counted by a task before it gives them out; rows of a sorted block; words whose scans advance together.
COUNTED, BLOCK_ROWS, TOGETHER = 400_000, 1 << 17, 2048
#: Stands behind a word's last letter: equal to no letter.
_NONE = 1
_ROW = "pid int, side int, m int, s string, n long"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
          least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n): letter runs, A-Z lower-cased; a run whose crc32 with its document's id is divisible by
    ``every`` loses one letter."""
    python_tasks(docs.sparkSession)
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    run = re.compile(f"[{LETTERS}]{{{least_chars},}}")

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, crc32 = Counter(), zlib.crc32
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seed = crc32(f"{i}:".encode())
                # bytes.lower() changes A-Z alone
                for w, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = crc32(w.encode(), seed)
                    if not h % every:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least_chars:
                            continue
                    counts[w] += n
                if len(counts) > COUNTED:
                    yield out(counts)
                    counts = Counter()
        if counts:
            yield out(counts)

    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _half(side: int, m: int) -> int:
    return m // 2 if side == 0 else m - m // 2


class _List:
    """One block's words of one side and length m, sorted, and their ranges of common prefixes by depth."""

    def __init__(self, side: int, m: int, s: list[bytes], n: np.ndarray):
        self.side, self.m, self.k, self.n = side, m, _half(side, m), n
        self.letters = _matrix(s, m + 1, 0)
        self.size = np.array([len(x) for x in s])
        same = self.letters[1:] == self.letters[:-1]
        lcp = np.where(same.all(1), m + 1, (~same).argmax(1)) if len(s) > 1 else np.zeros(0, np.int64)
        self.lcp = np.concatenate([[-1], lcp])
        self.word = np.array([x[::-1] for x in s] if side else s, dtype=object)
        self.order = np.empty(len(s), np.int64)
        self.order[np.argsort(self.word, kind="stable")] = np.arange(len(s))
        self.first = self._first(self.word)

    def _first(self, word) -> np.ndarray:
        """The half as written: links that share it belong to side 0."""
        return np.array([w[:self.m // 2] for w in word], f"S{max(self.m // 2, 1)}")

    def near(self, s: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``s``, number in the list) of words exactly one edit apart that this side and length hold."""
        m, k = self.m, self.k
        q = _matrix(s, m + 3, _NONE)
        size = np.array([len(x) for x in s])
        starts = np.flatnonzero(self.lcp < k)
        heads = np.ascontiguousarray(self.letters[starts, :k]).view(f"S{k}").ravel()
        own = np.ascontiguousarray(q[:, :k]).view(f"S{k}").ravel()
        group = np.minimum(np.searchsorted(heads, own), len(heads) - 1)
        alone = np.diff(np.append(starts, len(self.n)))[group] == 1  # a half with one word: itself, or one to compare
        alone &= (self.size[starts[group]] == size) & (self.letters[starts[group], :m + 1] == _matrix(s, m + 1, 0)).all(1)
        at = np.flatnonzero((heads[group] == own) & ~alone)
        group = group[at]
        # entries of the row over the common half, for one letter fewer, as many and one more
        a, b, c = np.ones(len(at), np.int8), np.zeros(len(at), np.int8), np.ones(len(at), np.int8)
        found = []
        for d in range(k, m + 1):
            if not len(at):
                break
            below = np.flatnonzero(self.lcp < d + 1)
            first = np.searchsorted(below, starts)
            many = (np.append(first[1:], len(below)) - first)[group]
            by = np.repeat(np.arange(len(at)), many)
            child = np.repeat(first[group] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(len(by))
            letter = self.letters[below[child], d]
            ended = letter == 0
            if ended.any():
                found.append((at[by[ended]], below[child[ended]], [x[by[ended]] for x in (a, b, c)]))
            by, child, letter = by[~ended], child[~ended], letter[~ended]
            at, a, b, c = at[by], a[by], b[by], c[by]
            w = q[at]
            low = np.minimum(b + 1, a + (w[:, d - 1] != letter))
            mid = np.minimum(np.minimum(b + (w[:, d] != letter), c + 1), low + 1)
            high = np.minimum(c + (w[:, d + 1] != letter), mid + 1)
            keep = np.minimum(np.minimum(low, mid), high) <= 1
            at, group, a, b, c, starts = at[keep], child[keep], low[keep], mid[keep], high[keep], below
        if len(at):
            found.append((at, starts[group], [a, b, c]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, to = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        entries = np.stack([np.concatenate([f[2][i] for f in found]) for i in range(3)])
        gap = size[at] - self.size[to] + 1
        ok = (gap >= 0) & (gap <= 2) & (np.minimum(size[at], self.size[to]) == m)
        at, to, gap, entries = at[ok], to[ok], gap[ok], entries[:, ok]
        ok = entries[gap, np.arange(len(at))] == 1
        at, to = at[ok], to[ok]
        if self.side and len(at):
            ok = self._first([x[::-1] for x in s])[at] != self.first[to]
            at, to = at[ok], to[ok]
        return at, to


def _matrix(s: list[bytes], width: int, fill: int) -> np.ndarray:
    """The letters of words of at most ``width`` letters, one word a row."""
    out = np.frombuffer(b"".join(x.ljust(width, bytes([fill])) for x in s), np.uint8)
    return out.reshape(len(s), width)


def _prefix_reached(s: list[bytes], prefix: bytes) -> np.ndarray:
    """True where a word that starts with ``prefix`` can be within one edit of the word."""
    q = _matrix(s, max(map(len, s)) + len(prefix) + 2, _NONE)
    two = np.full(len(s), 2, np.int64)
    a, b, c = two, np.zeros(len(s), np.int64), np.ones(len(s), np.int64)
    for d, letter in enumerate(prefix):
        low = np.minimum(b + 1, a + (q[:, d - 1] != letter)) if d else b + 1
        mid = np.minimum(np.minimum(b + (q[:, d] != letter), c + 1), low + 1)
        a, b, c = low, mid, np.minimum(c + (q[:, d + 1] != letter), mid + 1)
    return np.minimum(np.minimum(a, b), c) <= 1


def _visits(bounds: list[tuple]):
    """Rows of words whose half goes on in blocks other than their own, for each such block."""
    low = [(r["side"], r["m"], r["lo"].encode("latin-1")) for r in bounds]
    high = [(r["side2"], r["m2"], r["hi"].encode("latin-1")) for r in bounds]
    pids = [r["pid"] for r in bounds]
    place = {p: i for i, p in enumerate(pids)}

    def common(i: int, side: int, m: int, half: bytes) -> bytes:
        """What all words of block i, with this side, length and half, start with."""
        if low[i][:2] != (side, m) or high[i][:2] != (side, m):
            return half
        n, (x, y) = 0, (low[i][2], high[i][2])
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return max(half, x[:n], key=len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_left, bisect_right

        for b in batches:
            groups: dict[tuple, list[int]] = {}
            rows = list(zip(*[b.column(c).to_pylist() for c in ("pid", "side", "m", "s")]))
            for i, (pid, side, m, s) in enumerate(rows):
                groups.setdefault((pid, side, m, s[:_half(side, m)]), []).append(i)
            for (pid, side, m, half), members in groups.items():
                half = half.encode("latin-1")
                # blocks that reach the half's first word, up to those that start behind its last
                first, last = bisect_left(high, (side, m, half)), bisect_right(low, (side, m, half + b"\xff" * (m + 2)))
                for i in range(first, last):
                    if i == place[pid]:
                        continue
                    prefix = common(i, side, m, half)
                    near = _prefix_reached([rows[x][3].encode("latin-1") for x in members], prefix)
                    some = b.take(pa.array(np.array(members)[near]))
                    if some.num_rows:
                        yield pa.record_batch([pa.array([pids[i]] * some.num_rows, pa.int32()), *some.columns[1:]], b.schema.names)

    return run


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks one after the other: first a block's own rows, which make its lists, then its visitors, as they come."""
    pid, own, lists = None, [], {}

    def answers(rows: pa.Table, at_home: bool) -> Iterator[pa.RecordBatch]:
        for (side, m), part in _sections(rows):
            if (side, m) not in lists:
                continue
            here, n = lists[side, m], part["n"].to_numpy()
            s = [x.encode("latin-1") for x in part["s"].to_pylist()]
            for first in range(0, len(s), TOGETHER):
                some, counts = s[first:first + TOGETHER], n[first:first + TOGETHER]
                at, to = here.near(some)
                order = np.lexsort((here.order[to], -here.n[to], at))
                at, to = at[order], to[order]
                number = np.bincount(at, minlength=len(some))
                best = np.full(len(some), -1)
                best[at[::-1]] = to[::-1]
                # a word's row at home, as written and by its own length, comes in any case
                keep = np.flatnonzero((number > 0) | (at_home and side == 0) & (np.array([len(x) for x in some]) == m))
                told = best[keep]
                yield pa.record_batch([
                    pa.array([(some[i][::-1] if side else some[i]).decode("latin-1") for i in keep], pa.string()), pa.array(counts[keep], pa.int64()),
                    pa.array(number[keep], pa.int64()), pa.array(here.n[told], pa.int64(), mask=told < 0),
                    pa.array([here.word[i].decode("latin-1") if i >= 0 else None for i in told], pa.string())],
                    ["word", "n", "n_near", "near_n", "near"])

    def home() -> Iterator[pa.RecordBatch]:
        if own:
            rows = pa.Table.from_batches(own)
            own.clear()
            lists.clear()
            for (side, m), part in _sections(rows):
                lists[side, m] = _List(side, m, [x.encode("latin-1") for x in part["s"].to_pylist()], part["n"].to_numpy())
            yield from answers(rows, True)

    for b in batches:
        pids, guests = b.column("pid").to_numpy(), b.column("guest").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, (pids[1:] != pids[:-1]) | (guests[1:] != guests[:-1])])
        for first, last in zip(cuts, [*cuts[1:], len(pids)]):
            some = b.slice(first, last - first)
            if pids[first] != pid:
                yield from home()
                pid = pids[first]
                lists.clear()
            if guests[first]:
                yield from home()
                yield from answers(pa.Table.from_batches([some]), False)
            else:
                own.append(some)
    yield from home()


def _sections(rows: pa.Table) -> Iterator[tuple[tuple[int, int], pa.Table]]:
    """Rows sorted by (side, m) in parts."""
    side, m = rows["side"].to_numpy(), rows["m"].to_numpy()
    cuts = np.flatnonzero(np.r_[True, (side[1:] != side[:-1]) | (m[1:] != m[:-1])]) if len(side) else []
    for first, last in zip(cuts, [*cuts[1:], len(side)]):
        yield (int(side[first]), int(m[first])), rows.slice(first, last - first)


def near_words(vocabulary: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(word, n, n_near, near_n, near) of every word of the stored (word, n): how many words are one edit
    away, and the one of those with the largest n."""
    spark = vocabulary.sparkSession
    python_tasks(spark)
    n = F.char_length("word")
    listed = (vocabulary.select("word", "n", F.explode(F.array(n, n - 1)).alias("m")).filter(F.col("m") >= least_chars)
              .select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("s")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")))).alias("r"), "m", "n")
              .select("r.side", "m", "r.s", "n"))
    blocks = max(partitions(spark), -(-4 * vocabulary.count() // BLOCK_ROWS))
    placed = store(listed.repartitionByRange(blocks, "side", "m", "s").select(F.spark_partition_id().alias("pid"), "side", "m", "s", "n"), "lists")
    edge = F.struct("side", "m", "s")
    # one row per block reaches the driver
    bounds = (placed.groupBy("pid").agg(F.min(edge).alias("a"), F.max(edge).alias("z")).orderBy("pid")
              .select("pid", "a.side", "a.m", F.col("a.s").alias("lo"), F.col("z.side").alias("side2"), F.col("z.m").alias("m2"), F.col("z.s").alias("hi")).collect())
    visits = placed.mapInArrow(_visits(bounds), _ROW)
    rows = placed.withColumn("guest", F.lit(False)).unionByName(visits.withColumn("guest", F.lit(True)))
    met = rows.repartition(blocks, "pid").sortWithinPartitions("pid", "guest", "side", "m", "s").mapInArrow(
        _scan, "word string, n long, n_near long, near_n long, near string")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("least"), "near")))
    return (met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n", "n_near", (-F.col("best.least")).alias("near_n"), F.col("best.near").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of stored (word, form) rows: the last of the words that forms lead to."""
    spark = forms.sparkSession
    path = scratch(spark, "roots")
    forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")).write.parquet(path)
    while True:
        now = spark.read.schema("word string, root string, done boolean").parquet(path)
        if now.filter("not done").isEmpty():
            return now.drop("done")
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"), F.col("done").alias("last"))
        live = now.filter("not done").join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.coalesce("last", F.lit(True)).alias("done"))
        after = scratch(spark, "roots")
        now.filter("done").unionByName(live).write.parquet(after)
        discard(spark, path)
        path = after


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                   least_count: int = LEAST_COUNT, every: int = EVERY, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``: its near word of largest n, if that
    has ``ratio`` times the word's n, and where forms lead."""
    vocabulary = store(words(docs, id_col, text_col, least_chars, least_count, every), "vocabulary")
    has = F.col("near_n") >= ratio * F.col("n")
    found = store(near_words(vocabulary, least_chars).select(
        "word", F.when(has, F.col("near")).alias("form"), "n", "n_near", F.when(has, F.col("near_n")).alias("form_n")), "near-words")
    roots = _roots(found.filter("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
