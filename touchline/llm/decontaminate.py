"""Benchmark decontamination with a positional inverted index (DataFrame functions only).

``build_index`` scans the training texts once and stores a posting (row, pos,
term) for every occurrence of a test term, plus one end posting per row whose
position is the row's word count.  Phrase search then never reads a text
again: for every test window the terms are ordered by their number of
postings; the postings of the rarest term, moved by its offset, are the
candidate starts, intersected with the second-rarest term's postings and then
with those of all other terms of the window.  Only the rarest lists are read
for all rows; the last intersection reads the postings of rows that still
have a candidate.  Joins are on (row, position), so neither a frequent word
nor a frequent passage gathers in one task.

Defined results: a null or wordless text has no words and no hits; a null
id stays a row of its own, as do repeated rows (rows are numbered at the scan
and the numbers frozen in the stored index); an item without words has no
window; repeated items are found alike; an empty table on either side gives
rows without hits, or none; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import broadcast_if_small, fresh, lower_ascii, store

#: Runs of ASCII characters that are not letters or digits part words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The end posting's term: a blank is never part of a word.
END = " "
WINDOW = 10


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, win, len, terms): every window of ``size`` consecutive words; an item of fewer is one window."""
    split = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("__w")).filter(F.size("__w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("__w") - F.lit(size - 1), F.lit(1)))
    return (split.select("item", "__w", F.explode(starts).alias("__s"))
            .select("item", F.slice("__w", F.col("__s"), size).alias("terms")).distinct()
            .select("item", F.sha2(F.concat_ws(" ", "terms"), 256).alias("win"), F.size("terms").alias("len"), "terms"))


def build_index(docs: DataFrame, test_windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The stored vocabulary (term, tid) and the stored index (row, id, pos, tid); tid 0 is the end posting."""
    spark = docs.sparkSession
    terms = test_windows.select(F.explode("terms").alias("term")).distinct()
    vocab = store(terms.select("term", F.xxhash64("term").alias("tid"))
                  .unionByName(spark.createDataFrame([(END, 0)], "term string, tid long")), "vocab")
    # the number in a select of its own: beside a generator it would number the generated rows
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    split = numbered.select("row", "id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "term"))
    index = split.join(broadcast_if_small(vocab), "term").select("row", "id", "pos", "tid")
    return vocab, store(index, "postings")


def ranked_terms(test_windows: DataFrame, vocab: DataFrame, index: DataFrame) -> DataFrame:
    """(win, len, off, tid, rank): terms of each distinct window, rarest first.  Windows with a
    term that has no posting cannot occur and are left out."""
    freq = index.filter("tid <> 0").groupBy("tid").agg(F.count(F.lit(1)).alias("freq"))
    flat = (test_windows.select("win", "len", "terms").distinct()
            .select("win", "len", F.posexplode("terms").alias("off", "term"))
            .join(vocab, "term").join(freq, "tid", "left"))
    by_win = Window.partitionBy("win")
    return store(flat.withColumn("least", F.min(F.coalesce("freq", F.lit(0))).over(by_win)).filter("least > 0")
                 .withColumn("rank", F.row_number().over(by_win.orderBy("freq", "tid", "off")))
                 .select("win", "len", "off", "tid", "rank"), "ranked")


def occurrences(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """(row, start, len, win): exact occurrences of the windows."""
    post = index.filter("tid <> 0").select("row", "pos", "tid")
    first = ranked.filter("rank = 1").select("win", "len", "tid", F.col("off").alias("off1"))
    cand = (post.join(F.broadcast(first) if _few(first) else first, "tid")
            .select("row", (F.col("pos") - F.col("off1")).alias("start"), "win", "len").filter("start >= 0"))
    second = ranked.filter("rank = 2").select("win", "tid", "off")
    seconds = second.select("tid").distinct()
    post2 = post.join(F.broadcast(seconds) if _few(second) else seconds, "tid", "left_semi")
    alone = cand.filter("len = 1")
    pairs = (cand.filter("len > 1").join(F.broadcast(second) if _few(second) else second, "win")
             .select("row", "start", "win", "len", "tid", (F.col("start") + F.col("off")).alias("pos"))
             .join(post2, ["row", "pos", "tid"]).select("row", "start", "win", "len"))
    live = store(alone.unionByName(pairs), "candidates")
    rows = store(live.filter("len > 2").select("row").distinct(), "candidate-rows")
    near = post.join(broadcast_if_small(rows, 1_000_000), "row", "left_semi")
    rest = ranked.filter("rank > 2").select("win", "tid", "off")
    found = (live.filter("len > 2").join(F.broadcast(rest) if _few(rest) else rest, "win")
             .select("row", "start", "win", "len", "tid", (F.col("start") + F.col("off")).alias("pos"))
             .join(near, ["row", "pos", "tid"])
             .groupBy("row", "start", "win", "len").agg(F.count(F.lit(1)).alias("met"))
             .filter("met = len - 2").drop("met"))
    return store(live.filter("len <= 2").unionByName(found), "occurrences")


def _few(df: DataFrame) -> bool:
    return df.count() <= 100_000


def near_matches(index: DataFrame, ranked: DataFrame, slop: int) -> DataFrame:
    """Proximity: (id, win, gap) for rows in which the two rarest terms of a window stand within
    ``slop`` words of each other, with their least distance.  Positions are dealt to blocks of
    ``slop`` words and met in their own and both neighbouring blocks."""
    post = index.filter("tid <> 0").select("row", "id", "pos", "tid")
    first = ranked.filter("rank = 1").select("win", "tid")
    second = ranked.filter("rank = 2").select("win", "tid")
    a = (post.join(first, "tid").select("row", "id", "win", F.col("pos").alias("p"))
         .withColumn("block", F.explode(F.array(*[F.floor(F.col("p") / slop) + d for d in (-1, 0, 1)]))))
    b = (post.join(second, "tid").select("row", "win", F.col("pos").alias("q"))
         .withColumn("block", F.floor(F.col("q") / slop)))
    gap = F.abs(F.col("p") - F.col("q"))
    return (a.join(b, ["row", "win", "block"]).filter((gap > 0) & (gap <= slop))
            .groupBy("row", "id", "win").agg(F.min(gap).alias("gap")).drop("row"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document row: id, n_words, n_hit (words inside an occurrence), items (sorted ids as text)."""
    wins = store(windows(items, size, item_col), "windows")
    vocab, index = build_index(docs, wins, id_col, text_col)
    found = occurrences(index, ranked_terms(wins, vocab, index))
    hits = (found.select("row", "start", "len").distinct()
            .select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos"))
            .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    items_of = wins.select("win", F.col("item").cast("string").alias("item"))
    named = (found.select("row", "win").distinct().join(F.broadcast(items_of) if _few(items_of) else items_of, "win")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (index.filter("tid = 0").select("row", F.col("id").alias(id_col), F.col("pos").cast("long").alias("n_words"))
            .join(hits, "row", "left").join(named, "row", "left").drop("row")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` with all columns, without the rows that hold an occurrence of a window.  A row is
    named by a hash of its id and text, so a clean row keeps its place beside one of the same id."""
    name = F.xxhash64(F.col(id_col), F.col(text_col))
    named = docs.select(name.alias("__name"), F.col(text_col).alias("__text"))
    mark = fresh(docs, "__name")
    hit = contamination(named, items, size, "__name", "__text", item_col).filter("n_hit > 0").select(F.col("__name").alias(mark)).distinct()
    return docs.join(hit, name == F.col(mark), "left_anti")


ORACLE = rf"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (SELECT DISTINCT item_id, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS win, least(len(w), {WINDOW}) AS n
         FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iwin),
grams AS (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
          FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS s FROM dw, sizes WHERE len(w) >= n)),
occ AS (SELECT g.r, g.s, g.n, i.item_id FROM grams g JOIN iwin i ON g.win = i.win AND g.n = i.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM occ) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
