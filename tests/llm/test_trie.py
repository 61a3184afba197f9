"""The conversation prefix trie against a trie of Python dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from touchline.llm import trie
from touchline.llm.shared import table

SCHEMA = "conv_id long, turn long, role string, text string, depth string, owner string, n string"


def brute(rows):
    """Nodes of (conv_id, turn, role, text) rows, as the operator's columns."""
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in talks.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(full):
        path = tuple(full[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1]) if path else 0
    return sorted((who[0], len(p), members[p[:-1]][0] if p else None, len(who), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, who in members.items())


def found(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", None) for r in rows], SCHEMA).repartition(3)


def test_real_table(spark):
    talks = table(spark, "/root/testdata/sf0.01", "conversations")
    assert found(trie.prefix_trie(talks)) == brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in talks.collect()])


@pytest.mark.parametrize("batch, seed", [("10000", 1), ("3", 2), ("1", 3)])
def test_random_talks_across_partitions_and_batches(spark, batch, seed):
    """Few texts, so that talks share openings; one talk of 300 turns and one opening of most talks; nulls."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(-105, -95), *range(0, 130), *range(190, 215), 5_000_000_000]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 7, 9])):
            rows.append((c, t if t or rng.random() < 0.5 else None, rng.choice(["user", None, ""]), rng.choice(["a", "bb", "é\U0001f600", None, ""])))
        if c % 3 == 0:
            rows.append((c, 100, "user", "same"))
    rows += [(200, 1000 + t, "user", "x") for t in range(300)] + [(None, 0, "user", "lost"), (211, None, None, None)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert found(trie.prefix_trie(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_every_talk_the_same_and_very_long_text(spark):
    rows = [(c, t, "user", "z" * 300_000 if t == 7 else f"t{t}") for c in range(1, 90) for t in range(8)]
    assert found(trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_single_and_turnless_talks(spark):
    for rows in ([(7, None, None, None)], [(c, 0, "u", "t") for c in (1, 2, 3, 4, 8)], [(0, 0, "", "")]):
        assert found(trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert found(trie.prefix_trie(frame(spark, [(1, 1, "a", "b")]).limit(0))) == []
