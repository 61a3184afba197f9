"""Spelling variants against every single edit of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from touchline.llm import variants
from touchline.llm.shared import store, table

from .test_text import EXTRA, TEXTS, docs, nothing  # noqa: F401

SF = "/root/testdata/sf0.01"


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(counts):
    letters = sorted(set("".join(counts)))
    near, forms = {}, {}
    for w in counts:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near[w] = [x for x in edits if x != w and x in counts]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(near[w]), counts.get(forms[w])))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_real_table(spark):
    d = table(spark, SF, "documents")
    counts = brute_words([(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()])
    got = found(variants.group_variants(d))
    assert got == brute(counts) and any(r[2] != (r[1] or r[0]) for r in got)


@pytest.mark.parametrize("rows", [1 << 17, 40])
def test_random_words_in_one_half_across_blocks(spark, monkeypatch, rows):
    """Few letters, so that words are near many; one half with a third of the words; blocks of few rows."""
    monkeypatch.setattr(variants, "BLOCK_ROWS", rows)
    monkeypatch.setattr(variants, "TOGETHER", 64)
    rng = random.Random(4)
    counts = {}
    for _ in range(700):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        counts["abab" * (rng.random() < 0.35) + w] = rng.choice([3, 4, 6, 9, 20, 50, 200])
    counts |= {"y" * 400: 3, "y" * 401: 9, "zzzzz": 3, "zzzzÿ": 3}
    vocabulary = store(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    want = [(w, n, k, c) for w, f, _, n, k, c in brute(counts)]
    got = variants.near_words(vocabulary).selectExpr("word", "n", "n_near", "if(near_n >= 2 * n, near_n, null)").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_nulls_repeats_and_empty(spark, docs, nothing):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(variants.group_variants(docs)) == brute(brute_words(rows))
    assert variants.group_variants(nothing).collect() == []
    many = [(i, t) for i, t in TEXTS for _ in range(3)]
    extra = spark.createDataFrame([(i, t, "x", "y") for i, t in many], "doc_id long, text string, word string, n string")
    assert found(variants.group_variants(extra)) == brute(brute_words(many))


def test_words_by_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.randint(1, 9), " ".join(rng.choice(["Wörter", "ÉTUDES", "etudes", "plain", "x×y÷zzz", "a_bcdefg", "ABCDEFG9"]) for _ in range(400))) for _ in range(60)]
    got = variants.words(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["word"]: r["n"] for r in got} == brute_words(rows)
