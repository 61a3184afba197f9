"""The corpus pipeline stage by stage against brute force, and the driver's entry point."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from touchline.llm import lines, quality
from touchline.llm.shared import store, table

from .test_text import PIECES, SF, brute_components, brute_hits

NAMES = ["quality_classifier", "line_dedup", "ngram_jaccard", "decontamination", "sentencepiece"]


@pytest.fixture(scope="module")
def results(spark):
    """Each stage's input and output rows, by name."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        done = store(stage(spark, docs, SF), "stage")
        assert name == NAMES[-1] or done.dtypes == docs.dtypes
        out[name] = before, done.collect()
        docs = done
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, results):
    before, after = results["quality_classifier"]
    good = {r["doc_id"] for r in quality.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).collect() if r["predicted"]}
    assert sorted(after) == sorted(r for r in before if r["doc_id"] in good)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone and sum(labels.get(i, 0) for i in gone) == 0  # no document labelled good goes


def brute_statistics(text):
    """The 11 statistics of one text, by Python's own splitting and counting."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * 11
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    stops, letters = b".,;:?'\"-()/@", max(len(re.findall(rb"[A-Za-z\x80-\xff]", raw)), 1)
    signs = sum(chr(c) in string.punctuation and c not in stops for c in raw)
    many = max(len(words), 1)
    shares = [signs / len(raw), sum(c in b"|!*#$%&" for c in raw) / many, len(re.findall(rb"[A-Z]", raw)) / letters,
              len(re.findall(rb"(?<=[A-Z])[A-Z]", raw)) / letters, len(re.findall(rb"[0-9]", raw)) / len(raw)]
    tail = [sum(a == b for a, b in zip(words, words[1:])) / many, sum(a == b for a, b in zip(words, words[2:])) / many,
            raw.count(b"\n") / many, sum(c >= 128 for c in raw) / letters]
    middle = [sum(c in stops for c in raw) / many, np.log1p(sum(map(len, words)) / many)]
    return [*np.sqrt(shares), *middle, *np.sqrt(tail)]


def brute_scores(texts, labels):
    """Each id's score by the textbook quadratic discriminant: shrunk covariances, log densities, priors."""
    x = {i: np.array(brute_statistics(t)) for i, t in texts}
    known = [(i, q) for i, q in labels if q in (0, 1) and i in x and zlib.crc32(str(i).encode()) % 4 != 2]
    groups = [np.array([x[i] for i, q in known if q == c]) for c in (0, 1)]
    own = [np.cov(g, rowvar=False, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(known)
    odds = []
    for g, c in zip(groups, own):
        c = 0.8 * c + 0.2 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + 1e-6 * np.eye(11)
        mean, prior, half_log_det = g.mean(0), np.log(len(g) / len(known)), np.linalg.slogdet(c)[1] / 2
        odds.append({i: prior - half_log_det - (v - mean) @ np.linalg.solve(c, v - mean) / 2 for i, v in x.items()})
    return {i: 1 / (1 + np.exp(-np.clip(odds[1][i] - odds[0][i], -40, 40))) for i in x}


def test_quality_stage_against_brute_force(spark, results):
    before, after = results["quality_classifier"]
    labels = [(r["doc_id"], r["quality"]) for r in table(spark, SF, "labels").collect()]
    expected = brute_scores([(r["doc_id"], r["text"]) for r in before], labels)
    got = {r["doc_id"]: r["score"] for r in quality.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    assert got.keys() == expected.keys() and got == pytest.approx(expected, rel=1e-6, abs=1e-9)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, s in expected.items() if s >= 0.7) and len(after) < len(before)


def test_quality_scores_of_classes_that_overlap(spark, results):
    # every second label turned round: scores leave 0 and 1, so every part of the model shows in them
    before = results["quality_classifier"][0]
    labels = [(r["doc_id"], 1 - r["quality"] if r["doc_id"] % 2 == 0 else r["quality"]) for r in table(spark, SF, "labels").collect()]
    expected = brute_scores([(r["doc_id"], r["text"]) for r in before], labels)
    turned = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: r["score"] for r in quality.classify(docs, turned).collect()}
    assert sum(0.05 < x < 0.95 for x in expected.values()) > 50
    assert got.keys() == expected.keys() and got == pytest.approx(expected, rel=1e-6, abs=1e-9)
    assert sorted(r["doc_id"] for r in quality.keep_good(docs, turned).collect()) == sorted(i for i, x in expected.items() if x >= 0.7)


def test_line_stage(results):
    before, after = results["line_dedup"]
    pages, seen = Counter(r["source"] for r in before), defaultdict(set)
    for r in before:
        for line in (r["text"] or "").split("\n"):
            if line.strip(" "):
                seen[r["source"], line.strip(" ")].add(r["doc_id"])
    bad = {k for k, ids in seen.items() if len(ids) >= lines.MIN_PAGES and len(ids) > lines.RATIO * pages[k[0]]}
    for old, new in zip(sorted(before), sorted(after)):
        kept = [x for x in old["text"].split("\n") if (old["source"], x.strip(" ")) not in bad]
        assert new["text"] == "\n".join(kept) and new["doc_id"] == old["doc_id"]
        assert new["n_chars"] == (len(new["text"]) if new["text"] != old["text"] else old["n_chars"])


def test_duplicate_stage(results):
    before, after = results["ngram_jaccard"]
    part = brute_components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, _, c in part if i == c)
    assert len(after) < len(before)


def test_decontamination_stage(spark, results):
    before, after = results["decontamination"]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {i for i, _, hit, _ in brute_hits([(r["doc_id"], r["text"]) for r in before], items) if not hit}
    assert {r["doc_id"] for r in after} == clean and len(clean) < len(before)


def test_token_stage(results):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    before, after = results["sentencepiece"]
    texts = {r["doc_id"]: r["text"] or "" for r in before}
    assert len(after) == len(before)
    for r in after:
        ids = sp.encode(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_stages_take_odd_documents(spark):
    rows = [(1, None, None, None, None, "k"), (2, "", "en", "s", 0, "k"), (None, "a b c", "en", "s", 5, "k"), (3, "word " * 30_000, "en", "s", 150_000, None),
            (4, "plain words here", "en", "s", 16, "k"), (4, "plain words here", "en", "s", 16, "k"), (4, "other words there", "en", None, 17, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `n.tokens` string")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF)
        if name != NAMES[-1]:
            assert out.columns == docs.columns
        n = out.count()
        assert n == (6 if name == "ngram_jaccard" else 7), name
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).columns == docs.columns


def test_entry_point_has_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert {"op3_sharding", "op5_decontamination", "op10_line_dedup"} <= set(entry.oracle_sql())
    assert public_tokenizers.path("piece_bpe_32k.model").endswith(".model")
