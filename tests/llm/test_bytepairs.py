"""Byte-level BPE by tree concatenation against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from touchline.llm import bytepairs

from .test_text import EXTRA, LONG, TEXTS, docs, nothing, real, rows  # noqa: F401

MODEL = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["ab", "aab c", "'s", "'ll", " ", "  ", "\n", "\t", "é", "中文字", "\U0001f600", "!", "'", "''", "1", "23", "\x1c", "<|endoftext|>",
        "<|endo", "l", "t", "thth", "!!!", ". ", "²", "\xa0", "_", "“a”", "́"]
RUNS = [["a", "b", "th", "er"], ["!", "'", "."], [" ", "\n"], ["1", "2"], ["é", "中", "ñ"], ["a"], ["\U0001f600", "́"], ["'", "s", "l"]]


@pytest.fixture(scope="module")
def table():
    return bytepairs.ByteTable(MODEL)


def whole(table, text):
    return table.tok.encode(text, add_special_tokens=False).ids


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        some = BITS if rng.random() < 0.5 else rng.choice(RUNS)
        yield "".join(rng.choice(some) for _ in range(rng.randint(0, 120))) + "".join(rng.choice(BITS) for _ in range(rng.randint(0, 3)))


def test_table_equals_library(table, real):  # noqa: F811
    some = [t for _, t in real[1]] + [t or "" for _, t in TEXTS] + list(texts(800, 1))
    for text, ids in zip(some, table.encode(some)):
        want = whole(table, text)
        assert np.frombuffer(ids, np.uint32).tolist() == want
        assert table.decode(ids).decode() == table.tok.decode(want, skip_special_tokens=False)
    assert table.decode(np.array([255, 98], np.uint32).tobytes()).decode() == table.tok.decode([255, 98], skip_special_tokens=False)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20])
@pytest.mark.parametrize("window", [1, 16])
def test_tree_equals_library(table, monkeypatch, size, window):
    """Pieces of every size; windows that have to grow."""
    monkeypatch.setattr(bytepairs, "WINDOW", window)
    for text in texts(400, size):
        parts = table.pieces(text, size)
        assert "".join(p[0] for p in parts) == text
        ids = [np.frombuffer(x, np.uint32) for x in table.encode([p[0] for p in parts])]
        assert table.concatenate([(i, *p[1:]) for i, p in zip(ids, parts)]).tolist() == whole(table, text)


def test_long_runs_are_cut_inside(table):
    for text in ("ab" * 40_000, "a" * 70_001, " " * 50_000 + "x", "中文" * 30_000, "!" * 40_000 + "'s", "x" * 33_000 + " y"):
        parts = table.pieces(text)
        assert len(parts) > 1 and max(len(p[0]) for p in parts) <= bytepairs.PIECE + 1
        ids = [np.frombuffer(x, np.uint32) for x in table.encode([p[0] for p in parts])]
        assert table.concatenate([(i, *p[1:]) for i, p in zip(ids, parts)]).tolist() == whole(table, text)


@pytest.mark.parametrize("piece", [bytepairs.PIECE, 50])
def test_query_rows(table, docs, nothing, piece):  # noqa: F811
    found = bytepairs.encode(docs, MODEL, piece=piece)
    want = []
    for i, t in TEXTS:
        ids = whole(table, t or "")
        text = table.tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    assert rows(found) == sorted(want, key=repr)
    assert bytepairs.encode(nothing, MODEL, piece=piece).collect() == []
    assert rows(bytepairs.decode(found, MODEL)) == rows(docs.selectExpr("doc_id", "coalesce(text, '')"))
