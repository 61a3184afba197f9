"""Text operators on small fixtures with nulls, empty, very long and repeated rows, against brute force."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from touchline.llm import decontaminate, jaccard, lines, pieces, quality, sharding, tokenfile, warc
from touchline.llm.shared import scratch, table

SF = "/root/testdata/sf0.001"
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 997} long" for i in range(30_000))
#: Names that the operators use inside or give out.
EXTRA = ["id", "row", "pos", "n", "n_tokens", "n_bytes", "n_lines", "shard", "digest", "score", "x", "part", "label", "site",
         "component_id", "__id", "__text", "__site", "__bad", "__cleaned", "__name", "__key", "__size"]

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (5, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (6, "the QUICK brown fox jumps over the lazy dog near the old river bank tomorrow"),
    (7, "two words"),
    (8, "TWO words"),
    (9, "   \n\t "),
    (10, "Été été ▁marked  double  blanks \U0001f600 \x1c <|endoftext|> don't"),
    (None, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (None, None),
    (11, LONG + " end"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{(i or 0) % 2}" if i != 7 else None, *["x"] * len(EXTRA)) for i, t in TEXTS]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def real(spark):
    d = table(spark, SF, "documents")
    return d, [(r["doc_id"], r["text"] or "") for r in d.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def nasty(n=400):
    rng = random.Random(5)
    return ["".join(rng.choice("ab .,'!▁ \n\té\U0001f600<|s>́A1²\x1d*l") for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_chunk_table_equals_whole_texts(real):
    import sentencepiece

    sp, chunks = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.ChunkTable(PIECES)
    texts = [t for _, t in real[1]] + [t or "" for _, t in TEXTS] + nasty() + ["", " ", "a ", " a", "▁", "▁▁a", "a  b"]
    assert chunks.by_chunk
    for text, (decimal, packed, decoded), n in zip(texts, chunks.encode(texts), chunks.count(texts)):
        ids = sp.encode(text)
        assert decimal == ",".join(map(str, ids)) and np.frombuffer(packed, np.int32).tolist() == ids
        assert decoded == sp.decode(ids) and n == len(ids)


def test_decoded_text_comes_from_the_joined_ids():
    chunks = pieces.ChunkTable(PIECES)
    assert [d for _, _, d in chunks.encode(["first second"])] == ["first second"]
    for joined in (chunks.ids, chunks.packed):  # a wrong join shows
        joined["first"], joined["second"] = joined["second"], joined["first"]
    assert [d for _, _, d in chunks.encode(["first second"])] == ["second first"]


def test_chunk_table_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 3)
    chunks = pieces.ChunkTable(PIECES)
    texts = ["a b c d e f", "x" * 500 + " a", "a b"]
    first = chunks.count(texts)
    assert chunks.count(texts) == first == pieces.ChunkTable(PIECES).count(texts)
    assert "x" * 500 not in chunks.ids


def test_word_table_equals_whole_texts(real):
    words = tokenfile.WordTable(WORDS)
    texts = [t for _, t in real[1]][:100] + nasty() + ["it's.'ll 's's", "İstanbul ΣΑΣ", "a\x1cb", "<|endoftext|>x"]
    assert words.by_word
    for got, e in zip(words.encode(texts), words.tok.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got, words.dtype).tolist() == e.ids


def test_words_are_learnt_apart_from_case_and_signs():
    import random

    words = tokenfile.WordTable(WORDS)
    words.encode(["Hello hello, HELLO. hello!! (hello); Été été... hello$$$ \n"])
    assert set(words.words) == {"hello", "été", ",", ".", "!!", "(hello);", "(", ");", "...", "$$$"}
    draw = random.Random(6)
    parts = ["It", "É", "ß", "a1", "9", "'", "'s", "'S", ".", ",", "?!", "$$", "|", "<|endoftext|>", "<|EndOfText|>", "-", "_", "«", "º", "\xb5", "×",
             "\u0301", "\u0130", "Σ", "\x85", "\xa0", "\u2003", "\x1c", " ", " ", " ", "\n"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 40))) for _ in range(3000)] + ["".join(draw.choices(parts[:21] + [" "] * 6, k=60)) for _ in range(3000)]
    for got, e in zip(words.encode(texts), words.tok.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got, words.dtype).tolist() == e.ids


def test_token_counts_and_cache(spark, docs, nothing, monkeypatch):
    import sentencepiece

    sp, cache = sentencepiece.SentencePieceProcessor(model_file=PIECES), scratch(spark, "cache")
    expected = sorted(((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in TEXTS), key=repr)
    assert rows(pieces.count_tokens(docs, PIECES, cache)) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in TEXTS})  # one row for each distinct content
    more = docs.unionByName(docs.limit(1).withColumn("text", __import__("pyspark").sql.functions.lit("brand new")))
    assert pieces.count_tokens(more, PIECES, cache).count() == len(TEXTS) + 1
    assert spark.read.parquet(cache).count() == stored.count() + 1 or spark.read.parquet(cache).count() == len({t or "" for _, t in TEXTS}) + 1
    assert pieces.count_tokens(nothing, PIECES, scratch(spark, "cache")).count() == 0


def test_token_counts_of_another_library(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    got = rows(pieces.count_tokens(docs, WORDS, scratch(spark, "cache")).select("doc_id", "n_tokens"))
    assert got == sorted(((i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS), key=repr)


def test_sentencepiece_round_trip(spark, docs, nothing):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = pieces.encode(docs, PIECES, texts=True)
    expected = []
    for i, t in TEXTS:
        ids = sp.encode(t or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(sp.decode(ids).encode()).hexdigest(), ids, sp.decode(ids)))
    assert rows(out) == sorted(expected, key=repr)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(out.filter("doc_id is not null"), PIECES).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in TEXTS if i is not None)
    assert pieces.encode(nothing, PIECES).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 255, 256, 257, 3000):
        for u in (1, 300, 10**9):
            for values in (np.sort(rng.integers(0, u + 1, n)), np.cumsum(rng.integers(0, 3, n))):
                ef = tokenfile.EliasFano.build(values)
                assert ef.range(0, n).tolist() == values.tolist()
                for a, z in ((0, 1), (n // 2, n), (n // 3, n // 2 + 1)):
                    assert ef.range(a, z).tolist() == values[a:z].tolist()
                if n:
                    assert ef.select(n - 1) == values[-1]
    big = tokenfile.EliasFano.build(np.arange(0, 10**6, 100))
    assert sum(p.nbytes for p in big.parts()) < 10_000 * 12 / 8  # 64-bit offsets would take 80,000 bytes


def test_token_files(spark, docs, nothing, monkeypatch):
    from tokenizers import Tokenizer

    tok, folder = Tokenizer.from_file(WORDS), scratch(spark, "files")
    manifest = tokenfile.write(docs, WORDS, folder)
    got = [tuple(r) for r in tokenfile.read(spark, folder, manifest).orderBy("start").collect()]
    assert [g[0] for g in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11]
    texts = {}
    for i, t in TEXTS:
        texts.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    at = 0
    for key, start, n, crc, ids in got:
        assert start == at and n == len(ids) and ids in texts[key]
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        texts[key].remove(ids)
        at += n
    assert not any(texts.values())
    empty = scratch(spark, "files")
    assert tokenfile.read(spark, empty, tokenfile.write(nothing, WORDS, empty)).count() == 0


def words5(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts):
    sets, parent = [(i, words5(t)) for i, t in texts], {i: i for i, _ in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            both = len(s & t)
            if i is not None and j is not None and s and 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), root(i)) for i, s in sets), key=repr)


def near_copies(n, groups, seed):
    """Groups of near copies with random edits, linked in chains as well as in stars."""
    rng, out, key = random.Random(seed), [], 0
    for _ in range(groups):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 30, 120, 200]))]
        for _ in range(n):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 10**6)}"
            out.append((key, " ".join(copy)))
            key += 1
            if rng.random() < 0.3:
                words = copy
    rng.shuffle(out)
    return out


def test_jaccard_components(spark, docs, nothing):
    assert rows(jaccard.components(docs)) == brute_components(TEXTS)
    assert jaccard.components(nothing).count() == 0
    texts = near_copies(25, 8, 1)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert rows(jaccard.components(df)) == brute_components(texts)


def test_jaccard_group_without_a_middle(spark):
    """Copies with one to six words replaced, none as the first text: links of some, many that just miss."""
    rng, words, texts = random.Random(7), [f"w{i}" for i in range(150)], []
    for i in range(90):
        copy = list(words)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            copy[at] = f"v{rng.randint(0, 10**6)}"
        texts.append((i, " ".join(copy[:rng.choice([150, 150, 130])])))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    expected = brute_components(texts)
    assert rows(jaccard.components(df)) == expected
    assert len({r[2] for r in expected}) > 5


def test_jaccard_pairs(spark):
    texts = near_copies(12, 6, 2)
    j = jaccard.Join(spark.createDataFrame(texts, "doc_id long, text string"))
    rep = {r["id"]: r["rep"] for r in j.members().collect()}
    sets, expected = {i: words5(t) for i, t in texts}, set()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if rep[a] == a and rep[b] == b and a < b and 100 * both >= 75 * len(sets[a] | sets[b]):
                expected.add((a, b, both))
    assert {(r["a"], r["b"], r["overlap"]) for r in j.pairs().collect()} == expected
    assert all(sets[i] == sets[r] for i, r in rep.items())


def test_jaccard_keep_one(docs):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    left = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert left == sorted([1, 2, 3, 4, 7, 9, 10, None, None], key=repr)


def test_shingles_do_not_depend_on_neighbours():
    texts = [t for _, t in TEXTS] + nasty(100)
    t, h = jaccard.shingles(pa.array(texts))
    for i, text in enumerate(texts):
        alone = jaccard.shingles(pa.array([text], pa.string()))[1]
        assert alone.tolist() == h[t == i].tolist() and len(alone) == len(words5(text))


ITEMS = [(1, "quick brown fox jumps over the lazy dog near the old river"), (2, "Two, words!"), (3, None), (4, "..."),
         (5, "Two, words!"), (6, "never seen in any of the training texts at all here"), (10, "lazy dog near the old river bank today")]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(texts, items, size=10):
    out = []
    for key, text in texts:
        w, hit, named = item_words(text), set(), set()
        for item, t in items:
            iw = item_words(t)
            for win in {tuple(iw[k:k + size]) for k in range(max(len(iw) - size + 1, 1))} if iw else set():
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k:k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        named.add(str(item))
        out.append((key, len(w), len(hit), sorted(named)))
    return sorted(out, key=repr)


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, tid string")
    texts = [x for x in TEXTS if x[1] is None or len(x[1]) < 10_000]
    short = docs.filter("length(text) < 10000 or text is null")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(short, items).collect()), key=repr)
    assert got == brute_hits(texts, ITEMS)
    assert decontaminate.contamination(docs, items).filter("doc_id = 4").first()["n_words"] == 60_000
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit = 0").count() == len(TEXTS)
    left = decontaminate.drop_contaminated(short, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((g[0] for g in got if g[2] == 0), key=repr)


def test_proximity(spark, docs):
    items = spark.createDataFrame([(1, "fox river")], "item_id long, text string")
    wins = decontaminate.windows(items)
    vocab, index = decontaminate.build_index(docs.filter("doc_id in (1, 6, 7)"), wins)
    ranked = decontaminate.ranked_terms(wins, vocab, index)
    assert sorted((r["id"], r["gap"]) for r in decontaminate.near_matches(index, ranked, 9).collect()) == [(1, 9), (6, 9)]
    assert decontaminate.near_matches(index, ranked, 8).count() == 0


def test_line_dedup(spark, nothing):
    menu, rest = "Home | About", "own line"
    data = [(i, f"{menu}\n{rest} {i}\n\n{menu} " if i % 2 else f"{rest} {i}", "a") for i in range(10)]
    data += [(20, menu, "b"), (21, None, "b"), (22, "", None), (23, menu, None), (24, menu, "a"), (24, menu, "a")]
    df = spark.createDataFrame([(*r, "k", "k", 7) for r in data], "doc_id long, text string, source string, __site string, n_lines string, n_chars int")
    out = {r["doc_id"]: r for r in lines.drop_boilerplate(df, ratio=0.3, min_pages=4).collect()}
    assert out[1]["text"] == "own line 1\n" and (out[1]["n_lines"], out[1]["n_dropped"]) == (4, 2)
    assert out[2]["text"] == "own line 2" and out[20]["text"] == menu and out[21]["text"] is None
    assert out[23]["text"] == menu and out[24]["text"] == "" and out[22]["text"] == ""
    cleaned = lines.clean(df, ratio=0.3, min_pages=4)
    assert cleaned.columns == df.columns and cleaned.count() == len(data)
    by_id = {r["doc_id"]: r for r in cleaned.collect()}
    assert by_id[1]["n_chars"] == 11 and by_id[2]["n_chars"] == 7 and by_id[1]["__site"] == "k"
    assert lines.clean(nothing).count() == 0


def test_line_dedup_of_rare_lines(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    data = [(i, f"own line {i}" + f"\n{passage}" * (i % 800 == 7) + "\ncopied" * (i in (1, 2)), "a") for i in range(4000)]
    data += [(5000 + i, f"own line {i}\n{passage}", "b") for i in range(2)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in lines.drop_boilerplate(df).collect()}
    assert {i for i, r in out.items() if r["n_dropped"]} == {7, 807, 1607, 2407, 3207}
    assert out[807]["text"] == "own line 807" and out[1]["text"] == "own line 1\ncopied" and passage in out[5001]["text"]
    few = df.filter("doc_id < 7 or doc_id % 800 = 7")
    assert {r["doc_id"] for r in lines.drop_boilerplate(few).filter("n_dropped > 0").collect()} == {7, 807, 1607, 2407, 3207}


def test_sharding(spark, docs, nothing):
    found = sharding.shard(docs, 100)
    by = {}
    for r in found.collect():
        by.setdefault(r["shard"], []).append(r)
    assert found.count() == len(TEXTS)
    for name, members in by.items():
        total = sum(r["n_bytes"] for r in members)
        assert all(r["shard_bytes"] == total and r["shard_rows"] == len(members) and r["depth"] == len(name) for r in members)
        assert total <= 100 or members[0]["overflow"]
    names = sorted(by)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert {r["shard"] for r in sharding.shard(docs, 1 << 30).collect()} == {""}
    assert sharding.shard(nothing, 100).count() == 0
    many = spark.range(5000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    sizes = sharding.shard(many, 2000).select("shard", "shard_bytes").distinct().collect()
    assert max(r["shard_bytes"] for r in sizes) <= 2000 and sum(r["shard_bytes"] for r in sizes) == 5000 * 49 // 2


def brute_shards(texts, limit):
    """Every row's leaf by splitting on all 60 bits of its key, one bit at a time."""
    keys = [f"{int(hashlib.md5(f'{'null' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}'.encode()).hexdigest()[:15], 16):060b}" for i, t in texts]
    sizes, out = [len((t or "").encode()) for _, t in texts], []

    def split(members, depth):
        total = sum(sizes[m] for m in members)
        if total <= limit or depth == 60:
            out.extend((texts[m][0], sizes[m], keys[m][:depth], depth, total, len(members), total > limit) for m in members)
            return
        for bit in "01":
            if side := [m for m in members if keys[m][depth] == bit]:
                split(side, depth + 1)

    split(range(len(texts)), 0)
    return sorted(out, key=repr)


def test_sharding_of_documents_above_the_limit(spark):
    from touchline.llm.queries import SHARD_BYTES

    big, half = "x" * (SHARD_BYTES + 1), "y" * (SHARD_BYTES * 2 // 3)
    texts = [(i, "z" * 5000) for i in range(500)] + [(1000, big), (1001, half), (1001, half), (None, None), (1002, "w" * SHARD_BYTES)]
    found = rows(sharding.shard(spark.createDataFrame(texts, "doc_id long, text string"), SHARD_BYTES))
    assert found == brute_shards(texts, SHARD_BYTES)
    assert {(r[0], r[3], len(r[2])) for r in found if r[6]} == {(1000, 60, 60), (1001, 60, 60)}


def test_shard_folders(spark, docs):
    path = scratch(spark, "shards")
    sharding.write_shards(docs.select("doc_id", "text", "__key"), path, 100)
    back = spark.read.parquet(path)
    assert back.count() == len(TEXTS) and back.columns == ["doc_id", "text", "__key", "__shard"]


def test_warc(spark, nothing, monkeypatch):
    big = "".join(random.Random(7).choice("abc<>\r\n") for _ in range(warc.CHUNK * 2 + 5))
    data = [(1, "http://a", "<p>x</p>"), (2, None, big), (3, "http://c\nd", big), (4, "u", None), (5, "u", ""), (None, "u", big),
            (None, "u", "alone"), (7, "u", "x" * (warc.CHUNK * 40)), (1, "http://a", "<p>x</p>"), (8, "u", "\r\n\r\n")]
    df = spark.createDataFrame([(*r, "k", 1) for r in data], "page_id long, url string, html string, sha1 string, total int").repartition(3)
    folder = scratch(spark, "warc")
    manifest = warc.write(warc.chunks(df, warc.decide(df)), folder)
    back = warc.read(spark, folder, manifest)
    first = {}
    for key, _, text in data:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    expected = []
    for key, _, text in data:
        b, f = (text or "").encode(), first.get(text or "")
        revisit = key is not None and key > f
        expected.append((key, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    assert rows(warc.pages(back)) == sorted(expected, key=repr)
    parts = [r for r in back.filter("id = 2").orderBy("chunk_no").collect()]
    assert [r["chunk_no"] for r in parts] == [0, 1, 2] and b"".join(r["data"] for r in parts).decode() == big
    so_far = hashlib.sha1()
    for r in parts:
        so_far.update(r["data"])
        assert r["sha1"] == warc.b32(so_far.digest())
    assert all(len(r["data"] or b"") <= warc.CHUNK for r in back.collect())
    assert {r["id"]: r["url"] for r in back.filter("id in (2, 3)").collect()} == {2: None, 3: "http://c d"}
    none = scratch(spark, "warc")
    pages = nothing.selectExpr("doc_id as page_id", "text as url", "text as html")
    assert warc.read(spark, none, warc.write(warc.chunks(pages, warc.decide(pages)), none)).count() == 0


def test_warc_min_bytes(spark):
    df = spark.createDataFrame([(1, "u", "same"), (2, "u", "same"), (3, "u", "much longer"), (4, "u", "much longer")], "page_id long, url string, html string")
    assert [r["id"] for r in warc.decide(df, min_bytes=5).collect()] == [4]


def test_quality(spark, docs, nothing, real):
    labels = table(spark, SF, "labels")
    d, _ = real
    out = {r["doc_id"]: r for r in quality.classify(d, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    right = [out[i]["predicted"] == q for i, q in known.items() if i in out]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out.values())
    odd = rows(quality.classify(docs, labels))
    assert len(odd) == len(TEXTS) and all(0 <= r[2] <= 1 for r in odd)
    assert quality.classify(nothing, labels).count() == 0
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {1.0}
    kept = quality.keep_good(d, labels)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["predicted"]}
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_quality_learns_nothing_from_held_out_rows(spark, real):
    from pyspark.sql import functions as F

    labels = table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    d, _ = real
    assert rows(quality.classify(d, labels)) == rows(quality.classify(d, flipped))


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t in TEXTS] + nasty(200)
    together = quality.statistics(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.allclose(together[i], quality.statistics(pa.array([text], pa.string()))[0])
