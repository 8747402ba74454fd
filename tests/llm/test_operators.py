"""The corpus operators against brute force, exact round trips and edge cases."""

import bisect
import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from emberlog.llm import (
    chat_events, common, histogram_pack, language_svm, license_join, minimax_shards, minmax_dedup, quality_qda, queries, rans_blocks,
    scaled_sketch, string_tiling, tokens,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [
    (None, None), (None, "a b c d e f g"), (1, ""), (2, None), (3, "same text of seven words here ok"), (3, "same text of seven words here ok"),
    (4, "same text of seven words here ok"), (5, "  \n\t "), (6, "É é 日本語 🙂 mit license\x00x"), (7, LONG), (8, LONG + " end"), (9, "12 34"),
]


@pytest.fixture(scope="module")
def session(spark):
    return common.settle(spark)


@pytest.fixture(scope="module")
def docs(session):
    return common.table(session, SF, "documents")


@pytest.fixture(scope="module")
def odd(session):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(*r, "x", 1, b"k") for r in ODD]
    return session.createDataFrame(rows, f"{DOCS}, rank string, size int, key binary")


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], DOCS)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- shared helpers ---------------------------------------------------------------------------

def test_positions_equal_a_plain_sort(session):
    df = session.createDataFrame([(None if i % 7 == 0 else i % 50, i, i % 5) for i in range(900)], "a bigint, b bigint, w bigint")
    got = common.positions(df.repartition(5), ["a", "b"], {"before": "w"}).collect()
    rows = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(900))
    keys = [(-1 if r["a"] is None else r["a"], r["b"]) for r in rows]
    assert keys == sorted(keys)
    assert [r["before"] for r in rows] == np.cumsum([0, *[r["w"] for r in rows]])[:-1].tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(session, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in common.components(session.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert common.components(session.createDataFrame([], "a bigint, b bigint")).isEmpty()


# --- 1 near-dedup ------------------------------------------------------------------------------

def words_of(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words_of(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows, numerator):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= numerator * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[rows[i]] = (len(sets[i]), min(ids) if ids and sets[i] else rows[i][0])
    return out


def near_copies(seed, n=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    return rows + [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(10)]


@pytest.mark.parametrize("numerator", [85, 80])
@pytest.mark.parametrize("chunk", [1 << 18, 4096])
def test_dedup_equals_brute_force(session, monkeypatch, numerator, chunk):
    monkeypatch.setattr(minmax_dedup, "CHUNK", chunk)
    rows = near_copies(numerator)
    got = minmax_dedup.classes(session.createDataFrame(rows, DOCS), numerator).collect()
    expected = brute_classes(rows, numerator)
    assert {(r["doc_id"]): (r["n_shingles"], r["component_id"]) for r in got} == {k[0]: v for k, v in expected.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_dedup_of_documents_and_odd_rows(session, docs, odd, empty):
    rows = pairs_of(docs)
    expected = {k[0]: v for k, v in brute_classes(rows, 85).items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minmax_dedup.classes(docs).collect()}
    assert got == expected
    found = minmax_dedup.classes(odd).collect()
    assert len(found) == len(ODD)
    by_id = {(r["doc_id"], r["n_shingles"]): r for r in found}
    assert by_id[4, 3]["component_id"] == 3 and not by_id[4, 3]["kept"]
    assert by_id[1, 0]["component_id"] == 1 and by_id[2, 0]["kept"] and by_id[None, 3]["component_id"] is None
    assert by_id[8, 978]["component_id"] == 7
    left = minmax_dedup.deduplicated(odd)
    assert left.columns == odd.columns
    kept = sorted(pairs_of(left), key=str)
    assert len(kept) == len(set(kept)) == 9 and (3, ODD[4][1]) in kept and (8, LONG + " end") not in kept
    assert minmax_dedup.classes(empty).isEmpty() and minmax_dedup.deduplicated(empty).isEmpty()


def test_minimum_and_maximum_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for shared in (500, 900):
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - shared:2000 - shared])
        agree = (minmax_dedup.signature(a) == minmax_dedup.signature(b)).mean()
        assert abs(agree - shared / (2000 - shared)) < 0.1


# --- 2 licenses (the whole tables are compared with SQL) ----------------------------------------

def test_license_scan_of_odd_rows(session, odd, empty):
    text = "x " * 40 + "Permission is hereby granted, FREE of charge, to any person obtaining a copy\nof this software and associated documentation files (the)"
    more = session.createDataFrame([(20, text), (21, "see the MIT\n-License, or the Apache license"), (22, "released under the license of mit")], DOCS)
    got = {r["doc_id"]: r for r in license_join.scan(odd.select("doc_id", "text").unionByName(more)).collect()}
    assert got[6]["places"]["mit"] == [4] and got[6]["score"] == 1.0
    assert got[20]["spans"][0]["label"] == "mit" and got[20]["spans"][0]["containment"] >= 0.9 and got[20]["n_base"] == 0
    assert got[21]["places"]["mit"] == [2] and got[21]["places"]["apache"] == [6] and got[21]["n_base"] == 2
    assert got[22]["n_base"] == 0 and got[22]["spans"][0]["label"] == "mit"
    assert got[1]["n_words"] == 0 and got[1]["spans"] == [] and got[7]["n_words"] == 60_000
    assert license_join.scan(odd).count() == len(ODD) and license_join.scan(empty).isEmpty()
    with pytest.raises(ValueError):
        license_join.template_sets([("x", " ")], 0.9)


# --- tokens, 3 token output and 7 packing ------------------------------------------------------

STRANGE = [
    "", " ", "  a", "a  b   c\n\n d", "x \n y", "x\n  y", " lead", "trail ", "\n", "a\n", "it's I'll we'd 'tis", "a b　c", "\x1cab\x1d c",
    "Tab\tx\t\ty", "é É İ K ß ŉ", "123 4567 a1b2", "</s>[INST] ok", "<|endoftext|> x<|startoftext|>", "́a é x", "日本語 テスト",
    "a\x0bb\x0cc", "🙂 emoji🙂", "Σίσυφος ΣΑΣ", "\x00 nul\x00 a", "a b  ", "½ ²", "don't--stop...!!", "\r\n x\r",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_remembered_pieces_give_the_ids_of_whole_texts(docs, name, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2000)
    coder = tokens.Encoder(public_tokenizers.path(name))
    texts = STRANGE + [t for _, t in pairs_of(docs)] + STRANGE
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text[:50]


def test_a_job_may_remember_more_chunks(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    texts = [f"word{k % 300} common" for k in range(3000)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    for most, kept in ((None, 50), (200, 200), (1000, 302)):
        coder = tokens.Encoder(path, most)
        assert [i.tolist() for i in coder.ids(texts)] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.index) == kept or most == 1000 and len(coder.index) < 1000


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_are_encoded_as_a_fresh_tokenizer_does(name):
    path = public_tokenizers.path(name)
    plain, coder = tokenizers.Tokenizer.from_file(path), tokens.Encoder(path)
    texts = [
        *STRANGE, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|startoftext|>Y  z", "<|ENDOFTEXT|> <|endoftext|", "a\n<|endoftext|>\n b",
        "a\u3000b <|startoftext|> c\td", "é<|endoftext|>\u0301x", "<|<|endoftext|>|>",
    ]
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoders_keep_little_and_cut_signs_off_words(name, monkeypatch):
    path = public_tokenizers.path(name)
    plain, coder = tokenizers.Tokenizer.from_file(path), tokens.Encoder(path)
    texts = [
        "end. next, last.", "a.b, c.. d., e,. f,", "(x), [y]. \"z\", it's, we'll.\nnew,\ttab. \r\n", "é, ß. ŉ, ſ. İ. ", "1, 2. a1, b", " .,", ". , x", "A, B.",
        "x,\u00a0y. \x00z, \x00", "<|endoftext|>, a. <|ENDOFTEXT|>, \x00<|endoftext|> ,", "no.\x0b yes,\x0c",
    ]
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text
    # a word and the same word before a comma or full stop are remembered once
    coder.forget()
    list(coder.ids(f" {a}{b}{c} {a}{b}{c}, {a}{b}{c}. x" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"))
    assert len(coder.index) < 8**3 + 10
    # memory of the packing stage: no more than half of the 700,000 chunks of before
    assert "REMEMBERED" not in vars(histogram_pack) and tokens.REMEMBERED <= 350_000


def whole_ids(name, text):
    coder = tokens.encoder(public_tokenizers.path(name))
    return [*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("block", [1 << 18, 5000])
def test_token_files_round_trip(session, docs, odd, empty, folder, block, monkeypatch):
    monkeypatch.setattr(rans_blocks, "BLOCK", block)
    path = public_tokenizers.path("word_bpe_49k.json")
    for k, table in enumerate((docs.select("doc_id", "text").repartition(3), odd)):
        rans_blocks.write(table, f"{folder}/{k}", path)
        got = sorted(rans_blocks.read(session, f"{folder}/{k}").collect(), key=lambda r: r["start"])
        rows = sorted(pairs_of(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        coded = [(d, whole_ids("word_bpe_49k.json", t)) for d, t in rows]
        starts = np.cumsum([0, *[len(i) for _, i in coded]])[:-1].tolist()
        assert [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in got] == [
            (d, s, len(i), np.array(i, "<u4").tobytes()) for s, (d, i) in zip(starts, coded, strict=True)
        ]
    rans_blocks.write(empty, f"{folder}/none", path)
    assert rans_blocks.read(session, f"{folder}/none").isEmpty()


def test_coded_blocks_keep_their_format():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.2, 300_000) % 49_000).astype(np.uint32)
    freq = rans_blocks.scaled({int(t): int(n) for t, n in zip(*np.unique(ids, return_counts=True))})
    # arrays travel to tasks, not a dictionary; a token that fills the whole table has the largest frequency
    for ids, freq in ((ids, freq), (np.full(3000, 5, np.uint32), {5: 1 << rans_blocks.SCALE})):
        table = rans_blocks.Table.of(*rans_blocks._listed(freq))
        payload = rans_blocks.encode(ids, np.zeros(1, np.int64), np.zeros(1, bool), np.array([len(ids)]), table)
        assert rans_blocks.Block(payload).decode(rans_blocks.Table(freq)).tolist() == ids.tolist()


def test_blocks_start_anywhere_and_notice_damage(session, docs, folder):
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 300_000) % 49_000).astype(np.uint32)
    freq = rans_blocks.scaled({int(t): int(n) for t, n in zip(*np.unique(ids, return_counts=True))})
    assert sum(freq.values()) == 1 << rans_blocks.SCALE and min(freq.values()) >= 1
    table = rans_blocks.Table(freq)
    for n in (1, 2, 63, 64, 65, 1000, 300_000):
        payload = rans_blocks.encode(ids[:n], np.zeros(1, np.int64), np.ones(1, bool), np.array([n]), table)
        block = rans_blocks.Block(payload)
        assert (block.decode(table) == ids[:n]).all() and block.doc_ids == [None]
    assert len(payload) < 2 * n
    for a, b in ((0, 1), (131_071, 131_074), (200_000, 200_100), (299_999, 300_000), (5, 5)):
        assert (block.decode(table, a, b) == ids[a:b]).all()
    rans_blocks.write(docs, f"{folder}/a", public_tokenizers.path("word_bpe_49k.json"))
    bad = session.read.parquet(f"{folder}/a/blocks").withColumn("payload", F.concat("payload", F.lit(b"\x00")))
    bad.write.parquet(f"{folder}/b/blocks")
    session.read.parquet(f"{folder}/a/table").write.parquet(f"{folder}/b/table")
    with pytest.raises(Exception, match="checksum"):
        rans_blocks.read(session, f"{folder}/b").count()


@pytest.mark.parametrize("capacity,n", [(10, 60), (64, 700), (1024, 4000)])
def test_plan_is_best_fit_decreasing(capacity, n):
    rng = random.Random(capacity)
    lengths = [min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(n)]
    free, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, length)
        space = free.pop(at) if at < len(free) else capacity
        used += at == len(free) and space == capacity
        if space > length:
            bisect.insort(free, space - length)
    placed = collections.defaultdict(list)
    for length, a, b, first, each, offset in histogram_pack.plan(collections.Counter(lengths), capacity):
        for rank in range(a, b):
            placed[first + (rank - a) // each].append((offset + (rank - a) % each * length, length))
    for slots in placed.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(x for s in placed.values() for _, x in s) == sorted(lengths)
    assert len(placed) <= max(used, -(-sum(lengths) // capacity)) or len(placed) == used


def test_packing_holds_every_token_once(session, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    cut = histogram_pack.pieces(odd, path)
    placed = histogram_pack.assign(cut).collect()
    rows = collections.Counter((d, tuple(whole_ids("byte_bpe_50k.json", t))) for d, t in pairs_of(odd))
    by_doc = collections.defaultdict(list)
    for r in placed:
        by_doc[r["doc_id"], r["piece"]].append(r)
        assert 1 <= r["length"] <= 1024 and len(r["ids"]) == 4 * r["length"]
        assert r["piece"] == 0 or r["length"] == 1024
    for (doc, ids), copies in rows.items():
        first = [r for r in by_doc[doc, 0] if bytes(r["ids"]) == np.array(ids[:(len(ids) - 1) % 1024 + 1], "<u4").tobytes()]
        assert len(first) >= copies and all(r["start"] == 0 for r in first)
    assert sum(r["length"] for r in placed) == sum(len(i) * n for (_, i), n in rows.items())
    whole = histogram_pack.sequences(cut).collect()
    assert len(whole) == len({r["sequence_id"] for r in placed})
    for s in whole:
        end = 0
        for p in s["pieces"]:
            assert p["offset"] == end
            end += p["length"]
        assert end == s["length"] <= 1024 and len(s["ids"]) == 4 * end
    assert histogram_pack.assign(histogram_pack.pieces(empty, path)).isEmpty() and histogram_pack.sequences(histogram_pack.pieces(empty, path)).isEmpty()


# --- 4 decontamination -------------------------------------------------------------------------

def naive_tiles(doc, item, least):
    """Longest common run of unmarked words first, then by place in the item and in the document."""
    taken = set(), set()
    out = []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and a + n not in taken[0] and b + n not in taken[1]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return sorted(out)
        out.append(best)
        taken[0].update(range(best[0], best[0] + best[2]))
        taken[1].update(range(best[1], best[1] + best[2]))


def test_tiles_are_greedy():
    a, b = [[b"%c%d" % (c, i) for i in range(40)] for c in b"ab"]
    assert string_tiling.tiles(b[:10] + a[:14], a[:14]) == [(0, 10, 14)]
    # a long match of words 5-16 leaves only words 0-4 of the shorter match of words 0-9
    item = a[:20]
    assert string_tiling.tiles(b[:3] + a[5:17] + b[3:9] + a[:10] + b[9:], item) == [(0, 21, 5), (5, 3, 12)]
    assert string_tiling.tiles(b[:3] + a[5:13] + b[3:9] + a[:10] + b[9:], item) == [(0, 17, 10)]


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_a_naive_tiler(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c"][:1 + seed % 3]
    text = lambda n: [rng.choice(letters) for _ in range(n)]
    item = text(rng.randrange(1, 30))
    doc = text(rng.randrange(1, 40)) + item[rng.randrange(len(item)):] + text(5)
    least = rng.choice([1, 2, 3, 5])
    assert string_tiling.tiles(doc, item, least) == naive_tiles(doc, item, least)


def test_texts_of_one_word_are_tiled_in_seconds(session):
    rows = [(1, "na " * 20_000), (2, "na " * 900), (3, "na " * 1100), (4, "no " * 20_000)]
    table = session.createDataFrame(rows, DOCS)
    benchmark = session.createDataFrame([(1, "na " * 2_000)], "item_id bigint, text string")
    start = time.monotonic()
    got = {r["doc_id"]: r for r in string_tiling.report(table, benchmark).collect()}
    assert time.monotonic() - start < 30
    assert {d: r["coverage"] for d, r in got.items()} == {1: 1.0, 2: 0.0, 3: 0.55, 4: 0.0} and got[1]["tiles"] == [(0, 0, 2000)]


def test_planted_passages_are_found(session, odd):
    rng = random.Random(9)
    items = [(k, " ".join(f"q{rng.randrange(10**6)}" for _ in range(40))) for k in range(5)] + [(7, "too short"), (8, None), (None, "n " * 30)]
    noise = lambda n: " ".join(f"z{rng.randrange(10**6)}" for _ in range(n))
    w = items[1][1].split()
    rows = [
        (100, f"{noise(50)} {items[0][1]} {noise(5)}"), (101, " ".join([*w[20:], *noise(9).split(), *w[:20]]).upper()),
        (102, " ".join(w[:12]) + " " + noise(30)), (103, noise(80)), (104, " ".join(f"{x}!" for x in items[2][1].split())),
    ]
    benchmark = session.createDataFrame(items, "item_id bigint, text string")
    every = session.createDataFrame(rows, DOCS).unionByName(odd.select("doc_id", "text"))
    got = {r["doc_id"]: r for r in string_tiling.report(every, benchmark).collect()}
    assert {d for d, r in got.items() if r["contaminated"]} == {100, 101, 104}
    assert got[100]["item_id"] == 0 and got[100]["coverage"] == 1.0 and got[101]["item_id"] == 1 and len(got[101]["tiles"]) == 2
    left = string_tiling.clean(every.withColumn("seed", F.lit(1)), benchmark)
    assert left.columns == ["doc_id", "text", "seed"] and left.count() == every.count() - 3
    none = session.createDataFrame([], "item_id bigint, text string")
    assert string_tiling.clean(odd, none).count() == len(ODD) and string_tiling.report(odd.limit(0), benchmark).isEmpty()


def test_documents_of_the_table(session, docs):
    benchmark = common.table(session, SF, "benchmark")
    runs = lambda t: [b" ".join(w[i:i + 5]) for w in [string_tiling.words(t)] for i in range(len(w) - 4)]
    items = {r["item_id"]: (runs(r["text"]), len(string_tiling.words(r["text"]))) for r in benchmark.collect()}
    whole = {d for d, t in pairs_of(docs) for s in [set(runs(t))] for r, _ in items.values() if set(r) <= s}
    part = {d for d, t in pairs_of(docs) for s in [set(runs(t))] for r, n in items.values() if 5 * sum(x in s for x in r) >= n / 2}
    found = {r["doc_id"] for r in string_tiling.report(docs, benchmark).filter("contaminated").collect()}
    assert whole <= found <= part


def test_items_of_few_words_count_as_a_whole(session):
    benchmark = session.createDataFrame(
        [(1, "Paris"), (2, "forty two"), (3, "one two three four"), (4, " .. "), (5, "a long item of seven words here")], "item_id bigint, text string"
    )
    texts = ["paris", "Forty-two!", "so it is: one two three four five", "two three four", "forty and two", "", "a long item of nothing", None, "in Paris forty two paris"]
    table = session.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r["doc_id"]: r for r in string_tiling.report(table, benchmark).collect()}
    assert {d: r["item_id"] for d, r in got.items() if r["contaminated"]} == {0: 1, 1: 2, 2: 3, 8: 1}
    assert got[8]["n_items"] == 2 and got[8]["tiles"] == [(0, 1, 1)] and got[2]["tiles"] == [(0, 3, 4)]
    assert {d for d, _ in pairs_of(string_tiling.clean(table, benchmark))} == {3, 4, 5, 6, 7}


def test_license_templates_longer_than_a_block_allows_are_refused(session):
    text = [f"w{i}x" for i in range(34)]
    rows = [(k, " ".join([*["pad"] * k, *text, *["pad"] * 80])) for k in range(64)]
    table = session.createDataFrame(rows, DOCS)
    with pytest.raises(ValueError, match="34 words"):
        license_join.scan(table, [("long", " ".join(text))])
    fitting = license_join.scan(table, [("long", " ".join(text[:33]))], threshold=1.0)
    assert fitting.filter(F.size("spans") > 0).count() == len(rows)
    wider = license_join.scan(table, [("long", " ".join(text))], threshold=1.0, block=68)
    assert wider.filter(F.size("spans") > 0).count() == len(rows)


# --- 5 quality, 8 language ---------------------------------------------------------------------

def test_quality_on_held_out_rows(session):
    sf = "/root/testdata/sf0.01"
    scored = queries.REGISTRY["op5_quality_qda"](session, sf).join(common.table(session, sf, "labels").dropDuplicates(["doc_id"]), "doc_id")
    rows = scored.filter("held_out").collect()
    good = np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in rows])
    assert len(rows) > 50 and good >= 0.95
    kept = [r["predicted"] for r in rows if r["quality"] == 1]
    assert np.mean(kept) >= 0.97


def test_quality_edge_cases(session, odd, empty):
    table = quality_qda.stored_features(odd)
    labels = lambda rows: session.createDataFrame(rows, "doc_id bigint, quality int")
    assert quality_qda.fit(table, labels([])).constant == 0.5
    assert quality_qda.fit(table, labels([(3, 1), (4, 1), (5, None), (7, 1)])).constant > 0.7
    some = quality_qda.fit(table, labels([(i, i % 2) for i in range(1, 10)] + [(3, 0), (3, 1), (None, 1)]))
    got = quality_qda.scored(odd, some, "s")
    assert got.columns == [*odd.columns, "s"] and got.filter("s between 0 and 1").count() == len(ODD)
    assert quality_qda.scored(empty, some).isEmpty()
    assert np.isfinite(quality_qda.features(None)).all() and (quality_qda.features("") == quality_qda.features(None)).all()


def test_language_on_held_out_rows(session):
    sf = "/root/testdata/sf0.01"
    got = queries.REGISTRY["op8_language_svm"](session, sf).join(common.table(session, sf, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(session, odd, empty):
    one = session.createDataFrame([(i, "some english words", "en") for i in range(9)] + [(10, "x", None), (11, None, "de")], f"{DOCS}, lang string")
    model = language_svm.fit(one)
    got = {(r["doc_id"], r["text"]): r["language"] for r in language_svm.identified(odd, model).collect()}
    assert got[9, "12 34"]["lang"] == "und" and got[2, None]["score"] == 0.0 and got[1, ""]["lang"] == "und"
    assert got[4, ODD[6][1]]["lang"] == "en" and got[4, ODD[6][1]]["score"] == 1.0
    nothing = language_svm.fit(one.limit(0))
    assert {r["language"]["lang"] for r in language_svm.identified(odd, nothing).collect()} == {"und"}
    assert language_svm.identified(empty, model).isEmpty()


@pytest.mark.parametrize("hot", [None, 1, 2, 3, 4, 5])
def test_language_sample_is_bounded_when_rows_share_a_doc_id(session, hot, monkeypatch):
    taken = []
    monkeypatch.setattr(language_svm.Model, "learned", staticmethod(lambda x, lang: taken.append(len(x))))
    rows = [(hot, f"shared number text {i % 300}") for i in range(900)] + [(100 + i, f"other text {i}") for i in range(300)]
    language_svm.fit(session.createDataFrame([(*r, "en") for r in rows], f"{DOCS}, lang string"), sample=100)
    shared = language_svm.held_out(F.lit(hot).cast("bigint"))
    assert 60 <= taken[0] <= 140, session.range(1).select(shared).first()


# --- 6 shards ----------------------------------------------------------------------------------

def best_capacity(sizes, shards):
    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("boundaries,split", [(4096, 64), (8, 2)])
@pytest.mark.parametrize("case", ["even", "giant", "few"])
def test_shards_are_minimax(session, monkeypatch, boundaries, split, case):
    monkeypatch.setattr(minimax_shards, "BOUNDARIES", boundaries)
    monkeypatch.setattr(minimax_shards, "SPLIT", split)
    rng = random.Random(case)
    texts = ["x" * rng.randrange(1, 200) + str(i) for i in range(3 if case == "few" else 250)]
    rows = [(i, texts[rng.randrange(len(texts))]) for i in range(400)]
    if case == "giant":
        rows += [(1000 + i, "y" * 500) for i in range(150)]
    got = minimax_shards.shard(session.createDataFrame(rows, DOCS), 8).collect()
    sizes, text_of = collections.Counter(), dict(rows)
    shard_of = collections.defaultdict(set)
    for r in got:
        sizes[r["shard"]] += r["size"]
        shard_of[text_of[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(text_of[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text_of[r["doc_id"]].encode())
    assert all(len(s) == 1 for s in shard_of.values()) and set(sizes) <= set(range(8))
    first = {}
    for d, t in rows:
        first.setdefault(t, d)
    totals = collections.Counter()
    for _, t in rows:
        totals[t] += len(t) + 1
    ordered = [totals[t] for t in sorted(first, key=first.get)]
    assert max(sizes.values()) == best_capacity(ordered, 8)
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    if case == "even":
        assert min(sizes.values()) >= 0.9 * max(sizes.values())


def test_shards_of_odd_rows(odd, empty):
    got = minimax_shards.shard(odd, 8).collect()
    assert len(got) == len(ODD) and len({r["shard"] for r in got if r["size"] == 1}) == 1
    assert minimax_shards.shard(empty, 8).isEmpty()


# --- 9 chat ------------------------------------------------------------------------------------

def test_chat_round_trip(session):
    said = ["</s>[INST] ok [/INST]", "a\\b\\", "<|im_start|>user\nx<|im_end|>", "[\\INST] \\\\ <</SYS>>", None, "", "é🙂"]
    rows = [(1, t, r, said[(t + k) % 7]) for k, r in enumerate(("user", "assistant", "system", None, "odd\nrole<s>")) for t in range(7)]
    rows += [(2, 0, "assistant", "twice")] * 2 + [(None, 3, "assistant", "n"), (3, None, "user", "late"), (3, 0, "user", "x" * 50_000)]
    table = session.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    segments = chat_events.formatted(chat_events.log_of(table))
    for r in segments.collect():
        inner = r["segment"].removeprefix(chat_events.OPEN).removesuffix(chat_events.CLOSE + "\n")
        assert not any(c in inner for c in chat_events.CONTROLS)
    got = {r["conv_id"]: r for r in chat_events.read_back(segments).collect()}
    clean = collections.defaultdict(list)
    for c, t, role, text in rows:
        clean[c].append((t if t is not None else -1, hashlib.md5(f"{role or ''}\n{text or ''}".encode()).hexdigest(), role or "", text or ""))
    for c, turns in clean.items():
        turns.sort()
        body = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] >= len(body)
    assert set(got) == set(clean)


def test_events_fold_in_sequence(session):
    log = [
        (1, "m", 3, "delta", None, "late "), (1, "m", 1, "start", "assistant", "first"), (1, "m", 2, "regenerate", None, None), (1, "m", 4, "delta", None, "words"),
        (1, "n", 9, "start", "user", "typo"), (1, "n", 11, "edit", None, "right"), (1, "o", 20, "delta", None, "no start"),
    ]
    events = session.createDataFrame(log, "conv_id bigint, message string, seq bigint, kind string, role string, text string")
    got = {r["message"]: (r["place"], r["role"], r["text"]) for r in chat_events.fold(events).collect()}
    assert got == {"m": (1, "assistant", "late words"), "n": (9, "user", "right"), "o": (20, "", "no start")}
    with pytest.raises(Exception, match="unknown kind"):
        chat_events.fold(events.withColumn("kind", F.lit("other"))).collect()
    assert chat_events.read_back(chat_events.formatted(events.limit(0))).isEmpty()


# --- 10 fingerprints (the whole tables are compared with SQL) ----------------------------------

def test_sketches_estimate_containment(session):
    rng = random.Random(4)
    a = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:600])), (3, " ".join(a[:1500] + [f"v{i}" for i in range(1500)])), (4, " ".join(a).upper())]
    got = {r["doc_id"]: set(r["sketch"]) for r in scaled_sketch.fingerprint(session.createDataFrame(rows, DOCS)).collect()}
    assert got[1] == got[4] and len(got[2] & got[1]) == len(got[2]) > 100
    assert abs(len(got[3] & got[1]) / len(got[1]) - 0.5) < 0.08 and 600 < len(got[1]) < 900
    both = session.createDataFrame(rows, DOCS)
    joined = scaled_sketch.fingerprint(both).agg(F.max_by("sketch", F.col("doc_id") == 1).alias("x"), F.max_by("sketch", F.col("doc_id") == 3).alias("y"))
    row = joined.select(F.size(scaled_sketch.merged(F.col("x"), F.col("y"))).alias("n"), scaled_sketch.containment(F.col("x"), F.col("y")).alias("c")).first()
    assert row["n"] == len(got[1] | got[3]) and abs(row["c"] - 0.5) < 0.08


def test_sketch_neighbours_of_odd_rows(session, odd, empty):
    got = scaled_sketch.edited(scaled_sketch.with_next(odd)).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["text"]): r for r in got}
    head = by[9, "12 34"]
    assert head["next_head"] == LONG[:1] and head["edited"] == "12 3" + LONG[:1]
    assert by[4, ODD[6][1]]["same_text"] and by[1, ""]["edited"] == ""
    single = scaled_sketch.with_next(session.createDataFrame([(1, "a b c d e f")], DOCS)).first()
    assert single["same_text"] and single["next_head"] == "a b"
    assert scaled_sketch.with_next(empty).isEmpty()
