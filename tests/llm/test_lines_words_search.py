"""Reversible line dedup, spelling variants and ranked search against brute force and edge cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from emberlog.llm import common, lexical_search, line_dedup, queries, spelling_trie

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
COMMON = "this line is in many documents"
ODD = [
    (None, None), (None, f"{COMMON}\nonly here"), (None, COMMON), (1, ""), (2, None), (3, f"{COMMON}\nshort\nshort"), (3, f"{COMMON}\nshort\nshort"),
    (4, f" \t{COMMON.upper()}\r\nÀ trailing part\n{COMMON}"), (5, "\n\n  \n"), (6, "ünïcödé lïne\x00 x\nünïcödé lïne\x00 x"), (7, "ÜNÏCÖDÉ lïne\x00 x"),
    (8, "\n".join(f"line number {i % 5000} of a long text" for i in range(20_000))), (9, "line number 17 of a long text\n日本語日本語日本語日"),
    (10, "日本語日本語日本語日\n日本語日本語日本語"), (11, "日本語日本語日本語"),
]


@pytest.fixture(scope="module")
def session(spark):
    return common.settle(spark)


@pytest.fixture(scope="module")
def docs(session):
    return common.table(session, SF, "documents").select("doc_id", "text")


@pytest.fixture(scope="module")
def odd(session):
    """Extra columns have the names the operators use themselves."""
    return session.createDataFrame([(*r, 7, b"k", "x") for r in ODD], f"{DOCS}, n bigint, doc_key binary, hi string")


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], DOCS)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def by_none(rows):
    return sorted(rows, key=lambda r: tuple((x is None, 0 if x is None else x) for x in r))


# --- lines ------------------------------------------------------------------------------------

def dedup_lines(rows):
    def lines(text):
        return (text or "").split("\n")

    def key(line):
        return re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line).translate({c: c + 32 for c in range(65, 91)})

    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in lines(text):
            if len(key(line)) >= 10:
                holders[key(line)].add((doc is None, doc or 0))
    out = []
    for doc, text in rows:
        kept = [x for x in lines(text) if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == (doc is None, doc or 0)]
        out.append((doc, len(lines(text)), len(lines(text)) - len(kept), "\n".join(kept)))
    return by_none(out)


def kept(index, df):
    return by_none([tuple(r) for r in index.kept(df).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()])


def state(index):
    return (
        sorted(tuple(r) for r in index.counts.select("hi", "lo", "refs", "low", "high", "nameless").collect()),
        sum(r["items"] for r in index.filters.collect()), index.rows,
    )


def test_cuckoo_filter_holds_what_was_inserted_and_forgets_what_was_deleted():
    rng = np.random.default_rng(3)
    hashes = rng.integers(-2**63, 2**63, 150_000, dtype=np.int64)
    one = line_dedup.CuckooFilter()
    for part in np.array_split(hashes, 7):
        one.insert(part)
    assert one.contains(hashes).all() and one.items == 150_000 and len(one.tables) == 3
    assert one.contains(rng.integers(-2**63, 2**63, 100_000, dtype=np.int64)).mean() < 3 * 8 * 1.5 / 65535
    one.delete(hashes[::2])
    assert one.contains(hashes[1::2]).all() and one.contains(hashes[::2]).mean() < 1e-3 and one.items == 75_000
    back = line_dedup.CuckooFilter(one.tables.tobytes(), one.items)
    assert back.contains(hashes[1::2]).all()


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_lines_equal_brute_force(session, request, table):
    df = request.getfixturevalue(table)
    index = line_dedup.LineIndex.empty(session).insert(df)
    assert kept(index, df) == dedup_lines(pairs_of(df))


def test_lines_in_batches_and_after_deletion(session, docs, odd):
    rows = by_none(pairs_of(docs) + pairs_of(odd))
    random.Random(4).shuffle(rows)
    batches = [rows[i::3] for i in range(3)]
    # rows with one doc_id stay together, so that a batch never repeats a stored row
    frames = [session.createDataFrame(list(dict.fromkeys(b)), DOCS) for b in batches]
    whole = session.createDataFrame(sorted({r for b in batches for r in b}, key=lambda r: (str(r[0]), r[1] or "")), DOCS)
    grown = line_dedup.LineIndex.empty(session)
    for frame in frames:
        grown = grown.insert(frame)
    assert kept(grown, whole) == dedup_lines(pairs_of(whole))
    assert state(grown.insert(frames[1])) == state(grown)
    at_once = line_dedup.LineIndex.empty(session).insert(whole)
    assert state(at_once) == state(grown)
    # deletion: as if the documents had never been there
    gone = {r[0] for r in rows if r[0] is None or r[0] % 3 == 0}
    names = session.createDataFrame([(g,) for g in gone] + [(123456789,)], "doc_id bigint")
    rest = session.createDataFrame([r for r in pairs_of(whole) if r[0] not in gone], DOCS)
    left = grown.delete(names)
    assert state(left) == state(line_dedup.LineIndex.empty(session).insert(rest))
    assert kept(left, rest) == dedup_lines(pairs_of(rest))
    # and back again
    assert kept(left.insert(whole), whole) == kept(grown, whole)
    assert kept(grown, whole) == dedup_lines(pairs_of(whole)), "an older version stays as it is"


def test_filters_grow_by_more_shards(session, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROWTH", 0.001)
    rows = [(i, f"a line of its own {i}\nline shared by two {i // 2}") for i in range(400)]
    first, second = session.createDataFrame(rows[:100], DOCS), session.createDataFrame(rows[100:], DOCS)
    index = line_dedup.LineIndex.empty(session).insert(first).insert(second)
    everything = session.createDataFrame(rows, DOCS)
    assert kept(index, everything) == dedup_lines(rows)
    assert sum(r["items"] for r in index.filters.collect()) == 600


# --- words ------------------------------------------------------------------------------------

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    of = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(of[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(of[w]), form[w] and n[form[w]]))
    return sorted(out)


def variants(df):
    return sorted(tuple(r) for r in spelling_trie.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_of_random_words(session, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 12))) for _ in range(120)] + ["aaaaaa" + "a" * i for i in range(6)]
    rows = [(rng.randrange(50), " ".join(rng.choice(stems).title() for _ in range(200))) for _ in range(40)]
    counts = ["zyxwvu", "zyxwvua", "zyxwvuab"]
    rows += [(1000 + i, " ".join([w] * 5**(i + 1))) for i, w in enumerate(counts)]
    rows += [(None, None), (None, ""), (None, "Ÿabcdefÿ×÷ abcdef_abcdef"), (7, "word " * 3)]
    df = session.createDataFrame([(*r, "x", 3) for r in rows], f"{DOCS}, word string, n int")
    expected = brute_variants(rows)
    assert variants(df) == expected
    assert any(r[1] for r in expected) and any(r[2] != r[1] for r in expected if r[1])


def test_variants_of_very_long_words(session):
    long = "abcdefgh" * 2000
    rows = [(1, f"{long} {long}x " * 5), (2, f"{long[:9000]}z{long[9000:]} {long[1:]} {long[:5]}q{long[6:]} " * 6), (3, "z" + long + " " + "ab" * 400 + " ")] + [
        (10 + i, " ".join(["ab" * 400 + "c" * (i % 2)] * 3)) for i in range(4)
    ]
    assert variants(session.createDataFrame(rows, DOCS)) == brute_variants(rows)


def test_variants_without_words(session, empty):
    assert variants(empty) == []
    assert variants(session.createDataFrame([(1, None), (None, "a bc 123")], DOCS)) == []


def test_a_busy_prefix_is_joined_without_a_shuffle(session):
    words = [f"common{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = session.createDataFrame([(i, " ".join(words)) for i in range(5)], DOCS)
    got = variants(df)
    assert got == brute_variants(pairs_of(df))
    assert max(r[4] for r in got) >= 21


# --- search -----------------------------------------------------------------------------------

def brute_search(rows, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))

    found = [(doc, collections.Counter(terms(text))) for doc, text in rows]
    found = [(doc, c, sum(c.values())) for doc, c in found if c]
    total, length = len(found), sum(n for *_, n in found)
    df = collections.Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in set(items):
        asked = collections.Counter(terms(text))
        scored = []
        for doc, c, n in found:
            m = 25 + (75 * n * total) // length
            s = sum(
                q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, q in asked.items() if t in c
            )
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return by_none(out)


def searched(df, items, k=10):
    return by_none([tuple(r) for r in lexical_search.search(df, items, k).select("item_id", "rank", "doc_id", "score").collect()])


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_search_equals_brute_force(session, docs, odd, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", block)
    items = common.table(session, SF, "benchmark").select("item_id", "text")
    asked = pairs_of(items.withColumnRenamed("item_id", "doc_id"))
    assert searched(docs, items) == brute_search(pairs_of(docs), asked)
    extra = [(1, "line lïne LINE of"), (1, "line lïne LINE of"), (2, "本語日本語日"), (3, None), (4, ""), (5, "absent"), (6, COMMON), (None, "trailing 17")]
    more = session.createDataFrame([(*r, 5, "y") for r in extra], "item_id bigint, text string, rank int, score string")
    assert searched(odd, more, 3) == brute_search(pairs_of(odd), extra, 3)


def test_search_in_blocks_of_items(session, docs, monkeypatch):
    items = common.table(session, SF, "benchmark").select("item_id", "text")
    whole = searched(docs, items)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 13)
    assert searched(docs, items) == whole


def test_search_ties_go_by_doc_id(session):
    rows = [(i, "same words here") for i in range(200, 0, -1)] + [(None, "same words here")] + [(1000 + i, "other text") for i in range(50)]
    df = session.createDataFrame(rows, DOCS).repartition(7)
    items = session.createDataFrame([(1, "same words")], "item_id bigint, text string")
    assert [r[2] for r in sorted(searched(df, items), key=lambda r: r[1])] == list(range(1, 11))


def test_search_of_nothing(session, docs, empty):
    none = session.createDataFrame([], "item_id bigint, text string")
    some = session.createDataFrame([(1, "the of and")], "item_id bigint, text string")
    assert searched(docs, none) == [] and searched(empty, some) == []
    assert searched(session.createDataFrame([(1, None), (2, "...")], DOCS), some) == []


def test_best_positions_stop_early_and_lose_nothing():
    rng = np.random.default_rng(5)
    n = 20_000
    lists, weights = [], [3, 2, 1]
    for spread in (3.0, 3.0, 3.0):
        impacts = (1000 * rng.pareto(spread, n)).astype(np.int64) + 1
        lists.append(lexical_search.ImpactList(np.arange(n), impacts))
    score = sum(w * one.at_doc for w, one in zip(weights, lists, strict=True))
    best = np.lexsort((np.arange(n), -score))[:10]
    found, scores, looked = lexical_search.best_position_search(lists, weights, n)
    assert found.tolist() == best.tolist() and scores.tolist() == score[best].tolist()
    assert looked < n // 4


def test_queries_return_the_contract(session):
    spark = session
    assert queries.REGISTRY["op11_cuckoo_lines"](spark, SF).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert dict(queries.REGISTRY["op12_trie_variants"](spark, SF).dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"
    }
    assert dict(queries.REGISTRY["op13_best_positions"](spark, SF).dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
