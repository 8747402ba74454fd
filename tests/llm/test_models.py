"""Trained operators against plain computations from the same rows, hot-key joins, and the kept flag of near duplicates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import common, language_svm, minmax_dedup, quality_qda, skew

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    return common.settle(spark)


@pytest.fixture(scope="module")
def docs(session):
    return common.table(session, SF, "documents")


def test_quality_scores_equal_a_plain_discriminant(session, docs):
    labels = common.table(session, SF, "labels").select("doc_id", "quality")
    features = quality_qda.stored_features(docs)
    model = quality_qda.fit(features, labels)
    x = {r["doc_id"]: np.array(r["x"]) for r in features.collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.filter(~quality_qda.held_out(F.col("doc_id"))).collect()}
    rows = [np.array([x[d] for d, q in marks.items() if d in x and q == c]) for c in (0, 1)]
    every = np.array(list(x.values()))
    covs = [np.cov(r.T, bias=True) for r in rows]
    pooled = sum(len(r) * c for r, c in zip(rows, covs, strict=True)) / sum(map(len, rows))
    pooled = pooled + quality_qda.TO_DIAGONAL * np.diag(np.maximum(np.diag(pooled), 1e-6))
    tried = []
    for shrink in quality_qda.SHRINKAGE:
        logs = []
        for r, cov in zip(rows, covs, strict=True):
            mixed = (1 - shrink) * cov + shrink * pooled
            mixed = (1 - quality_qda.TO_DIAGONAL) * mixed + quality_qda.TO_DIAGONAL * np.diag(np.maximum(np.diag(mixed), 1e-6)) + 1e-9 * np.eye(len(mixed))
            away = every - r.mean(0)
            # Mahalanobis distance and log determinant without factors
            logs.append(-0.5 * (away * np.linalg.solve(mixed, away.T).T).sum(1) - 0.5 * np.linalg.slogdet(mixed)[1])
        tried.append(np.abs(logs[1] - logs[0] - model.difference(every)).max() / np.abs(logs[1] - logs[0]).max())
    assert min(tried) < 1e-6
    curve = 1 / (1 + np.exp(-np.clip(model.slope * model.difference(every) + model.offset, -700, 700)))
    got = {r["doc_id"]: r["s"] for r in features.select("doc_id", quality_qda.scorer(model)("x").alias("s")).collect()}
    assert np.allclose([got[d] for d in x], curve)


def plain_choice(level, x):
    """The pair machines one after the other: most votes, then the larger sum of margins."""
    votes, sums = dict.fromkeys(level.names, 0), dict.fromkeys(level.names, 0.0)
    for (a, b), w in zip(level.pairs, level.weights if level.pairs else [], strict=True):
        margin = float(np.dot(x.astype(np.float64), w[:-1].astype(np.float64)) + w[-1])
        votes[level.names[a if margin >= 0 else b]] += 1
        sums[level.names[a]] += margin
        sums[level.names[b]] -= margin
    return max(level.names, key=lambda n: (votes[n], sums[n]))


def test_languages_equal_machines_asked_one_by_one(session, docs):
    model = language_svm.fit(docs.select("doc_id", "text", "lang"))
    texts = [r["text"] for r in docs.select("text").collect()]
    names, _ = model.predict(texts)
    for text, name in zip(texts, names, strict=True):
        if name == language_svm.UNKNOWN:
            assert not any(c.isalpha() for c in text or "")
            continue
        x = language_svm.trigrams(text)
        assert name == plain_choice(model.within[plain_choice(model.families, x)], x)


def test_hot_keys_are_dealt_out_and_nothing_is_lost(session):
    rows = [(1, i) for i in range(3000)] + [(k, k) for k in range(2, 300)] + [(None, 5)]
    left = session.createDataFrame(rows, "k bigint, v bigint")
    right = session.createDataFrame([(k, f"r{k}") for k in range(0, 400, 2)] + [(1, "one"), (1, "two"), (None, "x")], "k bigint, name string")
    counts = left.groupBy("k").count()
    hot = skew.hot_keys(counts, ["k"], "count", len(rows))
    assert [r["k"] for r in hot.collect()] == [1]
    got = skew.salted_join(left, right, ["k"], hot)
    want = left.join(right, "k")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 6000 + 149
    kept = skew.salted_join(left, right.filter("name <> 'two'"), ["k"], hot, "left")
    assert kept.count() == len(rows) and kept.filter("name is null").count() == 150


def test_kept_is_the_rule_also_where_a_doc_id_has_two_texts(session):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join([*words, "more"])
    rows = [(5, a), (5, b), (7, b), (9, "something else altogether that stands alone here"), (None, a), (5, a)]
    df = session.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, kept string")
    got = minmax_dedup.classes(df.select("doc_id", "text")).collect()
    assert all(r["component_id"] == (9 if r["doc_id"] == 9 else 5) for r in got)
    assert sorted((str(r["doc_id"]), r["kept"]) for r in got) == [("5", True)] * 3 + [("7", False), ("9", True), ("None", False)]
    stays = minmax_dedup.deduplicated(df)
    assert stays.columns == ["doc_id", "text", "kept"] and sorted(r["doc_id"] for r in stays.collect()) == [5, 9]


def test_copies_of_one_row_leave_one(session):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    rows = [(3, text, i) for i in range(2000)] + [(4, "a b c d e f g h", 0), (4, "a b c d e f g h", 0), (5, None, 1)]
    df = session.createDataFrame(rows, "doc_id bigint, text string, place int").repartition(9)
    assert sorted(r["doc_id"] for r in minmax_dedup.deduplicated(df).collect()) == [3, 4, 5]


def test_language_features_reach_the_driver_packed(session, docs):
    text = docs.filter("text IS NOT NULL").select("text").limit(3)
    for r in text.select("text", language_svm._sparse("text").alias("v")).collect():
        assert isinstance(r["v"]["slots"], bytes | bytearray) and isinstance(r["v"]["values"], bytes | bytearray)
        x = np.zeros(1 << language_svm.BITS, np.float32)
        x[np.frombuffer(r["v"]["slots"], "<i4")] = np.frombuffer(r["v"]["values"], "<f4")
        assert np.array_equal(x, language_svm.trigrams(r["text"]))


def test_a_machine_over_some_rows_is_that_of_those_rows():
    x, rows = np.random.default_rng(3).random((700, 20), np.float32), np.arange(700) % 3 > 0
    y = np.where(np.arange(rows.sum()) % 2, 1.0, -1.0)
    assert np.array_equal(language_svm.machine(x, y, rows), language_svm.machine(x[rows], y))
