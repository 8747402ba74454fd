"""Every stage of the pipeline against brute force on its own input, and edge cases."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emberlog.llm import common, string_tiling, tokens
from tests.llm.test_operators import ODD, brute_classes

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_against_brute_force(spark, folder):
    docs, before = common.table(common.settle(spark), SF, "documents"), None
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, SF, "labels").collect()}
    items = [set(runs(r["text"])) for r in common.table(spark, SF, "benchmark").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, columns = rows_of(docs), docs.columns
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if name == "packing":
            break
        assert docs.columns == columns
        kept = rows_of(docs)
        assert set(kept) <= set(before) and len(kept) == len(set(kept))
        gone = set(before) - set(kept)
        if name == "quality classifier":
            assert sum(labels.get(d) == 1 for d, _ in gone) <= 0.02 * sum(v == 1 for v in labels.values())
            assert sum(labels.get(d) == 0 for d, _ in kept) <= 0.2 * sum(v == 0 for v in labels.values())
        elif name == "language ID":
            assert len(gone) <= 0.02 * len(before)
        elif name == "near-duplicates":
            assert set(kept) == {r for r, (_, best) in brute_classes(before, 80).items() if best == r[0]}
        else:
            whole = {r for r in before if any(i <= set(runs(r[1])) for i in items)}
            some = {r for r in before if any(i & set(runs(r[1])) for i in items)}
            assert whole <= gone <= some
    coder = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*i, 2], "<u4") for (d, _), i in zip(before, coder.ids([t for _, t in before]), strict=True)}
    seen = dict.fromkeys(ids, 0)
    for s in docs.collect():
        packed = np.frombuffer(s["ids"], "<u4")
        assert s["length"] == len(packed) <= 1024
        for p in s["pieces"]:
            assert (packed[p["offset"]:p["offset"] + p["length"]] == ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]).all()
            seen[p["doc_id"]] += p["length"]
    assert seen == {d: len(i) for d, i in ids.items()}


def runs(text):
    w = string_tiling.words(text)
    return [b" ".join(w[i:i + 5]) for i in range(len(w) - 4)]


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["sequence_id", "length", "pieces", "ids"]
    assert got.agg(F.sum("length")).first()[0] == got.select(F.explode("pieces").alias("p")).agg(F.sum("p.length")).first()[0] > 0


@pytest.mark.parametrize("rows", [[], ODD])
def test_odd_and_empty_tables(spark, rows):
    docs = spark.createDataFrame([(d, t, None, None, None, "x", 1) for d, t in rows], f"{COLUMNS}, rank string, key int")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name != "packing":
            assert got.columns == docs.columns and got.count() <= len(rows)
            assert name == "language ID" or got.count() or not rows
        else:
            assert (got.count() > 0) == bool(rows)


def test_language_stage_drops_what_was_never_learned(spark):
    """Unlearned languages and gibberish go, with labels or without; the clean documents beside them stay."""
    strange = [
        "Kissa nukkuu keittiön pöydällä samalla kun sade putoaa hitaasti vanhan kaupungin kaduille eikä kukaan kulje ohi.",
        "Kot śpi na stole w kuchni, podczas gdy deszcz powoli pada na ulice starego miasta i nikt nie przechodzi.",
        "O gato dorme na mesa da cozinha enquanto a chuva cai lentamente nas ruas da cidade velha e ninguém passa.",
        "Привет мир, кот спит на кухонном столе", "猫在厨房的桌子上睡觉", "xqzvkj wqpzx vvkq zzqj xkcd qwfp zxcv", "12345 %% x 99", "a a a a a a a a",
    ]
    known = common.table(common.settle(spark), "/root/testdata/sf0.01", "documents")
    rows = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(strange)]
    kept = rows_of(corpus_pipeline.language(spark, known.unionByName(spark.createDataFrame(rows, COLUMNS)), SF))
    assert not {t for d, t in kept if d < 0}
    assert len(kept) >= 0.995 * known.count()


def test_language_stage_keeps_texts_that_mix_learned_languages(spark):
    known = common.table(common.settle(spark), "/root/testdata/sf0.01", "documents")
    long = {r["lang"]: r["text"] for r in known.filter("n_chars between 1500 and 3000").collect()}
    mixed = [(-1, long["fr"] + "\n" + long["de"], None, "s", 0), (-2, long["en"] + "\n" + long["es"], None, "s", 0)]
    got = corpus_pipeline.language(spark, known.unionByName(spark.createDataFrame(mixed, COLUMNS)), SF)
    assert {d for d, _ in rows_of(got) if d < 0} == {-1, -2}
