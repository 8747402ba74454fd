"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of BLOCK words, starting every BLOCK / 2 words, so any notice of up to BLOCK / 2
words lies inside one block. A block matches a template when the share of the template's distinct
words found in it reaches the threshold. Only words that occur in some template can count, so a block
is the set of those words, and the join works as prefix joins do:

* words are ordered by the number of blocks that hold them, rarest first (counted over all blocks);
* length: a block with fewer words than a template needs is out;
* prefix: two sets that share ``need`` words share one among the first ``size - need + 1`` of each;
* position: the words left after the shared one, on the shorter side, must still reach ``need``.

The surviving pairs are checked on the full sets. Everything is built from Spark's own functions; the
templates are a parameter, and they are broadcast because their number of words is checked against
MOST_TEMPLATE_WORDS (a larger list is joined by shuffle).

Beside it stand plain phrases: places where the words of a phrase stand consecutively.

Defined cases: a null text is an empty text; texts without words have no blocks and no labels;
repeated rows and equal or null doc_ids stay rows of their own; an empty table gives an empty result;
a template without words is refused, and ``scan`` refuses one that is too long to lie inside one block
wherever it starts (33 words for blocks of 64; a longer text needs a longer ``block``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

BLOCK = 64
THRESHOLD = 0.9
MOST_TEMPLATE_WORDS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: phrases and the labels they give
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# wordings of common public license notices
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def template_sets(templates: list[tuple[str, str]], threshold: float) -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct words, words a block must share) of each template."""
    sets = [(k, label, sorted(set(text.lower().split()))) for k, (label, text) in enumerate(templates)]
    if any(not s for _, _, s in sets):
        raise ValueError("a template has no words")
    return [(k, label, s, max(1, math.ceil(round(threshold * len(s), 9)))) for k, label, s in sets]


def _starts(phrase: str) -> Column:
    parts = phrase.split()
    w = F.col("_words")

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get(w, i + k) == F.lit(p) for k, p in enumerate(parts)])

    found = F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)
    return F.when(F.array_contains(w, parts[-1]), found).otherwise(F.array().cast("array<int>"))


def blocks(docs: DataFrame, vocabulary: list[str], phrases: dict[str, str], block: int = BLOCK) -> DataFrame:
    """One stored row per document: row, doc_id, n_words, places (label -> starts), blocks (word sets)."""
    w = F.col("_words")
    step = block // 2
    count = F.greatest(F.lit(1), F.ceil((F.size(w) - block) / step) + 1).cast("int")
    sets = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda b: F.array_intersect(F.slice(w, b * step + 1, block), F.array(*map(F.lit, vocabulary))),
    )
    labels = sorted(set(phrases.values()))
    starts = {x: F.concat(*[_starts(p) for p, label in phrases.items() if label == x]) for x in labels}
    return stored(
        docs.select("doc_id", words(F.coalesce(F.col("text"), F.lit(""))).alias("_words")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size(w).cast("bigint").alias("n_words"),
            F.struct(*[starts[x].alias(x) for x in labels]).alias("places"),
            F.when(F.size(w) > 0, sets).alias("blocks"),
        ), "license-blocks",
    )


def matches(prepared: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """Every (row, block, template) whose containment reaches the threshold: row, block, label, template, containment."""
    spark = prepared.sparkSession
    sets = template_sets(templates, threshold)
    least = min(need for *_, need in sets)
    long_enough = prepared.select("row", F.posexplode("blocks").alias("block", "found"))
    frequency = long_enough.select(F.explode("found").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("in_blocks"))
    template_words = spark.createDataFrame(
        [(k, label, x, len(s), need) for k, label, s, need in sets for x in s],
        "template int, label string, word string, t_size int, need int",
    )
    ordered = stored(template_words.join(frequency, "word", "left").select(
        "*", F.struct(F.coalesce("in_blocks", F.lit(0)).alias("in_blocks"), "word").alias("key")
    ), "license-order")
    # at most one entry for each distinct word of the templates
    order = [r["word"] for r in ordered.select("word", "key").distinct().orderBy("key").collect()]
    if not order:
        order = sorted({x for _, _, s, _ in sets for x in s})
    bounded = sum(len(s) for _, _, s, _ in sets) <= MOST_TEMPLATE_WORDS
    ranks = {x: i for i, x in enumerate(order)}
    prefix_rows, full_rows = [], []
    for k, label, s, need in sets:
        by_rank = sorted(s, key=ranks.__getitem__)
        full_rows.append((k, label, by_rank, len(s), need))
        prefix_rows += [(x, k, i, len(s), need) for i, x in enumerate(by_rank[: len(s) - need + 1])]
    prefixes = spark.createDataFrame(prefix_rows, "word string, template int, t_at int, t_size int, need int")
    wholes = spark.createDataFrame(full_rows, "template int, label string, t_words array<string>, t_size int, need int")
    if bounded:
        prefixes, wholes = F.broadcast(prefixes), F.broadcast(wholes)
    # the words of a block in the global order, by filtering the ordered list
    sorted_block = F.array_intersect(F.array(*map(F.lit, order)), F.col("found"))
    able = long_enough.filter(F.size("found") >= least)
    tokens = able.select("row", "block", sorted_block.alias("found")).select(
        "row", "block", "found", F.size("found").alias("b_size"), F.posexplode("found").alias("b_at", "word")
    ).filter(F.col("b_at") <= F.col("b_size") - least)
    left = F.least(F.col("t_size") - F.col("t_at"), F.col("b_size") - F.col("b_at"))
    candidates = tokens.join(prefixes, "word").filter(
        (F.col("b_size") >= F.col("need")) & (F.col("b_at") <= F.col("b_size") - F.col("need")) & (left >= F.col("need"))
    ).select("row", "block", "found", "template").distinct()
    shared = F.size(F.array_intersect("found", "t_words"))
    return candidates.join(wholes, "template").withColumn("shared", shared).filter(F.col("shared") >= F.col("need")).select(
        "row", "block", "label", "template", (F.col("shared") / F.col("t_size")).alias("containment")
    )


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_words, places, spans, score.

    ``places`` has the starts of each phrase label, ``spans`` the matching blocks as (label, template,
    first word, containment), best first. ``score`` is 1 where a phrase stands, else the best containment.
    """
    longest = max((len(text.split()) for _, text in templates), default=0)
    if longest > block - block // 2 + 1:
        raise ValueError(f"a template of {longest} words does not fit blocks of {block} words, every {block // 2}")
    vocabulary = sorted({x for _, _, s, _ in template_sets(templates, threshold) for x in s})
    prepared = blocks(docs, vocabulary, phrases, block)
    found = matches(prepared, templates, threshold).select(
        "row", F.struct((-F.col("containment")).alias("order"), "label", "template", (F.col("block") * (block // 2)).alias("word")).alias("m")
    )
    # the blocks of one document: bounded by its own length
    per_row = found.groupBy("row").agg(F.array_sort(F.collect_list("m")).alias("m")).select(
        "row", F.transform("m", lambda m: F.struct(
            m["label"].alias("label"), m["template"].alias("template"), m["word"].alias("word"), (-m["order"]).alias("containment")
        )).alias("spans")
    )
    empty = F.array().cast("array<struct<label:string,template:int,word:int,containment:double>>")
    labels = sorted(set(phrases.values()))
    n_base = reduce(lambda a, b: a + b, [F.size(f"places.{x}") for x in labels])
    return prepared.drop("blocks").join(per_row, "row", "left").select(
        "doc_id", "n_words", "places", F.coalesce("spans", empty).alias("spans"), n_base.cast("bigint").alias("n_base"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce(F.get("spans", F.lit(0))["containment"], F.lit(0.0))).alias("score"),
    )
