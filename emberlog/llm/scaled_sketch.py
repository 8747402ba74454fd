"""Document fingerprints: every shingle hash below a fixed fraction of the hash range is kept.

The number of hashes kept grows with the document, so sketches of very unequal documents can be
compared: the share of a short document's hashes found in a long one's estimates containment, and
the union of two sketches is the sketch of both documents together. A sketch is a sorted array of
16 hex digits (the upper half of MD5 of the words joined by one space); hex text sorts as the number
does, so "below the fraction" is a comparison with a short text.

Everything is built from Spark's own functions: no Python runs on executors.

Shingles are runs of WIDTH words; a text with fewer words is one shingle, a text without words has
none. Words are runs of bytes outside ASCII white space, with A-Z lower-cased.

Defined cases: a null text is an empty text; two empty sketches are alike (1.0) when their texts
have the same digest, otherwise 0.0; neighbours are found in the order doc_id descending (nulls
last), then text digest; a table of one row is its own neighbour; repeated rows keep their own
results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import positions, stored

WIDTH = 5
NO_ID = -(2**63)
# a quarter of the range: the first hex digit is 0 to 3
BELOW = "4"
DIGITS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text; the empty pieces before the first and after the last separator are dropped."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def sketch(words_column: str, width: int = WIDTH, below: str = BELOW) -> Column:
    """Sorted distinct hashes below the fraction, from a column that already holds the words.

    Name a stored or projected column: the lambda reads it once for every shingle.
    """
    w = F.col(words_column)

    def at(i: Column) -> Column:
        return F.substring(F.md5(F.array_join(F.slice(w, i, width), " ").cast("binary")), 1, DIGITS)

    last = F.greatest(F.size(w) - (width - 1), F.lit(1))
    hashes = F.transform(F.sequence(F.lit(1), last), at)
    kept = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(below))))
    return F.when(F.size(w) > 0, kept).otherwise(F.array().cast("array<string>"))


def fingerprint(docs: DataFrame, text: str = "text", to: str = "sketch", width: int = WIDTH, below: str = BELOW) -> DataFrame:
    """``docs`` with the sketch of a text column."""
    return docs.withColumn("_words", words(F.coalesce(F.col(text), F.lit("")))).withColumn(
        to, sketch("_words", width, below)
    ).drop("_words")


def packed(sketch: Column) -> Column:
    """A sketch as bytes, half its length as text: for shuffles and storage."""
    return F.unhex(F.array_join(sketch, ""))


def unpacked(data: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(data)), F.lit(".{%d}" % DIGITS), F.lit(0))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null when a's sketch is empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def likeness(a: Column, b: Column, same_text: Column) -> Column:
    """Estimated Jaccard similarity; ``same_text`` decides between two empty sketches."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, same_text.cast("double")).otherwise(common / F.nullif(union, F.lit(0)))


def with_next(docs: DataFrame, width: int = WIDTH, below: str = BELOW) -> DataFrame:
    """Each document beside the next one in descending doc_id order, after the last the first.

    Columns: doc_id, text, n_chars, sketch, next_sketch, next_head (as many first code points of the
    next text as a third of this one, rounded down, or all), same_text. Rows equal in doc_id and text
    are one document: each of them gets the same neighbour.

    Places come from (doc_id, digest, n_chars) alone. Of the next text only its sketch and the head that
    is asked for are sent to its neighbour.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # both sides of the last join start from these same columns and key, so texts are shuffled once for both
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text")
    )
    own = keyed.groupBy("id", "digest").agg(F.max(F.length("text")).cast("bigint").alias("n_chars"))
    spots = stored(positions(own, ["id", "digest", "n_chars"], label="sketch-order"), "sketch-ranks")
    count = spots.count()
    # the next one in descending order stands one place before; before the first place comes the last
    follower = spots.select(
        F.pmod(F.col("rank") + 1, F.lit(max(count, 1))).alias("rank"), F.col("id").alias("next_id"), F.col("digest").alias("next_digest")
    )
    pairs = stored(spots.join(follower, "rank").select(
        F.col("id").alias("to_id"), F.col("digest").alias("to_digest"), "n_chars", F.col("next_id").alias("id"),
        F.col("next_digest").alias("digest"), F.floor(F.col("n_chars") / 3).alias("take"),
    ), "sketch-pairs")
    sent = fingerprint(keyed.join(pairs, ["id", "digest"]), to="next_sketch", width=width, below=below)
    # one row for each document: what it needs of its follower, cut and packed before it is sent
    heads = sent.groupBy("to_id", "to_digest").agg(
        F.any_value("n_chars").alias("n_chars"), F.any_value("digest").alias("next_digest"),
        F.any_value(F.expr("substring(text, 1, take)")).alias("next_head"), F.any_value(packed(F.col("next_sketch"))).alias("next_sketch"),
    )
    both = keyed.join(heads, (F.col("id") == F.col("to_id")) & (keyed["digest"] == F.col("to_digest")))
    return fingerprint(both, width=width, below=below).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "text", "n_chars", "sketch", unpacked(F.col("next_sketch")).alias("next_sketch"),
        "next_head", (keyed["digest"] == F.col("next_digest")).alias("same_text"),
    )


def edited(pairs: DataFrame) -> DataFrame:
    """Adds ``edited``: the last third of the text (code points, rounded down) replaced by next_head."""
    return pairs.withColumn("edited", F.expr("concat(substring(text, 1, n_chars - n_chars div 3), next_head)"))
