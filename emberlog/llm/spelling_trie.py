"""Spelling variants: words within one edit of each other, found by walking a trie as relational joins.

1. Words are counted: each task counts the runs of letters of its texts, at most TASK_WORDS different ones at
   a time, and one aggregation adds the counts up.
2. The trie of the frequent words is a table of edges. A node is the digest of a prefix. Only prefixes where
   words end or part are nodes, so an edge carries the letters up to the next node and the number of rounds is
   that of the partings on a word's way, not its length. An edge also tells of the node it leads to: the word
   that ends there, the next letters, and the lengths of the words below.
3. The frontier holds states (word, position, node, edits), at first every word at the root, whole or without its
   first letter. A round joins the states with the edges of their nodes, on the LOOK letters a state needs: the next
   letters of the word stand below the node, or, at the price of the edit, the edge's first letter is put in or
   replaces one and the letters after it agree. Edges of several letters are compared with as many letters of the word, or
   one more or fewer. States with more than one edit are dropped, and so are those whose next letter or
   remaining length the node does not have. A state at the end of its word where a word ends is a neighbour if it
   spent its edit.
4. The form of a word is its largest neighbour, if that is RATIO times as frequent; roots are found by
   following forms, twice as far in each round.

A node where many words meet (the top of the trie, and any prefix of a HOT_SHARE-th of all words) is joined by
sending its edges to the states: at most HOT_SHARE nodes of a level, with at most one row for each LOOK letters of
the alphabet. All other states are shuffled by node. Nothing is collected but counts.

Defined cases: a null text has no words; a null doc_id takes part in the misspelling rule as ``null``; repeated
rows count each. Words differ by exactly one inserted, deleted or replaced code point. Forms go by count, then by
code points. Empty tables give empty results. Very long words cost their length. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import byte_table, stored

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SLIP = 199  # a word of a document whose checksum SLIP divides has lost a letter there
TASK_WORDS = 200_000
HOT_SHARE = 128
LOOK = 3  # letters a state compares before it takes an edge
TOP = 1  # nodes of up to so many letters are joined by sending their edges
ROOT = b"\x00" * 16
_RUNS = re.compile("[a-zÀ-ÿ]+")
# ASCII letters and everything outside ASCII stay together, the rest are gaps
_LETTERS = byte_table(lambda b: 97 <= b <= 122)


_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # bytes of letters only


def shortened(word: bytes, checksum: int) -> bytes:
    """The word without the letter its checksum names."""
    letters = word.decode()
    at = checksum % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _counted(total: Counter) -> pd.DataFrame:
    seen = {w.decode(): n for w, n in total.items() if n}
    return pd.DataFrame({"word": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter = Counter()
    crc32, plain = zlib.crc32, _PLAIN.fullmatch
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            seed = crc32(f"{'null' if doc_id is None else doc_id}:".encode())
            tokens = [t for t in (text or "").encode("utf-8", "replace").translate(_LETTERS).split() if len(t) >= LEAST_LETTERS]
            total.update(tokens)
            # tokens that are not counted as they stand: with a letter to leave out, or with other characters inside
            odd = [t for t in set(tokens) if not crc32(t, seed) % SLIP or not (t.isascii() or plain(t))]
            count = tokens.count if len(tokens) < 2000 or not odd else Counter(tokens).__getitem__
            for token in odd:
                n = count(token)
                total[token] -= n
                for word in [token] if plain(token) else [run.encode() for run in _RUNS.findall(token.decode())]:
                    checksum = crc32(word, seed)
                    total[word if checksum % SLIP else shortened(word, checksum)] += n
        if len(total) > TASK_WORDS:
            yield _counted(total)
            total.clear()
    yield _counted(total)


def words(docs: DataFrame) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = ids.mapInPandas(_count, "word string, n bigint").filter(F.char_length("word") >= LEAST_LETTERS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _part(column: str, start: Column, length: Column | int) -> Column:
    return F.substring(F.col(column), start, length if isinstance(length, Column) else F.lit(length))


def _ahead() -> Column:
    """One number for what is looked for; the columns behind it are compared after the join."""
    return F.xxhash64("node", "way", "look")


# --- the trie ---------------------------------------------------------------------------------

def _prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        every = []
        for word in batch["word"]:
            running, nodes = hashlib.blake2b(digest_size=16), []
            for letter in word:
                running.update(letter.encode())
                nodes.append(running.digest())
            every.append(nodes)
        yield pd.DataFrame({"word": batch["word"], "n": batch["n"], "nodes": every})


def trie_of(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of words (word, n) as its edges, and as edges by what a state must have to take them.

    The first has node, parent, label, depth, ends (word, n), letters, low, high, hot. The second has (node, way, look) of
    the state and the edge. On the way ``first`` the next letters of the word, LOOK of them or all that are left, are
    letters that some word has from the node on. On the way ``second`` the first letter of the edge is one the word does
    not have there, so the letters after it are compared.
    """
    total = vocabulary.count()
    paths = stored(vocabulary.mapInPandas(_prefixes, "word string, n bigint, nodes array<binary>"), "trie-paths")
    steps = paths.select("word", "n", F.posexplode("nodes").alias("depth", "node")).withColumn("depth", F.col("depth") + 1)
    size = F.char_length("word")
    ended = F.col("depth") == size
    letter = F.when(~ended, F.substring("word", F.col("depth") + 1, F.lit(1)))
    # the letters that follow a node, as one short text: each at most once
    nodes = steps.groupBy("node").agg(
        F.min("word").alias("word"), F.any_value("depth").alias("depth"), F.array_join(F.array_sort(F.collect_set(letter)), "").alias("letters"), F.count(F.lit(1)).alias("below"),
        F.max(F.when(ended, F.struct("word", "n"))).alias("ends"), F.min(size).alias("low"), F.max(size).alias("high"),
    ).filter("ends is not null or char_length(letters) > 1")
    nodes = stored(nodes, "trie-nodes")
    # the way of one word to each node: the node above it there is its parent
    on_path = paths.join(nodes.select("word").distinct(), "word", "left_semi").select("word", F.posexplode("nodes").alias("depth", "node"))
    names = nodes.select("node", F.col("word").alias("own"))
    busy = F.broadcast(nodes.filter((F.col("depth") <= TOP) | (F.col("below") * HOT_SHARE >= total)).select("node", F.col("word").alias("own")))
    kept = on_path.join(busy, "node").unionByName(
        on_path.join(busy.select("node"), "node", "left_anti").join(names, "node")
    ).withColumn("depth", F.col("depth") + 1)
    above = Window.partitionBy("word").orderBy("depth")
    passed = stored(kept.select(
        "word", "own", "node", "depth", F.coalesce(F.lag("node").over(above), F.lit(ROOT)).alias("parent"), F.coalesce(F.lag("depth").over(above), F.lit(0)).alias("from")
    ), "trie-passed")
    label = F.substring("word", F.col("from") + 1, F.col("depth") - F.col("from"))
    hot = (F.col("depth") <= TOP) | (F.col("below") * HOT_SHARE >= total)
    trie = stored(passed.filter(F.col("own") == F.col("word")).select("node", "parent", label.alias("label")).join(
        nodes.select("node", "depth", "ends", "letters", "low", "high", hot.alias("hot")), "node"
    ), "trie-edges")
    ways = F.array(*[F.struct(F.lit(way).alias("way"), _part("word", F.col("from") + k, LOOK).alias("look")) for k, way in ((1, "first"), (2, "second"))])
    edge = trie.select(
        F.col("node").alias("next"), "label", F.char_length("label").alias("size"), F.col("hot").alias("next_hot"), "ends", "letters",
        (F.col("low") - F.col("depth")).alias("least"), (F.col("high") - F.col("depth")).alias("most"),
    )
    looks = passed.select(F.col("node").alias("next"), F.col("parent").alias("node"), F.inline(ways)).distinct()
    return trie, stored(looks.join(edge, "next").withColumn("ahead", _ahead()), "trie-ways")


# --- the frontier -----------------------------------------------------------------------------

def _looks(states: DataFrame) -> DataFrame:
    """The ways each state may go: with its next letters; without an edit so far also past a letter put in or replaced."""
    here, after = (_part("word", F.col("position") + k, LOOK) for k in (1, 2))
    replaced = F.col("position") < F.char_length("word")

    def look(way: str, letters: Column, taken: int) -> Column:
        return F.struct(F.lit(way).alias("way"), letters.alias("look"), F.lit(taken).alias("taken"))

    free = F.col("edits") == 0
    match = look("first", here, 0)
    ways = F.when(free, F.array(match, look("second", here, 0), F.when(replaced, look("second", after, 1)))).otherwise(F.array(match))
    return states.select("*", F.inline_outer(ways)).filter("way is not null").withColumn("ahead", _ahead())


def _arrivals() -> Column:
    """Where a state gets along an edge it has looked at: array of (position, edits), null where it does not.

    Arrays with nulls and no lambdas: this runs for every state, as compiled code.
    """
    size, position = F.col("size"), F.col("position")

    def to(letters: Column, edits: Column) -> Column:
        return F.struct((position + letters).alias("position"), edits.alias("edits"))

    def shifted(shift: int) -> Column:
        edits = F.levenshtein(_part("word", position + 1, size + shift), F.col("label"), 1)
        return F.when((position + size + shift <= F.char_length("word")) & (edits >= 0), to(size + shift, edits))

    whole = _part("word", position + 1, size) == F.col("label")
    # past an inserted letter the rest of the edge stands in the word at once, past a replaced one a letter later
    rest = _part("word", position + 1 + F.col("taken"), size - 1) == F.substring(F.col("label"), F.lit(2), size)
    differs = (F.col("taken") == 0) | (_part("word", position + 1, 1) != F.substring("label", 1, 1))
    second, free = F.col("way") == "second", F.col("edits") == 0
    spent = F.when(second, F.when(rest & differs, to(size - 1 + F.col("taken"), F.lit(1)))).otherwise(F.when(whole, to(size, F.lit(1))))
    straight = F.when(size == 1, to(F.lit(1), F.lit(0))).otherwise(shifted(0))
    # a word without edits may also leave out its next letter where it has come to
    left_out = F.when((size == 1) | whole, F.when(position + size < F.char_length("word"), to(size + 1, F.lit(1))))
    longer = F.when(size > 1, shifted(-1)), F.when(size > 1, shifted(1))
    return F.when(free & ~second, F.array(straight, left_out, *longer)).otherwise(F.array(spent))


def _advance(states: DataFrame, edges: DataFrame, busy: DataFrame) -> DataFrame:
    """States one edge further: word, position, node, edits, hot, and the neighbour (near) where one ends.

    States at busy nodes get the edges sent to them, the others are shuffled by what they look for.
    """
    looks = _looks(states)
    keys = ("node", "way", "look")
    edges, busy = (e.withColumnsRenamed({k: f"edge_{k}" for k in keys}) for e in (edges, busy))
    met = looks.filter("hot").join(F.broadcast(busy), "ahead").unionByName(looks.filter("not hot").join(edges, "ahead"))
    same = [F.col(k) == F.col(f"edge_{k}") for k in keys]
    now = met.filter(same[0] & same[1] & same[2]).select(
        "word", "next", "next_hot", "ends", "letters", "least", "most", F.inline_outer(_arrivals())
    ).filter("position is not null")
    rest, spare = F.char_length("word") - F.col("position"), 1 - F.col("edits")
    fits = (rest + spare >= F.col("least")) & (rest - spare <= F.col("most"))
    near = F.when((rest == 0) & (F.col("edits") == 1), F.col("ends"))
    following = (rest > 0) & F.contains("letters", _part("word", F.col("position") + 1, 1))
    goes_on = (F.col("letters") != "") & ((F.col("edits") == 0) | following)
    return now.filter(fits).select(
        "word", "position", F.col("next").alias("node"), "edits", F.col("next_hot").alias("hot"), near.alias("near"), goes_on.alias("goes_on")
    ).filter("near is not null or goes_on")


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """Every pair of words (word, n) that differ by one edit, both ways: word, near (word, n)."""
    trie, keyed = trie_of(vocabulary)
    # a bounded number of nodes, with at most one row for each LOOK letters of the alphabet
    hot = trie.filter("hot").select("node").unionByName(vocabulary.sparkSession.range(1).select(F.lit(ROOT).alias("node")))
    busy = stored(keyed.join(F.broadcast(hot), "node", "left_semi"), "trie-busy")
    start = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(k).alias("edits")) for k in (0, 1)])
    states = vocabulary.select("word", F.inline(start), F.lit(ROOT).alias("node"), F.lit(True).alias("hot"))
    found = vocabulary.sparkSession.createDataFrame([], "word string, near struct<word: string, n: bigint>")
    while True:
        reached = stored(_advance(states, keyed, busy), "trie-frontier")
        found = found.unionByName(reached.filter("near is not null").select("word", "near"))
        states = reached.filter("goes_on").drop("near", "goes_on")
        if states.isEmpty():
            return stored(found.distinct(), "trie-neighbours")


def forms(vocabulary: DataFrame, near: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    best = F.min(F.struct((-F.col("near.n")).alias("less"), F.col("near.word").alias("form")))
    of = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    large = form_n >= RATIO * F.col("n")
    return vocabulary.join(of, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(large, F.col("best.form")).alias("form"), F.when(large, form_n).alias("form_n")
    )


def roots(formed: DataFrame) -> DataFrame:
    """word, root of the words that have a form. A form is RATIO times as frequent, so ways are short."""
    links = stored(formed.filter("form is not null").select("word", F.col("form").alias("root")), "trie-roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "trie-roots")
        links = step.drop("moved")
        if step.filter("moved").isEmpty():
            return links


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the frequent words of ``docs`` (doc_id, text)."""
    vocabulary = stored(words(docs), "trie-words")
    formed = stored(forms(vocabulary, neighbours(vocabulary)), "trie-forms")
    return formed.join(roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
