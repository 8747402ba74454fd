"""Language ID in two levels: the language family first, then the languages within it.

Both levels are one-versus-one linear support vector machines (squared hinge, L2) over hashed letter
trigrams of the whole text. Between families every pair of families is told apart; inside a family
every pair of its languages. A family of one language needs no second level.

The machines only compare learned languages with each other, so the score is their confidence times
how well the text fits what was learned: its mean log likelihood of trigrams over all learned languages,
in standard errors below what is usual for texts of the chosen one (few different trigrams allow
more), and the evidence of its different trigrams against evenly drawn ones. What is usual comes from
labelled rows judged by the other rows. A text in no learned language scores near 0, one that mixes
learned languages does not; ``Model.least`` is a threshold that correctly classified unseen rows pass.

The classifier is fitted on a bounded sample of labelled rows: about SAMPLE rows in all, the same
number expected from each language, chosen by a hash of doc_id and text; rows equal in both are one
row of it. Everything else covers all rows.

Defined cases: a null text or one without letters is ``und`` with score 0; labels of null are not
learned; a language that FAMILIES does not name is a family of its own; with one learned language
every text with letters is that language; a language of fewer than FEWEST different texts has no usual
likelihood, so every text fits it; with none every text is ``und``; equal votes go
to the larger sum of margins, then to the name; an empty table gives an empty result; extra columns
stay as they are in ``identified``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import byte_table

BITS = 12
SAMPLE = 3000
PENALTY = 8.0
ROUNDS = 60
# how usual a text is: fewest different texts to say it from, standard errors beyond the worst hundredth, nats of evidence
FEWEST = 8
SPARE = 3.0
EVIDENCE = 7.0
# a clean text has at least this share of the score that the lowest hundredth of unseen rows reaches
LENIENCE = 0.25
UNKNOWN = "und"
# fixed values: language families
FAMILIES = {
    **dict.fromkeys("af da de en fy is lb nl nn no sv yi".split(), "germanic"),
    **dict.fromkeys("ca es fr gl it la oc pt ro".split(), "romance"),
    **dict.fromkeys("be bg bs cs hr mk pl ru sk sl sr uk".split(), "slavic"),
    **dict.fromkeys("et fi hu".split(), "uralic"),
    **dict.fromkeys("lt lv".split(), "baltic"),
}
_LETTERS_ONLY = byte_table(lambda b: 97 <= b <= 122)
_LETTER = re.compile(r"[^\W\d_]")


def trigrams(text: str) -> np.ndarray:
    """Square roots of the shares of hashed trigrams, a vector of length 1."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY) + b" ", np.uint8).astype(np.uint32)
    gaps = data == 32
    keep = ~(gaps[:-1] & gaps[1:])
    data = data[np.concatenate([[True], keep])]  # runs of gaps become one
    if len(data) < 3:
        return np.zeros(1 << BITS, np.float32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    slots = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return np.sqrt(np.bincount(slots, minlength=1 << BITS) / len(slots)).astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of a linear machine over some rows of x; y is +1 or -1 for each of them. Accelerated gradient descent."""
    x = _with_bias(x, np.arange(len(x)) if rows is None else np.nonzero(rows)[0])
    y = y.astype(np.float32)
    weight = (np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * PENALTY * 100).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(6):
        v = x.T @ (weight * (x @ v))
        top = np.linalg.norm(v)
        v /= max(top, 1e-12)
    rate = np.float32(1 / (1 + 2 * top * 1.1))
    w = z = np.zeros(x.shape[1], np.float32)
    for k in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - rate * (z - 2 * (x.T @ (weight * slack * y)))
        w, z = new, new + np.float32(k / (k + 3)) * (new - w)
    return w.astype(np.float32)


def _with_bias(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rows and a column of ones: one copy, made piece by piece."""
    out = np.ones((len(rows), x.shape[1] + 1), np.float32)
    for at in range(0, len(rows), 256):
        out[at:at + 256, :-1] = x[rows[at:at + 256]]
    return out


@dataclass
class Level:
    """One-versus-one machines over some names, and the curve from margin to confidence."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    slope: float = 4.0

    @staticmethod
    def learned(x: np.ndarray, of: np.ndarray) -> Level:
        names = sorted(map(str, set(of)))
        level = Level(names, list(combinations(range(len(names)), 2)))
        if not level.pairs:
            return level
        fitted = np.arange(len(x)) % 5 > 0

        def train(rows: np.ndarray) -> np.ndarray:
            made = []
            for a, b in level.pairs:
                use = rows & ((of == names[a]) | (of == names[b]))
                made.append(machine(x, np.where(of[use] == names[a], 1.0, -1.0), use))
            return np.stack(made)

        # the curve is fitted on rows the first machines have not seen, the machines on all rows
        level.weights = train(fitted)
        chosen, margin = level.vote(x[~fitted])
        right = (np.array(names)[chosen] == of[~fitted]).astype(float)
        slopes = np.array([1.0, 2.0, 4.0, 8.0])
        p = np.clip(1 / (1 + np.exp(-np.outer(slopes, margin))), 1e-6, 1 - 1e-6)
        level.slope = float(slopes[np.argmin(-(right * np.log(p) + (1 - right) * np.log(1 - p)).sum(1))]) if len(margin) else 4.0
        level.weights = train(np.ones(len(x), bool))
        return level

    def vote(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chosen name of each row and its smallest margin against the others."""
        m = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        least = np.full((len(x), len(self.names)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            for name, margin in ((a, m[:, k]), (b, -m[:, k])):
                votes[:, name] += (margin > 0) if name == b else (margin >= 0)
                sums[:, name] += margin
                least[:, name] = np.minimum(least[:, name], margin)
        order = votes + 0.5 / (1 + np.exp(-np.clip(sums, -30, 30)))
        chosen = order.argmax(1)
        return chosen, least[np.arange(len(x)), chosen]

    def choose(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.pairs:
            return np.zeros(len(x), int), np.ones(len(x))
        chosen, margin = self.vote(x)
        return chosen, 1 / (1 + np.exp(-self.slope * margin))


@dataclass
class Usual:
    """What is usual for the texts of a language: mean log likelihood of their trigrams, and its spread
    as a variance within texts (over different trigrams) and one between them."""

    mean: float
    within: float
    between: float
    limit: float = 0.0

    @staticmethod
    def learned(mean: np.ndarray, square: np.ndarray, n: np.ndarray) -> Usual:
        # medians of the longer texts, so that a few strange rows do not stretch what is usual
        long = n >= np.median(n)
        centre = float(np.median(mean[long]))
        between = float((1.4826 * np.median(np.abs(mean[long] - centre))) ** 2)
        usual = Usual(centre, float(((square - mean**2) * n).sum() / n.sum()), between)
        usual.limit = float(np.quantile(usual.strange(mean, n), 0.99)) + SPARE
        return usual

    def strange(self, mean, n):
        """Standard errors by which a mean log likelihood over n different trigrams lies below the usual one."""
        return (self.mean - mean) / np.sqrt(self.within / np.maximum(n, 1) + self.between + 1e-6)


def _curve(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -60, 60)))


def _chances(sums: np.ndarray, rows: int) -> np.ndarray:
    return (sums + 1 / len(sums)) / (rows + 1)


@dataclass
class Known:
    """Log likelihoods of trigrams over all learned languages, each as likely as the others."""

    logs: np.ndarray
    usual: dict[str, Usual]

    @staticmethod
    def learned(x: np.ndarray, lang: np.ndarray) -> Known:
        names = sorted(set(lang))
        # one language at a time: squares of all rows would be twice the sample again
        chances = {v: _chances((x[lang == v].astype(np.float64) ** 2).sum(0), (lang == v).sum()) for v in names}
        every, usual = sum(chances.values()), {}
        for v in names:
            mine = x[lang == v].astype(np.float64) ** 2
            if len(np.unique(mine, axis=0)) < FEWEST:
                continue
            of, total = np.arange(len(mine)) % 5, mine.sum(0)
            mean, square = np.zeros(len(mine)), np.zeros(len(mine))
            for k in range(5):  # a row is judged by the other rows
                rows = of == k
                logs = np.log((every - chances[v] + _chances(total - mine[rows].sum(0), (~rows).sum())) / len(names))
                mean[rows], square[rows] = mine[rows] @ logs, mine[rows] @ logs**2
            usual[v] = Usual.learned(mean, square, (mine > 0).sum(1))
        return Known(np.log(every / len(names)), usual)

    def fit(self, x: np.ndarray, lang: str) -> np.ndarray:
        """How well texts of a language fit what is known, from 0 to 1."""
        usual = self.usual.get(lang)
        if usual is None:
            return np.ones(len(x))
        n, mean = (x > 0).sum(1), x.astype(np.float64) ** 2 @ self.logs
        # without a trigram there is no evidence either
        evidence = (mean + BITS * np.log(2)) * n
        return _curve(usual.limit - usual.strange(mean, n)) * _curve(evidence - EVIDENCE)


@dataclass
class Model:
    families: Level
    within: dict[str, Level]
    known: Known | None = None
    least: float = 0.0

    @staticmethod
    def learned(x: np.ndarray, lang: np.ndarray) -> Model:
        """A model of all rows; ``least`` comes from a model of four fifths and the rows it has not seen."""
        unseen = np.arange(len(x)) % 5 == 0
        model = Model._of(x, lang)
        if len(x) > 1:
            names, scores = Model._of(x[~unseen], lang[~unseen]).judged(x[unseen])
            right = scores[np.array(names) == lang[unseen]]
            model.least = LENIENCE * float(np.quantile(right, 0.01)) if len(right) else 0.0
        return model

    @staticmethod
    def _of(x: np.ndarray, lang: np.ndarray) -> Model:
        family = np.array([FAMILIES.get(v, v) for v in lang])
        within = {f: Level.learned(x[family == f], lang[family == f]) for f in sorted(set(family.tolist()))}
        return Model(Level.learned(x, family), within, Known.learned(x, lang))

    def judged(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(x), np.zeros(len(x))
        family, sure = self.families.choose(x)
        for k, name in enumerate(self.families.names):
            rows = np.nonzero(family == k)[0]
            if len(rows):
                level = self.within[name]
                chosen, inside = level.choose(x[rows])
                for c, lang in enumerate(level.names):
                    mine = chosen == c
                    scores[rows[mine]] = sure[rows[mine]] * inside[mine] * self.known.fit(x[rows[mine]], lang)
                    for r in rows[mine]:
                        names[r] = lang
        return names, scores

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        able = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.families.names else []
        if able:
            found, scores[able] = self.judged(np.stack([trigrams(texts[i]) for i in able]))
            for i, name in zip(able, found, strict=True):
                names[i] = name
        return names, scores


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


@F.pandas_udf(T.StructType().add("slots", T.BinaryType()).add("values", T.BinaryType()))
def _sparse(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        vectors = [trigrams(t) for t in batch]
        slots = [np.nonzero(v)[0].astype("<i4") for v in vectors]
        yield pd.DataFrame({"slots": [s.tobytes() for s in slots], "values": [v[s].astype("<f4").tobytes() for v, s in zip(vectors, slots, strict=True)]})


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs`` (doc_id, text, lang) outside the held-out part."""
    able = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    # rows equal in doc_id and text count once, so a group that shares a doc_id cannot be drawn as one or widen the sample
    able = able.select("lang", "text", F.xxhash64("doc_id", "text").alias("mix"))
    counts = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count_distinct("mix").alias("n")).collect()}  # one row per language
    if not counts:
        return Model(Level([]), {})
    each = sample / len(counts)
    chance = F.lit(0.0)
    for lang, n in counts.items():
        chance = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(chance)
    draw = F.pmod(F.xxhash64(F.lit("language"), "mix"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = able.filter(draw < chance).groupBy("lang", "mix").agg(F.first("text").alias("text")).select("lang", "mix", _sparse("text").alias("v"))
    # about SAMPLE rows of packed numbers: as lists they would be an object each in the driver's Python
    got = rows.collect()
    got.sort(key=lambda r: (r["mix"], r["lang"]))
    x = np.zeros((len(got), 1 << BITS), np.float32)
    for k, r in enumerate(got):
        x[k, np.frombuffer(r["v"]["slots"], "<i4")] = np.frombuffer(r["v"]["values"], "<f4")
    lang = np.array([r["lang"] for r in got])
    return Model.learned(x, lang) if got else Model(Level([]), {})


def predictor(model: Model):
    """A pandas function from texts to (lang, score)."""

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            names, scores = [], []
            for at in range(0, len(texts), 256):
                n, s = model.predict(texts[at:at + 256])
                names, scores = names + n, [*scores, *s]
            yield pd.DataFrame({"lang": names, "score": np.array(scores, float)})

    return predict


def identified(docs: DataFrame, model: Model, to: str = "language") -> DataFrame:
    """All columns of ``docs`` and a struct (lang, score) for its text."""
    return docs.withColumn(to, predictor(model)("text"))
