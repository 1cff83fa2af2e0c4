"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote good, bad or nothing on every document. Expectation-maximisation estimates, from
how often which votes occur together in the whole corpus, how far each labeller can be trusted, and with that the
probability of each combination of votes to be good. These posterior labels train a linear scorer on hashed byte
trigrams and hashed labeller measures, which then decides about every document. No given label is used.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import slices, text_or_empty

GOOD, BAD, NONE = 0, 1, 2
SYMBOLS = "#$%&*|!{}<>~^=_\\"
_ODD_ENDS = tuple(c + " " for c in SYMBOLS) + ("!! ",)
FEATURES = 1 << 14
_PART = 256
# For each measure: bad from here on, good up to here, and the words a text needs for a vote.
LIMITS = {
    "symbols": (0.03, 0.01, 5),
    "capitals": (0.30, 0.08, 10),
    "separators": (0.10, 0.03, 10),
    "repeated_words": (0.20, 0.05, 10),
    "repeated_lines": (0.50, 0.35, 10),
    "sentence_ends": (0.50, 0.25, 20),
    "odd_ends": (0.20, 0.05, 10),
    "sameness": (0.70, 0.50, 40),
}
MEASURES = tuple(LIMITS)


@cache
def _bytes_in(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("latin-1"), np.uint8)


def measures(text: str) -> tuple[np.ndarray, int]:
    """The value of each measure, and the number of words."""
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=256)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    capitals = counts[65:91].sum()
    letters = capitals + counts[97:123].sum() + counts[192:].sum()
    bare = sum(len(w) < 3 and not w.isalnum() and not any(map(str.isalnum, w)) for w in words)
    ends = sum(map(text.count, (". ", ".\n", "! ", "!\n", "? ", "?\n"))) + text.endswith((".", "!", "?"))
    values = (
        counts[_bytes_in(SYMBOLS)].sum() / max(1, len(raw)),
        capitals / max(1, letters),
        bare / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        ends / n,
        sum(map(text.count, _ODD_ENDS)) / n,
        1 - len(set(words)) / n,
    )
    return np.array(values), len(words)


def votes(values: np.ndarray, words: int) -> list[int]:
    """A vote of each labeller."""
    limits = zip(values, LIMITS.values(), strict=True)
    return [NONE if words < least else BAD if v >= bad else GOOD if v <= good else NONE for v, (bad, good, least) in limits]


def encode_votes(some: list[int]) -> int:
    code = 0
    for vote in some:
        code = 3 * code + vote
    return code


def decode_votes(code: int) -> list[int]:
    return [code // 3**i % 3 for i in range(len(MEASURES) - 1, -1, -1)]


def posteriors(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """The probability to be good of each combination of votes, and how each labeller votes on good and bad documents.

    ``counts`` has the documents of each combination: at most 3 to the number of labellers. Starts from every bad vote
    being right nine times in ten; a labeller's chances in each class are then estimated in turn with the classes of the combinations.
    """
    codes = list(counts)
    seen = np.array([decode_votes(c) for c in codes], dtype=np.int64).reshape(-1, len(MEASURES))
    weight = np.array([counts[c] for c in codes], dtype=float)
    good = np.where((seen == BAD).any(axis=1), 0.1, 0.9)
    chance = np.ones((2, len(MEASURES), 3))  # no vote says nothing
    for _ in range(rounds):
        share = np.stack([good, 1 - good]) * weight
        prior = (1 + share.sum(axis=1)) / (2 + weight.sum())
        for y in (GOOD, BAD):
            for j in range(len(MEASURES)):
                tally = np.bincount(seen[:, j], share[y], 3)[:NONE] + 0.1
                chance[y, j, :NONE] = tally / tally.sum()
        logs = np.log(prior)[:, None] + np.log(chance[:, np.arange(len(MEASURES)), seen]).sum(axis=2)
        good = 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -500, 500)))
    return dict(zip(codes, good.tolist(), strict=True)), chance


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's hashed features: square roots of the shares of byte trigrams, and its measures."""
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    trigrams = (raw[:-2] * 65599 + raw[1:-1] * 31 * 257 + raw[2:] * 40503) * np.uint32(2654435761) >> 18
    tally = np.bincount(trigrams, minlength=FEATURES) if len(trigrams) else np.zeros(FEATURES, np.int64)
    places = np.flatnonzero(tally)
    values = np.sqrt(tally[places] / max(1, len(trigrams)))
    found, words = measures(text)
    steps = np.minimum(20, found * 40).astype(np.int64) if words >= 5 else np.full(len(found), 21)
    named = (np.arange(len(found)) * 22 + steps) * 2654435761 % (1 << 32) >> 18
    return np.concatenate([places, named]), np.concatenate([values, np.full(len(named), 0.5)])


def train(texts: list[str], good: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 1e-5) -> np.ndarray:
    """Weights of the scorer, and its constant at the end: logistic regression on posterior labels, by Adam."""
    w, m, v = np.zeros((3, FEATURES + 1))
    if not texts:
        return w
    places, values = [], []
    for text in texts:
        some, shares = features(text)
        places.append(some.astype(np.int32))
        values.append(shares)
    sizes = [len(p) for p in places]
    parts = [slice(i, i + _PART) for i in range(0, len(texts), _PART)]  # bounds what a step holds beside the features
    joined = [(np.concatenate(places[p]), np.concatenate(values[p]), np.cumsum([0, *sizes[p]])) for p in parts]
    del places, values
    for t in range(1, rounds + 1):
        step = decay * w
        for part, (place, value, ends) in zip(parts, joined, strict=True):
            score = np.add.reduceat(value * w[place], ends[:-1]) + w[-1]
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - good[part]) / len(texts)
            step[:-1] += np.bincount(place, value * np.repeat(error, np.diff(ends)), FEATURES)
            step[-1] += error.sum()
        m, v = 0.9 * m + 0.1 * step, 0.99 * v + 0.01 * step**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _each(texts: Iterator[pa.Array], of: Callable[[str], float], kind: pa.DataType) -> Iterator[pa.Array]:
    """A value for each text, taken from Arrow a bounded number of bytes at a time."""
    for some in texts:
        batch = pa.RecordBatch.from_arrays([some], names=["text"])
        yield pa.array((of(t) for part in slices([batch], "text") for t in part.column("text").to_pylist()), kind)


def _vote(text: Column) -> Column:
    @F.arrow_udf("int")
    def vote(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _each(texts, lambda t: encode_votes(votes(*measures(t))), pa.int32())

    return vote(text)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = 4000) -> tuple[dict, np.ndarray]:
    """The posterior of each combination of votes, from all documents, and the scorer's weights.

    The scorer alone is fitted on a sample: the rows whose hashed id and text fall below a bound that leaves about
    ``train_rows`` of them, at most twice as many. An empty table gives weights of zero.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    tallied = rows.groupBy(_vote(F.col("text")).alias("code")).agg(F.count("*").alias("n")).collect()  # at most 3**8 rows
    counts = {r.code: r.n for r in tallied}
    good, _ = posteriors(counts)
    if not counts:
        return good, np.zeros(FEATURES + 1)
    share = min(1.0, train_rows / sum(counts.values()))
    chosen = rows.where(F.pmod(F.xxhash64("id", "text", F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    chosen = chosen.limit(2 * train_rows).select("text", F.lit(0).alias("all"))

    def learn(table: pa.Table) -> pa.Table:
        texts = sorted(table.column("text").to_pylist())
        labels = [good.get(encode_votes(votes(*measures(t))), 0.5) for t in texts]
        return pa.table({"weights": pa.array([train(texts, np.array(labels)).tobytes()], pa.binary())})

    learned = chosen.groupBy("all").applyInArrow(learn, "weights binary").collect()
    weights = np.frombuffer(learned[0].weights) if learned else np.zeros(FEATURES + 1)
    return good, weights


def score(text: Column, weights: np.ndarray) -> Column:
    """The probability that a text is good."""

    def linear(text: str) -> float:
        places, values = features(text)
        return float(values @ weights[places] + weights[-1])

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _each(texts, linear, pa.float64())

    return 1 / (1 + F.exp(-run(text)))


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, train_rows: int = 4000
) -> DataFrame:
    """``docs`` with ``quality_score``, the probability to be good, and ``accepted``: whether it is at least ``threshold``.

    Every row gets a score, from its whole text. A null text is empty; such texts, and those of a few words, get what the
    scorer says without votes, which is what most documents are. Input columns named like the two new ones are replaced.
    Equal texts get equal scores. An empty table gives an empty result.
    """
    _, weights = fit(docs, id_col, text_col, train_rows)
    scored = docs.withColumn("quality_score", score(text_or_empty(docs[text_col]), weights))
    return scored.withColumn("accepted", F.col("quality_score") >= threshold)
