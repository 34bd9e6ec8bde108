"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words, pairs of neighbouring words and pairs one word
apart, each present or not, hashed to ``2 ** BITS`` coordinates. Every
coordinate has a learning rate of its own; an L1 penalty keeps a coordinate at
zero until its summed slopes exceed it, so the model is a short list of
coordinates and weights, at most ``2 ** BITS`` of them, that goes to all tasks.

The model is fitted on a bounded sample: of the labelled training rows, the
``sample`` ids of each label that come first by hash. The sample is chosen from
the labels alone and joined to the documents as a broadcast of that many ids, so
no text is shuffled but the sampled ones. One task reads their features as a
sorted stream, ``epochs`` times over in different orders. The intercept is moved
from the sample's share of toxic rows to that of all labelled training rows.
Scoring is a map over whole texts.

Defined results: null and blank texts get the intercept's score; rows without an
id are held out; an id labelled twice is toxic if one of its labels says so, and
is learned once, with its greatest text; null labels count as none; without
labels of both kinds the score is the smoothed share of toxic labels; repeated
rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, columns_of, per_batch, ship, staged, text_of
from landfall.llm.words import mixed, word_hashes, word_spans

BITS = 20
FEATURES = "doc_id long, toxic int, features binary"
SCORES = "doc_id long, held_out boolean, score double"
_SIGNS = bytes(c for c in range(128) if chr(c) not in string.ascii_letters + string.digits)
#: ASCII letters in lower case; blanks and every other ASCII sign as a blank.
_PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + _SIGNS, string.ascii_lowercase.encode() + b" " * len(_SIGNS))
_SALTS = [np.uint64(s) for s in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_DOWN = np.uint64(64 - BITS)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, coordinate) of every gram of the texts, repeats included."""
    plain = [t.translate(_PLAIN) for t in texts]
    begins = np.cumsum([0, *(len(t) + 1 for t in plain)])[:-1]
    blob = b" ".join(plain)
    owner = np.searchsorted(begins, word_spans(blob)[0], side="right") - 1
    words = word_hashes(blob)
    owners, coordinates = [owner], [mixed(words ^ _SALTS[0]) >> _DOWN]
    for gap, salt in ((1, _SALTS[1]), (2, _SALTS[2])):
        same = owner[gap:] == owner[:-gap]
        pairs = mixed(words[:-gap][same] * salt + words[gap:][same])
        owners.append(owner[gap:][same])
        coordinates.append(mixed(pairs ^ salt) >> _DOWN)
    return np.concatenate(owners), np.concatenate(coordinates).astype(np.int64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``grams``, each gram of a text once, in order of text and coordinate."""
    owners, coordinates = grams(texts)
    keys = np.unique(owners << BITS | coordinates)
    return keys >> BITS, keys & ((1 << BITS) - 1)


class Ftrl:
    """Weights as a function of summed slopes ``z`` and summed squared slopes ``n``, per coordinate.

    The last coordinate is the intercept; it is always present and has no penalty.
    """

    def __init__(self, size: int = 1 << BITS, alpha: float = 2.0, beta: float = 1.0, l1: float = 5.0, l2: float = 1.0) -> None:
        self.size, self.alpha, self.beta, self.l1, self.l2 = size, alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        penalty = np.where(at == self.size, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - penalty, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, coordinates: np.ndarray, label: int) -> None:
        """One step on one text, given its distinct coordinates."""
        at = np.append(coordinates, self.size)
        w = self.weights(at)
        slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        before = self.n[at]
        after = before + slope * slope
        self.z[at] += slope - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[at] = after

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates and weights that are not zero, the intercept among them."""
        w = self.weights(np.arange(self.size + 1))
        at = np.flatnonzero(w)
        return at, w[at]


class Model:
    """What scoring needs: the intercept and a short list of weights."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, intercept: float) -> None:
        self.at, self.weights, self.intercept = at.astype(np.int64), weights.astype(np.float64), float(intercept)

    def score(self, texts: list[bytes]) -> np.ndarray:
        table = np.zeros(1 << BITS)
        table[self.at] = self.weights
        owners, coordinates = grams(texts)
        felt = table[coordinates] != 0
        keys = np.unique(owners[felt] << BITS | coordinates[felt])
        sums = np.bincount(keys >> BITS, weights=table[keys & ((1 << BITS) - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.intercept, -35, 35)))


def _learned_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of training ids, one row each."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~_held_out())
    return known.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def fit(texts: DataFrame, labels: DataFrame, sample: int, epochs: int, **rates: float) -> Model:
    """The model of (doc_id, text) and (doc_id, toxic); both may hold any rows."""
    spark = texts.sparkSession
    known = staged(_learned_labels(labels), "toxic-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 2)
        return Model(np.zeros(0), np.zeros(0), np.log(share / (1 - share)))
    rank = F.xxhash64("doc_id")
    first = [known.filter(F.col("toxic") == kind).orderBy(rank, "doc_id").limit(sample) for kind in (0, 1)]
    chosen = texts.join(F.broadcast(first[0].unionByName(first[1])), "doc_id")
    once = chosen.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows in by_size(batch, "text", 4 << 20):
                owners, coordinates = features(rows["text"])
                cuts = np.searchsorted(owners, np.arange(len(rows["text"]) + 1))
                parts = [coordinates[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield {"doc_id": rows["doc_id"], "toxic": rows["toxic"], "features": parts}

    read = staged(per_batch(once, FEATURES, extract), "toxic-features")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = Ftrl(**rates)
        for batch in batches:
            for label, held in zip(batch.column("toxic").to_pylist(), batch.column("features"), strict=True):
                model.learn(np.frombuffer(held.as_buffer(), np.uint32).astype(np.int64), label)
        at, weights = model.sparse()
        yield {"at": at, "weight": weights}

    turns = read.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    stream = turns.coalesce(1).sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"), "doc_id").select("toxic", "features")
    rows = per_batch(stream, "at long, weight double", learn).collect()  # at most 2 ** BITS weights
    at, weights = np.array([r["at"] for r in rows], np.int64), np.array([r["weight"] for r in rows])
    is_gram = at < 1 << BITS
    # A label of which all ids were taken has share 1; the odds among all ids follow.
    shares = [min(1.0, sample / n) for n in (clean, toxic)]
    ship(spark)
    return Model(at[is_gram], weights[is_gram], weights[~is_gram].sum() + np.log(shares[0] / shares[1]))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
    sample: int = 12_000, epochs: int = 4, **rates: float,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    ``sample`` bounds the ids of each label that the classifier is fitted on;
    ``rates`` are those of ``Ftrl``.
    """
    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    )
    marks = columns_of(labels, doc_id=id_col, toxic=toxic_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(texts, marks, sample, epochs, **rates)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows in by_size(batch, "text", 4 << 20):
                yield {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": model.score(rows["text"])}

    done = per_batch(texts.withColumn("held_out", _held_out()), SCORES, score)
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
