"""Toxicity by non-negative positive-unlabelled learning.

Known are some toxic texts; all others are unlabelled, toxic ones among them. With p the share of toxic texts, the risk of a
classifier over the clean ones is the unlabelled risk less p times the positive risk on the other side; where that estimate
falls below zero, the step goes the other way, so that the model can't gain from fitting the toxic texts hidden in the
unlabelled ones. The model is linear over the presence of hashed words; it is fitted by numpy on the driver
on at most POSITIVE + UNLABELLED texts, and every row is scored over its whole text.

A null or empty text has no word and gets the score of the intercept. Without a toxic example all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm import kit

#: Bounds of the sample that the model is fitted on, bits of a bucket, words that get a weight.
POSITIVE, UNLABELLED, BITS, FEATURES = 1500, 4000, 18, 4096
#: Share of the toxic texts that must hold a word.
SUPPORT = 0.012
STEPS, RATE, DECAY = 450, 0.05, 1e-3


#: Code points below U+0100 that are part of a word; above, all are but general and ideographic punctuation.
_POWERS = np.cumprod(np.full(256, 0x9E3779B1, np.uint32), dtype=np.uint32)
_WORD = np.array([chr(i).isalnum() for i in range(256)])


def grams(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's lower-cased words."""
    if not text:
        return np.empty(0, np.uint32)
    codes = kit.code_points(f" {text.lower()} ")
    inside = np.where(codes < 256, _WORD[np.minimum(codes, 255)], ((codes < 0x2000) | (codes > 0x206F)) & ((codes < 0x3000) | (codes > 0x303F)))
    starts = np.flatnonzero(~inside[:-1] & inside[1:]) + 1
    if not len(starts):
        return np.empty(0, np.uint32)
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    # A polynomial in the place within the word; what lies between two words weighs nothing.
    place = np.zeros(len(codes), np.int64)
    place[starts] = np.diff(np.append(0, starts))
    place = np.arange(len(codes)) - np.cumsum(place)
    h = np.add.reduceat(np.where(inside, codes * _POWERS[place & 255], np.uint32(0)), starts, dtype=np.uint32)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + (ends - starts).astype(np.uint32)
    return np.unique((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS))


@dataclass
class Model:
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def scorer(self):
        table = np.zeros(1 << BITS, np.float64)
        table[self.buckets] = self.weights
        return lambda text: float(_sigmoid(table[grams(text)].sum() + self.bias))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def sets_of(texts: DataFrame, most: int) -> list[np.ndarray]:
    """The word sets of (doc_id, text), at most 2**BITS numbers each, in the order of a hash of both: the same on any layout of the table.

    At most `most` rows, so that an id with very many rows stays a bounded sample.
    """
    placed = texts.select(F.xxhash64("doc_id", "text").alias("place"), "text")
    rows = kit.map_rows(placed, "place bigint, grams binary", lambda: lambda c: [c[0], [grams(t).astype(np.uint32).tobytes() for t in c[1]]])
    return [np.frombuffer(r["grams"], np.uint32) for r in rows.orderBy("place").limit(most).toLocalIterator()]


def _unlike(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets without those that share half of an 8-part minimum sketch with an earlier one: copies would make chance words look typical."""
    if not sets:
        return sets
    seeds = (np.arange(8, dtype=np.uint32) * np.uint32(0x9E3779B1)) | np.uint32(1)
    sketch = np.array([[((s ^ k) * np.uint32(0x85EBCA6B)).min() for k in seeds] if len(s) else [0] * 8 for s in sets])
    kept = np.empty(0, np.int64)
    for i, row in enumerate(sketch):
        if not (len(kept) and ((sketch[kept] == row).sum(axis=1) >= 4).any()):
            kept = np.append(kept, i)
    return [sets[i] for i in kept]


def fit_sets(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Choose the words by how much more often toxic texts hold them, then minimise the non-negative risk by Adam."""
    positive, unlabelled = _unlike(positive), _unlike(unlabelled)
    size = 1 << BITS
    count = lambda sets: np.bincount(np.concatenate([np.empty(0, np.int64), *sets]).astype(np.int64), minlength=size)
    p, u = count(positive), count(unlabelled)
    a, b = p / max(1, len(positive)), u / max(1, len(unlabelled))
    # In clean texts a word is as frequent as the unlabelled ones leave over: it has to be rare there, and its surplus in toxic
    # texts (a Poisson likelihood ratio) beyond what chance gives to any of the words tested.
    clean = np.maximum(b - prior * a, 0.0) / (1.0 - prior) + 1.0 / (len(unlabelled) + 1)
    chance = (b + 1.0 / (len(unlabelled) + 1)) * len(positive)
    surplus = p * np.log(np.maximum(p, 1) / chance) - (p - chance)
    tested = p >= max(3, SUPPORT * len(positive))
    gain = np.where(tested & (a > 5 * clean) & (surplus > np.log(max(1, tested.sum())) + 3), surplus, 0.0)
    chosen = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
    chosen = chosen[gain[chosen] > 0].astype(np.uint32)
    sets = [*positive, *unlabelled]
    found = [np.searchsorted(chosen, s[np.isin(s, chosen)]) for s in sets]
    rows, columns = np.repeat(np.arange(len(sets)), [len(f) for f in found]), np.concatenate([np.empty(0, np.int64), *found]).astype(np.int64)
    y = np.arange(len(sets)) < len(positive)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    theta, first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, theta[columns], minlength=len(sets)) + theta[-1]
        s, loss_off = _sigmoid(z), np.logaddexp(0.0, z)
        clean = loss_off[~y].sum() / n_u - prior * loss_off[y].sum() / n_p
        # Per text: derivative of the risk by z. Positive part: -prior * (1 - s); clean part: s on unlabelled, -prior * s on positive.
        off = np.where(y, -prior * s / n_p, s / n_u)
        slope = np.where(y, -prior * (1.0 - s) / n_p, 0.0) + off if clean >= 0 else -off
        g = np.append(np.bincount(columns, slope[rows], minlength=len(chosen)), slope.sum()) + DECAY * np.append(theta[:-1], 0.0) / n_u
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return Model(chosen, theta[:-1], float(theta[-1]))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """`labels` (doc_id, toxic) has the rows to learn from; what it doesn't mark as toxic is unlabelled, as are other documents.

    The share of toxic texts is that among the labelled rows. Null ids teach nothing; of repeated labels the largest counts.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic:
        return None
    chosen = kit.sample_by_id(known.where("toxic = 1").select("doc_id"), "doc_id", POSITIVE)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    rest = kit.sample_by_id(texts.where("doc_id IS NOT NULL"), "doc_id", UNLABELLED)
    return fit_sets(sets_of(texts.join(chosen, "doc_id", "left_semi"), 2 * POSITIVE), sets_of(rest, 2 * UNLABELLED), min(0.9, max(0.01, toxic / n)))


def score(docs: DataFrame, model: Model | None, keep: list[Column] = (), threshold: float = 0.7) -> DataFrame:
    """(doc_id, kept columns, score, predicted) for every row."""
    inner = docs.select("doc_id", *keep, "text")
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.bias) if model else None)

    def make():
        one = Model(*shared.value).scorer() if shared.value else lambda text: 0.0

        def work(columns):
            scores = [one(t) for t in columns[-1]]
            return [*columns[:-1], scores, [int(s >= threshold) for s in scores]]

        return work

    return kit.map_rows(inner, f"{head}, score double, predicted int", make)


def accepted(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The documents below the threshold, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.bias) if model else None)

    @F.pandas_udf("boolean")
    def fine(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = Model(*shared.value).scorer() if shared.value else lambda text: 0.0
        for texts in parts:
            yield texts.map(lambda t: one(t) < threshold if isinstance(t, str) else one(None) < threshold).astype(bool)

    return docs.where(fine(F.col("text")))
