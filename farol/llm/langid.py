"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts of the training texts are summed in Spark per (language, bucket); the matrix of log probabilities, languages times
2**BITS for each n-gram length, is broadcast, and a text's score is the sum of the rows of its n-grams, found by numpy.
Only the model is fitted on a sample of at most TRAIN labelled rows; every row is scored over its whole text.

A null text or one without a letter gives `und` with score 0. Without a labelled row every text gives `und`. Rows with a null
language teach nothing; null and repeated ids stay as they are. Equal scores go to the language first in order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm import kit

#: Buckets per n-gram length, lengths, most labelled rows for fitting, most languages (the most frequent stay).
BITS, LENGTHS, TRAIN, LANGUAGES = 15, (1, 2, 3), 8000, 256
#: Code points scored at a time.
SLICE = 1 << 20


def _buckets(text: str) -> np.ndarray:
    """Buckets of the n-grams that start in the first SLICE characters of the lower-cased text, those of each length in a range of their own."""
    codes = kit.code_points(text)
    return np.concatenate([kit.gram_buckets(codes[:SLICE + n - 1], n, BITS) + np.uint32(i << BITS) for i, n in enumerate(LENGTHS)])


def _slices(text: str):
    """Pieces that overlap by what the longest n-gram needs; each n-gram starts in one of them."""
    for start in range(0, max(1, len(text)), SLICE):
        yield text[start:start + SLICE + max(LENGTHS) - 1]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) of the labelled rows, summed per batch before they are shuffled."""
    size = len(LENGTHS) << BITS

    def work(columns):
        sums: dict[str, np.ndarray] = {}
        for text, lang in zip(*columns):
            for piece in _slices((text or "").lower()):
                sums.setdefault(lang, np.zeros(size, np.int64))[:] += np.bincount(_buckets(piece), minlength=size)
        rows = [(lang, int(b), int(v[b])) for lang, v in sums.items() for b in np.flatnonzero(v)]
        return [list(x) for x in zip(*rows)] or [[], [], []]

    part = kit.map_rows(docs.select("text", "lang"), "lang string, bucket int, n bigint", lambda: work, 4096)
    return part.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, most: int = TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities): doc_id, text and lang of the rows to learn from. The matrix has a fixed number of rows."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    names = sorted(r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect())
    size = len(LENGTHS) << BITS
    counts = np.zeros((size, len(names)), np.float64)
    at = {name: i for i, name in enumerate(names)}
    if names:
        kept = kit.sample_by_id(rows.where(F.col("lang").isin(names)), "doc_id", most)
        for r in gram_counts(kept).toLocalIterator():
            counts[r["bucket"], at[r["lang"]]] = r["n"]
    per_length = counts.reshape(len(LENGTHS), 1 << BITS, len(names)) + 0.5
    return names, np.log(per_length / per_length.sum(axis=1, keepdims=True)).reshape(size, len(names)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[Column] = ()) -> DataFrame:
    """(doc_id, kept columns, lang_pred, score) for every row; score is the posterior of the language under equal priors."""
    names, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix.T))
    inner = docs.select("doc_id", *keep, "text")
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[:-1])

    def one(text: str | None, columns: np.ndarray) -> tuple[str, float]:
        if not names or not text or next(filter(str.isalpha, text), None) is None:
            return "und", 0.0
        total = np.zeros(len(names))
        for piece in _slices(text.lower()):
            hits = _buckets(piece)
            total += [float(c[hits].sum(dtype=np.float64)) for c in columns]
        best = int(np.argmax(total))
        return names[best], float(1.0 / np.exp(total - total[best]).sum())

    def make():
        columns = shared.value
        return lambda c: [*c[:-1], *map(list, zip(*(one(t, columns) for t in c[-1])))]

    return kit.map_rows(inner, f"{head}, lang_pred string, score double", make)
