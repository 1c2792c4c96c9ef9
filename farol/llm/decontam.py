"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give the weights of TF-IDF.
2. The benchmark's passages are factored by a randomised SVD that Spark distributes: a random projection of the rows, its
   Gram matrix, the sums that project the rows back per word, and a small eigenproblem. Each word gets a latent vector.
3. Every window of a document is compared to all passages: the share of the passage's squared weight that the window holds, as the
   latent vectors show it and divided by what they retain of the passage. Other words around an item don't lower it. A window
   whose words can't add up to that share for any passage is left before its vector is made.
4. Whatever the latent vectors lose, a word-for-word copy is found: windows that hold one of a passage's rarest runs of words are candidates.
5. Candidates are checked on the words themselves: the longest common subsequence of the item and the words around the
   window, how much of the item's weight is there, and, for a paraphrase, whether the item's answer is: its last sentence.

A hit is a copy (COPIED of the item in order) or a paraphrase (REWORDED in order, the answer at ANSWER). Null and empty texts
hit nothing; an item without a word is never hit; repeated rows and null ids give rows like any other. An empty benchmark or
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.llm import kit

#: Word buckets, words of a window and between two, words of a benchmark passage at most.
BITS, WINDOW, STRIDE, PASSAGE = 17, 32, 16, 48
#: Latent dimensions, extra ones of the random projection, passages that are searched in one pass over the documents.
RANK, EXTRA, BLOCK = 256, 16, 20000
#: Share of a passage's squared weight in a candidate: two windows cover any passage, so one of them has half. Shares of an item that make a copy, a paraphrase, an answer; share of the item's weight that must be present.
HELD, COPIED, REWORDED, ANSWER, WEIGHT = 0.5, 0.8, 0.6, 0.8, 0.6
#: Words of a run, and places of a passage of which the rarest run is looked for.
RUN, EVERY = 4, 8
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_TABLE).split()


class Buckets(dict):
    """Bucket of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        found = self[word] = zlib.crc32(word) >> (32 - BITS)
        return found

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents per bucket). A task adds up its own counts, Spark adds up the tasks'; a number per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, df = Buckets(), np.zeros((1 << BITS) + 1, np.int64)  # the last one counts documents
        for batch in batches:
            for text in batch.column(0):
                df[np.unique(buckets.of(words(text.as_py())))] += 1
                df[-1] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], names=["bucket", "n"])

    df = np.zeros((1 << BITS) + 1, np.int64)
    found = docs.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    df[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return int(df[-1]), df[:-1]


def passages(items: DataFrame) -> DataFrame:
    """(item_id, passage, buckets): an item's words in equal parts of at most PASSAGE words."""
    kind = items.schema["item_id"].dataType.simpleString()

    def work(columns):
        out, buckets = [[], [], []], Buckets()
        for item, text in zip(*columns):
            ids = buckets.of(words(text))
            for k, part in enumerate(np.array_split(ids, max(1, -(-len(ids) // PASSAGE)))):
                if len(part):
                    for c, v in zip(out, (item, k, part.tolist())):
                        c.append(v)
        return out

    return kit.map_rows(items.select("item_id", "text"), f"item_id {kind}, passage int, buckets array<int>", lambda: work)


def _weights(ids: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their TF-IDF weights."""
    at, n = np.unique(np.array(ids, np.int64), return_counts=True)
    return at, n * idf[at]


def _sparse(ids: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their TF-IDF weights, of length one."""
    at, x = _weights(ids, idf)
    return at, x / max(np.linalg.norm(x), 1e-12)


def run_keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A key for each run of n buckets, in the order of the text."""
    last = len(ids) - n + 1
    h = ids[:last].astype(np.uint64)
    for i in range(1, n):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + ids[i:last + i].astype(np.uint64)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def rarest_runs(ids: np.ndarray, idf: np.ndarray) -> tuple[int, list[int]]:
    """(words of a run, keys): the run of most weight among every EVERY places of a passage."""
    n = min(RUN, len(ids))
    keys, mass = run_keys(ids, n), np.convolve(idf[ids], np.ones(n), "valid")
    return n, sorted({int(keys[k + np.argmax(mass[k:k + EVERY])]) for k in range(0, len(keys), EVERY)})


def _random_rows(at: np.ndarray, width: int) -> np.ndarray:
    """Rows of one fixed random matrix, by bucket: signs from a hash, so every task makes the rows it needs."""
    h = (at[:, None].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(width, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.where((h >> np.uint64(63)).astype(bool), 1.0, -1.0)


def gram(rows: DataFrame, matrix: Callable[[list], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer product of each one's vector: a square per task, added up cell by cell, comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                y = matrix(batch.column(0).slice(start, 512).to_pylist())
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width), pa.int32()), pa.array(total.ravel())], names=["cell", "x"])

    out = np.zeros(width * width)
    found = rows.mapInArrow(run, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).toArrow()
    out[found["cell"].to_numpy()] = found["x"].to_numpy()
    return out.reshape(width, width)


def latent(parts: DataFrame, n: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, vectors) by randomised SVD of the passages' TF-IDF rows.

    The words' rows are a written table. What comes to the driver: two squares of the projection's width, and RANK singles per word of the
    benchmark, 2**BITS words (128 MB) at most.
    """
    width = min(RANK + EXTRA, n)
    shared = parts.sparkSession.sparkContext.broadcast(idf)

    def projected(ids: list[int]):
        at, x = _sparse(ids, shared.value)
        return at, x, x @ _random_rows(at, width)

    values, basis = np.linalg.eigh(gram(parts.select("buckets"), lambda rows: np.array([projected(ids)[2] for ids in rows]), width))
    good = values > 1e-9 * max(values.max(), 1e-30)
    whiten = basis[:, good] / np.sqrt(values[good])  # Y times this has orthonormal columns
    kept = int(good.sum())

    def back(columns):
        sums: dict[int, np.ndarray] = {}
        for ids in columns[0]:
            at, x, y = projected(ids)
            for b, row in zip(at.tolist(), np.outer(x, y @ whiten)):
                sums[b] = sums[b] + row if b in sums else row
        return [list(sums), [v.tolist() for v in sums.values()]]

    rows = written(kit.map_rows(parts.select("buckets"), "bucket int, v array<double>", lambda: back).groupBy("bucket").agg(
        F.array(*[F.sum(F.col("v")[i]) for i in range(kept)]).alias("v")), "benchmark-words")
    values, turn = np.linalg.eigh(gram(rows.select("v"), np.array, kept))
    order = [i for i in np.argsort(-values) if values[i] > 1e-9][:RANK]
    last = turn[:, order] / np.sqrt(values[order])
    turned = kit.map_rows(rows, "bucket int, v binary", lambda: lambda c: [c[0], [r.tobytes() for r in (np.array(c[1]) @ last).astype(np.float32)]]).toArrow()
    at = turned["bucket"].to_numpy()
    vectors = np.empty((len(at), len(order)), np.float32)
    place = 0
    for chunk in turned["v"].chunks:
        for v in chunk:
            vectors[place] = np.frombuffer(v.as_buffer(), np.float32)
            place += 1
    first = np.argsort(at)
    return at[first], vectors[first]


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, a word of b at a time on the bits of one number."""
    places: dict = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        u = row & places.get(w, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def answer(text: str) -> list[bytes]:
    """The words of the last sentence, the whole item if it has one only."""
    said = [w for s in re.split(r"[.?!:;]\s+|\n", text) if (w := words(s))]
    return said[-1] if said else []


class Search:
    """Latent vectors of words and passages, and the items' words, to look for in documents."""

    def __init__(self, idf, at, vectors, items, owners, latents, lengths, most, runs):
        self.idf, self.vectors, self.owners = idf, vectors, owners
        retained = np.linalg.norm(latents, axis=1)
        scale = np.maximum(retained, 1e-6)
        self.toward = (latents / scale[:, None]).astype(np.float32)  # of length one
        self.least = (HELD * scale * lengths).astype(np.float32)
        self.most = most
        self.items = [(item, words(text), answer(text)) for item, text in items]
        self.row = np.full(1 << BITS, -1, np.int64)
        self.row[at] = np.arange(len(at))
        self.buckets = Buckets()
        self.runs = []
        for n in sorted({n for n, _, _ in runs}):
            mine = sorted((key, p) for m, key, p in runs if m == n)
            keys, passage = np.array([k for k, _ in mine], np.uint64), np.array([p for _, p in mine], np.int64)
            known = np.zeros(1 << 16, bool)
            known[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.runs.append((n, keys, passage, known))

    def _copied(self, ids: np.ndarray, windows: int) -> dict[int, set[int]]:
        """Passages by window that hold one of the window's runs of words."""
        out: dict[int, set[int]] = {}
        for n, keys, passage, known in self.runs:
            if len(ids) < n:
                continue
            mine = run_keys(ids, n)
            places = np.flatnonzero(known[(mine >> np.uint64(48)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, mine[places], "left"), np.searchsorted(keys, mine[places], "right")
            for k in np.flatnonzero(hi > lo):
                out.setdefault(min(int(places[k]) // STRIDE, windows - 1), set()).update(passage[lo[k]:hi[k]].tolist())
        return out

    def hits(self, text: str | None):
        """(item_id, cosine, share of the item in order, kind) of each item found in a text."""
        ws = words(text)
        if not ws:
            return
        ids = self.buckets.of(ws)
        start = np.arange(0, max(1, len(ws) - WINDOW + STRIDE), STRIDE)
        end = np.minimum(start + WINDOW, len(ws))
        reach = np.concatenate([[0.0], np.cumsum(self.most[ids])])
        copied = self._copied(ids, len(start))
        likely = np.union1d(np.flatnonzero(reach[end] - reach[start] >= 0.999 * HELD), np.array(list(copied), np.int64))
        best: dict[int, list[tuple[float, int]]] = {}
        weight, row = self.idf[ids], self.row[ids]
        for k in range(0, len(likely), 64):
            some = likely[k:k + 64]
            inside = start[some][:, None] + np.arange(WINDOW)
            open_ = inside < end[some][:, None]
            inside = np.where(open_, inside, 0)
            held = np.where(open_ & (row[inside] >= 0), weight[inside], 0.0).astype(np.float32)
            vector = np.matmul(held[:, None, :], self.vectors[np.maximum(row[inside], 0)])[:, 0]
            along = vector @ self.toward.T
            near = along >= self.least
            for i, w in enumerate(some.tolist()):
                near[i, list(copied.get(w, ()))] = True
            size = np.maximum(np.linalg.norm(vector, axis=1), 1e-12)
            for w, p in zip(*np.nonzero(near)):
                best.setdefault(int(self.owners[p]), []).append((float(along[w, p] / size[w]), int(some[w])))
        for item, found in best.items():
            name, wanted, said = self.items[item]
            need = self.idf[self.buckets.of(wanted)]
            top = None
            for cosine, w in sorted(found, key=lambda x: (-x[0], x[1])):
                around = ws[max(0, start[w] - len(wanted)):end[w] + len(wanted)]
                held = set(around)
                if need @ np.array([x in held for x in wanted]) < WEIGHT * need.sum():
                    continue
                share = common_subsequence(wanted, around) / len(wanted)
                kind = "copy" if share >= COPIED else "paraphrase" if share >= REWORDED and common_subsequence(said, around) >= ANSWER * len(said) else None
                if kind and (top is None or share > top[1]):
                    top = (cosine, share, kind)
                    if share == 1:
                        break
            if top:
                yield (name, min(1.0, top[0]), *top[1:])


def searches(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple]:
    """What `Search` is made of, for each block of the benchmark's passages."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    parts = passages(items)
    n = parts.count()
    if not n:
        return
    total, df = frequencies(docs)
    idf = np.log((1.0 + total) / (1.0 + df)) + 0.05
    at, vectors = latent(parts, n, idf)
    blocks = -(-n // BLOCK)
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        texts = [(r["item_id"], r["text"]) for r in mine.toLocalIterator() if words(r["text"])]
        buckets, place = Buckets(), np.full(1 << BITS, -1, np.int64)
        place[at] = np.arange(len(at))
        owners, latents, lengths, runs, most = [], [], [], [], np.zeros(1 << BITS)
        for i, (_, text) in enumerate(texts):
            ids = buckets.of(words(text))
            for part in np.array_split(ids, max(1, -(-len(ids) // PASSAGE))):
                b, x = _weights(part, idf)
                length = np.linalg.norm(x)
                n, keys = rarest_runs(part, idf)
                runs += [(n, key, len(owners)) for key in keys]
                most[b] = np.maximum(most[b], idf[b] * x / length**2)
                owners.append(i)
                latents.append(x / length @ vectors[place[b]])
                lengths.append(length)
        if texts:
            yield idf, at, vectors, texts, np.array(owners), np.array(latents, np.float32), np.array(lengths), most, runs


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, share, kind): one row per document row and benchmark item found in it.

    The benchmark is the query set: its passages go over the documents in blocks of about BLOCK.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, cosine double, share double, kind string"
    out = None
    for block in searches(docs, benchmark):
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            search = Search(*shared.value)

            def work(columns):
                rows = [(d, *hit) for d, text in zip(*columns) for hit in search.hits(text)]
                return [list(c) for c in zip(*rows)] or [[]] * 5

            return work

        found = kit.map_rows(docs.select("doc_id", "text"), schema, make)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _clean_of(block):
    @F.pandas_udf("boolean")
    def fine(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = Search(*block.value)
        for texts in parts:
            yield texts.map(lambda t: not isinstance(t, str) or next(search.hits(t), None) is None).astype(bool)

    return fine


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, all columns as they are."""
    kept = docs
    for block in searches(docs, benchmark):
        kept = kept.where(_clean_of(docs.sparkSession.sparkContext.broadcast(block))(F.col("text")))
    return kept
