"""Vector codes against plain Lloyd rounds in Python's own numbers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from farol.llm import codes


def brute(rows, parts, entries, rounds, scale):
    """(vec_id, vector, label) -> the output rows, sorted."""
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) % parts == 0]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fine = [r for r in fine if len(r[1]) == len(fine[0][1])]
    whole = [[math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale for x in r[1]] for r in fine]
    step = len(whole[0]) // parts
    cut = [[w[p * step:(p + 1) * step] for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(c[p], b)), e) for e, b in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        held = defaultdict(list)
        for c, own in zip(cut, assign()):
            for p in range(parts):
                held[p, own[p][1]].append(c[p])
        for (p, e), members in held.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    last, by_label = assign(), defaultdict(int)
    for r, own in zip(fine, last):
        by_label[r[2]] += sum(d for d, _ in own)
    sha = hashlib.sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()
    fit = lambda x: x if x < 1 << 63 else None
    return sorted([(r[0], "".join(f"{e:02x}" for _, e in own), fit(sum(d for d, _ in own)), fit(by_label[r[2]]), sha) for r, own in zip(fine, last)], key=str)


def got(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, code string, uid int").repartition(4)
    return sorted((tuple(r) for r in codes.product_codes(df, **how).collect()), key=str)


@pytest.mark.parametrize("owner", [4096, 7])
def test_codes_are_lloyds(spark, monkeypatch, owner):
    monkeypatch.setattr(codes, "OWNER", owner)
    rng = np.random.default_rng(3)
    rows = [(int(i), v.tolist(), int(i % 3) if i % 7 else None) for i, v in enumerate(rng.standard_normal((160, 8)))]
    rows += [(i, rows[5][1], 1) for i in range(300, 380)]  # one vector holds a third of all rows
    rows += [rows[9], (None, rows[3][1], None), (None, None, 1), (500, [None] * 8, 1), (501, [float("nan")] * 8, 1), (502, [float("inf")] * 8, 1),
             (503, [], 1), (504, [1.0] * 16, 1), (505, [1.0] * 7, 1)]
    how = dict(parts=4, entries=6, rounds=5, scale=16)
    assert got(spark, rows, **how) == brute(rows, **how)


def test_codes_of_huge_numbers_and_few_rows(spark):
    rows = [(1, [1e300, 0.0], 1), (2, [-1e300, 2.0], 1), (3, [1e9, -2.5], 2), (4, [1e300, 1.0], None)]
    how = dict(parts=2, entries=3, rounds=2, scale=4096)
    assert got(spark, rows, **how) == brute(rows, **how)
    assert got(spark, rows[:1], parts=2) == brute(rows[:1], 2, 16, 6, 4096)
    assert got(spark, [(1, None, 1)]) == []


def test_residents_are_not_shuffled_again(spark):
    """Only what changes its entry migrates: the members' partitioning is kept through the rounds."""
    kept, _ = codes.usable(spark.range(2000).selectExpr("id AS vec_id", "0 AS label", "array(rand(1), rand(2), rand(3), rand(4)) AS v"), 2)
    members, books = codes.fit(kept, codes.seeds(kept, 2, 4, 64), 2, 64)
    assert members.map(lambda b: len(b[1][0])).sum() == 4000
    where = members.mapPartitionsWithIndex(lambda i, blocks: [(i, key) for key, _ in blocks]).collect()
    assert all(codes._owner_number(key) % members.getNumPartitions() == i for i, key in where)
    assert len({key for _, key in where}) == len(where)
    lineage = members.toDebugString().decode()
    assert "PartitionerAwareUnionRDD" in lineage
