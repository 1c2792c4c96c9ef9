"""The Merkle manifest against a plain recursive one, with hashlib."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farol.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(leaves, arity):
    """The root and, for each leaf, its siblings level by level as (left, right)."""
    nodes, proofs, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // arity * arity:][:arity]
            proofs[i].append((run[:a % arity], run[a % arity + 1:]))
            at[i] = a // arity
        nodes = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], proofs


def expected(rows, arity):
    """(key, order, leaf, replaced) -> the output rows."""
    trees = {}
    for r in rows:
        trees.setdefault("-" if r[0] is None else "=" + r[0], []).append(r)
    names = sorted(trees, key=lambda t: t.encode())
    for t in names:
        trees[t].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    inner = {t: climb([r[2] for r in trees[t]], arity) for t in names}
    root, outer = climb([inner[t][0] for t in names], arity) if names else (None, [])
    out = []
    for t, up in zip(names, outer):
        for r, own in zip(trees[t], inner[t][1]):
            value, seen = r[3] or r[2], []
            for left, right in own + up:
                value = h(*left, value, *right)
                seen += left + right
            out.append((r[1], r[2], inner[t][0], root, h(*seen), value, value == root))
    return sorted(out, key=str)


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 256, (9, 32), np.uint8)
    for arity in (2, 3, 4):
        nodes, states = merkle.build(digests, merkle.depth_of(9, arity, 9), arity)
        names = [bytes(d).hex() for d in digests]
        assert bytes(nodes[-1][0]).hex() == climb(names, arity)[0]
        # The kept state before the last slot resumes with that child alone.
        now = merkle.compress(states[0][0, arity - 1][None], merkle.hex_block(digests[arity - 1:arity]))
        assert bytes(merkle.finish(now, np.array([arity]))[0]).hex() == h(*names[:arity])


@pytest.mark.parametrize("arity, depth", [(2, 12), (2, 2), (3, 1)])
def test_manifest_is_the_plain_tree(spark, arity, depth):
    rows = [(k, i, h(str(k), str(i)), h("new", str(i)) if i % 5 == 0 else None) for k, n in (("en", 41), (None, 7), ("de", 1), ("", 2), ("é", 16)) for i in range(n)]
    rows += [("en", 3, h("another"), None), ("en", 4, rows[4][2], None), ("en", None, h("no id"), h("none"))]
    df = spark.createDataFrame(rows, "key string, order bigint, leaf string, replaced string").repartition(5)
    got = merkle.manifest(df, arity, depth)
    assert got.columns == ["order", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, arity)


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([("a", 1, h("x"), None)], "key string, order bigint, leaf string, replaced string")
    assert [tuple(r) for r in merkle.manifest(one).collect()] == [(1, h("x"), h("x"), h("x"), h(), h("x"), True)]
    assert merkle.manifest(one.where("order < 0")).count() == 0


def test_leaves_of_odd_documents(spark):
    rows = [(1, "é", "en", "s", 1, "c"), (2, None, None, None, None, "c"), (None, "", "", "", 0, "c"), (7, "x" * 10**6, "en", "s", 2**63 - 1, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string")
    every = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1)) == 0
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = {r[0]: (h(*map(part, (r[0], r[3], r[2], r[4], r[1]))), h(*map(part, (r[0], r[3], r[2], r[4] + 1 if r[4] is not None else None, r[1])))) for r in rows}
    for r in merkle.document_leaves(df, every).collect():
        assert r["leaf"] == want[r["order"]][0]
        assert r["replaced"] == (want[r["order"]][1] if r["order"] is not None else None)
    assert zlib.crc32(b"7") == spark.sql("SELECT crc32('7')").first()[0]
