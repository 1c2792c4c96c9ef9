"""Exact random slices of every stratum without ranking or moving the rows.

Rows are ordered by (md5(seed|id), id) inside their stratum and the order is cut at given
ranks. Only the cut keys are needed to label every row, so the kernel counts rows per
leading hash digits, finds the few digit groups that contain a cut, ranks only those rows
(1/65536 of the stratum each) and returns the keys as literals. Labelling is then a narrow
expression: the table is scanned, never shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from farol.functions.columns import col
from farol.functions.keys import digest

LEADING_DIGITS = 4


def stratum_counts(df: DataFrame, stratum: str) -> dict:
    """Rows per stratum; the result has one entry per stratum (class, fold)."""
    return {r[0]: r[1] for r in df.groupBy(col(stratum)).count().collect()}


def largest_remainder(counts: Mapping, size: int) -> dict:
    """Share `size` draws over the strata in proportion to `counts`, whole numbers, ties to the larger stratum key."""
    total = sum(counts.values())
    exact = {s: n * size / total for s, n in counts.items()}
    share = {s: int(x) for s, x in exact.items()}
    missing = size - sum(share.values())
    by_remainder = sorted(counts, key=lambda s: (exact[s] - share[s], s), reverse=True)
    for s in by_remainder[:missing]:
        share[s] += 1
    return share


def cut_keys(df: DataFrame, stratum: str, id_col: str, salt: str, ranks: Mapping[object, Sequence[int]], digest_col: str | None = None) -> dict:
    """The (digest, id) at each wanted 1-based rank of each stratum. Runs one job, returns one key per wanted rank.

    `digest_col` names a column that holds `digest(salt, id)` already.
    """
    spark = df.sparkSession
    wanted_rows = [(s, int(r)) for s, rs in ranks.items() for r in sorted(set(rs)) if r > 0]
    if not wanted_rows:
        return {}
    stratum_type = df.select(col(stratum)).schema[0].dataType.simpleString()
    wanted = spark.createDataFrame(wanted_rows, f"s {stratum_type}, rank bigint")
    drawn = digest(salt, col(id_col)) if digest_col is None else col(digest_col)
    keyed = df.select(col(stratum).alias("s"), drawn.alias("d"), col(id_col).alias("k"))
    keyed = keyed.withColumn("b", F.substring("d", 1, LEADING_DIGITS))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("b"))
    filled = keyed.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    hit = (filled.join(F.broadcast(wanted), "s")
           .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
           .select("s", "b", "rank", (F.col("rank") - F.col("upto") + F.col("n")).alias("place")))
    in_group = F.row_number().over(Window.partitionBy("s", "rank").orderBy("d", "k"))
    found = (keyed.join(F.broadcast(hit), ["s", "b"]).withColumn("rn", in_group)
             .where(F.col("rn") == F.col("place")).select("s", "rank", "d", "k"))
    return {(r["s"], r["rank"]): (r["d"], r["k"]) for r in found.collect()}


def with_slices(df: DataFrame, stratum: str, id_col: str, salt: str, sizes: Mapping[object, Sequence[int]],
                name: str, digest_col: str | None = None) -> DataFrame:
    """Label each row with the index of its slice: `sizes[stratum]` lists the slice sizes in hash order.

    Rows beyond the listed sizes get the next index. Strata without an entry get NULL. The digest is a column of its own,
    as the label compares it with every cut; `digest_col` names one that is there already, which is dropped.
    """
    ends = {s: _cumulative(sz) for s, sz in sizes.items()}
    keys = cut_keys(df, stratum, id_col, salt, ends, digest_col)
    id_type = df.schema[id_col].dataType
    drawn = digest_col or "__digest"
    df = df if digest_col else df.withColumn(drawn, digest(salt, col(id_col)))
    key = F.struct(col(drawn).alias("d"), col(id_col).alias("k"))
    label: Column = F.lit(None).cast("int")
    for s, stops in ends.items():
        slot = F.lit(0)
        for stop in stops:
            if stop <= 0:
                slot = slot + F.lit(1)
            elif (s, stop) in keys:
                d, k = keys[(s, stop)]
                slot = slot + (key > F.struct(F.lit(d).alias("d"), F.lit(k).cast(id_type).alias("k"))).cast("int")
        label = F.when(col(stratum) == F.lit(s), slot).otherwise(label)
    return df.withColumn(name, label).drop(drawn)


def _cumulative(sizes: Sequence[int]) -> list[int]:
    out, total = [], 0
    for n in sizes:
        total += n
        out.append(total)
    return out
