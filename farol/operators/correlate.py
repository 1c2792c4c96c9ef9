"""Correlation between features and with the label, redundant pairs and columns to drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col, nan_to_null, structs_to_rows
from farol.functions.moments import correlation_of, pair_moments
from farol.functions.running import RANGE, average_ranks, range_count, tie_edges_of, with_range

FEW_COLUMNS = 8
#: Rows of the broadcast table of ranges, all contexts together, at most (two ranges an edge).
RANGE_ROWS = 1_000_000


def _named(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select("i", "j", F.element_at(names, F.col("i") + 1).alias("feature_a"),
                        F.element_at(names, F.col("j") + 1).alias("feature_b"), "n", "r")


def _few_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs, cells = [], []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            x, y = col(a).cast("double"), col(columns[j]).cast("double")
            r = F.corr(x, y) if i != j else F.when(F.min(x) < F.max(x), F.lit(1.0))
            aggs += [F.count_if(x.isNotNull() & y.isNotNull()).alias(f"__n{i}_{j}"), r.alias(f"__r{i}_{j}")]
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"__n{i}_{j}").alias("n"),
                                  nan_to_null(F.col(f"__r{i}_{j}")).alias("r")))
    return structs_to_rows(df.agg(*aggs), cells)


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson", id_col: str = words.ID_COLUMN) -> DataFrame:
    """(i, j, feature_a, feature_b, n, r) for i <= j over pairwise complete rows.

    A few columns are one aggregate of built-in `corr`; more go through the blocked moment kernel.
    """
    columns = list(columns)
    if method == "spearman":
        return _named(_spearman_pairs(df, columns, id_col), columns)
    if method != "pearson":
        raise ValueError(f"correlation method '{method}' is not supported: use 'pearson' or 'spearman'")
    pairs = _few_pairs(df, columns) if len(columns) <= FEW_COLUMNS else correlation_of(pair_moments(df, columns))
    return _named(pairs, columns)


def _rank_partners(wide: DataFrame, p: int) -> dict[tuple[int, int], int | None]:
    """For columns c0.. of `wide`: whose presence restricts the ranks of column i when paired with j; None if nothing does."""
    absent = [F.col(f"c{i}").isNull() for i in range(p)]
    gaps = wide.agg(*[F.max(absent[i]).alias(f"g{i}") for i in range(p)]).first()
    gappy = [i for i in range(p) if gaps[f"g{i}"]]
    pairs = [(i, j) for i in gappy for j in gappy if i != j]
    alone = wide.agg(*[F.max(~absent[i] & absent[j]).alias(f"d{i}_{j}") for i, j in pairs]).first() if pairs else {}
    first_like = {j: min([j] + [k for k in gappy if k != j and not alone[f"d{j}_{k}"] and not alone[f"d{k}_{j}"]]) for j in gappy}
    out: dict[tuple[int, int], int | None] = {}
    for i in range(p):
        for j in range(p):
            restricts = j in gappy and i != j and (i not in gappy or alone[f"d{i}_{j}"])
            out[(i, j)] = first_like[j] if restricts else None
    return out


def _spearman_pairs(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Rank correlation over pairwise complete rows; `id_col` must be unique.

    A column is ranked again over the rows where its partner is present, but only if the partner is
    missing where the column is not, and only once for partners missing in the same rows. A cell carries the range its value lies in;
    ranks are counted within ranges and written next to the cell, so cells are shuffled by range once and by id once.
    """
    # Adding zero makes minus zero equal to zero in every sort.
    wide = df.select(col(id_col).alias("__id"), *[(col(c).cast("double") + F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
    partner_of = _rank_partners(wide, len(columns))
    ranked_as: dict[tuple[int, int | None], int] = {}
    for i in range(len(columns)):
        for partner in sorted({partner_of[(i, j)] for j in range(len(columns))}, key=lambda j: -1 if j is None else j):
            ranked_as[(i, partner)] = len(ranked_as)

    ranges = max(2, min(range_count(df), RANGE_ROWS // (2 * len(ranked_as))))
    edges = tie_edges_of(wide, [f"c{i}" for i in range(len(columns))], ranges)
    ranged = wide
    for c, (cuts, tied) in edges.items():
        ranged = with_range(ranged, c, cuts or [0.0], f"r_{c}").withColumn(f"t_{c}", F.col(c).isin(tied) if tied else F.lit(False))

    def cell(i: int, partner: int | None):
        value = F.col(f"c{i}") if partner is None else F.when(F.col(f"c{partner}").isNotNull(), F.col(f"c{i}"))
        return F.struct(F.lit(ranked_as[(i, partner)]).alias("context"), value.alias("value"), F.col(f"r_c{i}").alias(RANGE), F.col(f"t_c{i}").alias("tied"))

    cells = F.explode(F.array(*[cell(i, p) for i, p in ranked_as])).alias("cell")
    long = ranged.select("__id", cells).select("__id", "cell.*").where("value IS NOT NULL")
    back = average_ranks(long, "context", "__id", "value").groupBy("__id").agg(
        *[F.max(F.when(F.col("context") == k, F.col("rank"))).alias(f"k{k}") for k in range(len(ranked_as))])
    wanted = [(ranked_as[(i, partner_of[(i, j)])], ranked_as[(j, partner_of[(j, i)])], i, j)
              for i in range(len(columns)) for j in range(i, len(columns))]
    moments = correlation_of(pair_moments(back, [f"k{k}" for k in range(len(ranked_as))]))
    place = {(min(a, b), max(a, b)): (i, j) for a, b, i, j in wanted}
    lookup = df.sparkSession.createDataFrame([(a, b, i, j) for (a, b), (i, j) in place.items()], "a int, b int, pi int, pj int")
    return moments.join(F.broadcast(lookup), (F.col("i") == F.col("a")) & (F.col("j") == F.col("b"))).select(
        F.col("pi").alias("i"), F.col("pj").alias("j"), "n", "r")


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str, method: str = "pearson",
                            id_col: str = words.ID_COLUMN) -> DataFrame:
    """Correlation of every feature with the 0/1 target, strongest first."""
    if method == "spearman":
        pairs = correlation_matrix(df, [*columns, target], method, id_col)
        rows = pairs.where((F.col("feature_b") == target) & (F.col("feature_a") != target)).select(
            F.col("feature_a").alias("feature"), F.col("r").alias("corr_com_alvo"))
    else:
        y = col(target).cast("double")
        row = df.agg(*[F.corr(col(c).cast("double"), y).alias(f"__r{i}") for i, c in enumerate(columns)])
        rows = structs_to_rows(row, [F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(f"__r{i}")).alias("corr_com_alvo"))
                                     for i, c in enumerate(columns)])
    return rows.orderBy(F.abs("corr_com_alvo").desc_nulls_last(), "feature")


def redundant_pairs(matrix: DataFrame, threshold: float = 0.90) -> DataFrame:
    """C4: pairs at or above the threshold before rounding, strongest first."""
    kept = matrix.where((F.col("i") < F.col("j")) & (F.abs("r") >= threshold))
    return kept.select("feature_a", "feature_b", F.round("r", 4).alias("correlacao")).orderBy(
        F.abs("correlacao").desc(), "feature_a", "feature_b")


def suggested_drops(pairs: DataFrame, with_target: DataFrame) -> list[str]:
    """Of the closest pair the side that says less about the label goes, and with it all its pairs; so on with what is left.

    Which side of a pair is weaker is decided in the table. The pairs come to the driver: p squared at most, whatever the rows.
    """
    said = with_target.select("feature", F.coalesce(F.abs("corr_com_alvo"), F.lit(0.0)).alias("said"))
    left, right = (said.select(F.col("feature").alias(f"feature_{x}"), F.col("said").alias(f"said_{x}")) for x in "ab")
    both = pairs.join(left, "feature_a", "left").join(right, "feature_b", "left").na.fill(0.0, ["said_a", "said_b"])
    closest = both.orderBy(F.abs("correlacao").desc(), "feature_a", "feature_b")
    table = closest.select("feature_a", "feature_b", F.when(F.col("said_a") < F.col("said_b"), F.col("feature_a")).otherwise(F.col("feature_b")).alias("weaker"))
    rest, gone = [tuple(r) for r in table.collect()], []
    while rest:
        gone.append(rest[0][2])
        rest = [r for r in rest if gone[-1] not in r[:2]]
    return sorted(gone)


def top_features(df: DataFrame, columns: Sequence[str], target: str, k: int = 9) -> DataFrame:
    """The k features with the strongest correlation with the label."""
    return correlation_with_target(df, columns, target).limit(k)


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """Row and column of the heat map on and below the diagonal."""
    return matrix.select(F.col("feature_b").alias("row"), F.col("feature_a").alias("column"), "r")
