"""Queries for sources, names and labels, audit, description and splits (S, N, Q, D and T operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.operators import audit as Q
from farol.operators import describe as D
from farol.operators import normalize as N
from farol.operators import split as T
from farol.queries import views
from farol.queries.registry import query, tidy
from farol.queries.views import CASES_SQL, DIRTY_SQL, SKEWED_SQL, TEXT_SQL, sql_digest, sql_unit

WITH_CASES = "WITH " + CASES_SQL
NUMERIC = views.NUMERIC


def raw_cases(spark, sf):
    """The cases with the blemishes of a hand-made CSV: blanks around names and labels, an empty column, lower case."""
    return views.cases(spark, sf).select(
        F.col("id").alias(" id"), F.concat(F.lit(" "), F.lower("diagnosis"), F.lit(" ")).alias("diagnosis "),
        F.col("total").alias("concave points_mean"), F.col("qty_sum").alias(" concave points_worst "), F.lit(None).cast("string").alias("Unnamed: 32"))


@query("s4_recode", WITH_CASES + " SELECT id, CASE WHEN label = 1 THEN 'M' ELSE 'B' END AS diagnosis FROM labelled")
def s4(spark, sf):
    inverted = views.labelled(spark, sf).select("id", (F.lit(1) - F.col("label")).alias("code"))
    return N.recode_inverted(inverted, "code").drop("code")


@query("n1_trim_names", WITH_CASES + """
SELECT id, ' ' || lower(diagnosis) || ' ' AS diagnosis, round(total, 6) AS "concave points_mean", round(qty_sum, 6) AS "concave points_worst",
       NULL::varchar AS "Unnamed: 32" FROM cases""")
def n1(spark, sf):
    return tidy(N.trim_names(raw_cases(spark, sf)))


@query("n2_drop_unnamed", WITH_CASES + """
SELECT id AS " id", ' ' || lower(diagnosis) || ' ' AS "diagnosis ", round(total, 6) AS "concave points_mean",
       round(qty_sum, 6) AS " concave points_worst " FROM cases""")
def n2(spark, sf):
    return tidy(N.drop_unnamed(raw_cases(spark, sf)))


@query("n3_rename_parts", WITH_CASES + """
SELECT id, ' ' || lower(diagnosis) || ' ' AS diagnosis, round(total, 6) AS concave_points_mean, round(qty_sum, 6) AS concave_points_worst FROM cases""")
def n3(spark, sf):
    return tidy(N.rename_parts(N.drop_unnamed(N.trim_names(raw_cases(spark, sf)))))


@query("n4_clean_label", WITH_CASES + """
SELECT id, diagnosis, round(total, 6) AS concave_points_mean, round(qty_sum, 6) AS concave_points_worst FROM cases""")
def n4(spark, sf):
    return tidy(N.normalize(raw_cases(spark, sf)))


@query("n5_features", WITH_CASES + """
SELECT round(total, 6) AS total, n_lines, round(qty_sum, 6) AS qty_sum, priority, status FROM cases""")
def n5(spark, sf):
    return tidy(N.features_only(views.cases(spark, sf).select("id", "total", "n_lines", "qty_sum", "priority", "status", "diagnosis")))


@query("n6_map_label", WITH_CASES + " SELECT id, label::bigint AS label FROM labelled")
def n6(spark, sf):
    c = views.cases(spark, sf)
    return tidy(c.select("id", N.mapped_label(F.col("diagnosis"), {"M": 1, "B": 0}).alias("label")))


@query("n6_unknown_labels", "SELECT DISTINCT o_orderstatus AS status FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def n6_unknown(spark, sf):
    return N.unknown_labels(views.cases(spark, sf), "status", {"F": 0, "O": 1})


@query("n7_target", WITH_CASES + " SELECT id, label::bigint AS target FROM labelled")
def n7(spark, sf):
    return tidy(N.with_target(views.cases(spark, sf)).select("id", "target"))


@query("n9_contract", WITH_CASES + " SELECT id, round(qty_min, 6) AS qty_min, round(total, 6) AS total, n_lines FROM cases")
def n9(spark, sf):
    return tidy(N.enforce_contract(views.cases(spark, sf), ["qty_min", "total", "n_lines"], keep=["id"]))


@query("n11_feature_labels", """
WITH names AS (SELECT DISTINCT p_type || CASE p_size % 4 WHEN 0 THEN '_mean' WHEN 1 THEN '_se' WHEN 2 THEN '_worst' ELSE '' END AS feature
               FROM (SELECT replace(lower(p_type), ' ', '_') AS p_type, p_size FROM part))
SELECT feature, CASE WHEN feature LIKE '%\\_mean' ESCAPE '\\' THEN replace(left(feature, -5), '_', ' ') || ' (media)'
                     WHEN feature LIKE '%\\_se' ESCAPE '\\' THEN replace(left(feature, -3), '_', ' ') || ' (erro-padrao)'
                     WHEN feature LIKE '%\\_worst' ESCAPE '\\' THEN replace(left(feature, -6), '_', ' ') || ' (pior)'
                     ELSE replace(feature, '_', ' ') END AS label FROM names""")
def n11(spark, sf):
    suffix = F.element_at(F.array(F.lit("_mean"), F.lit("_se"), F.lit("_worst"), F.lit("")), F.col("p_size") % 4 + 1)
    names = views.table(spark, sf, "part").select(
        F.concat(F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")), suffix).alias("feature")).distinct()
    return names.select("feature", N.feature_label(F.col("feature")).alias("label"))


@query("n12_sample", WITH_CASES + f" SELECT id, diagnosis FROM cases ORDER BY {sql_digest('42')}, id LIMIT 100")
def n12(spark, sf):
    return N.sample_rows(views.cases(spark, sf).select("id", "diagnosis"), 100)


@query("n13_optional_truth", WITH_CASES + " SELECT id, round(total, 6) AS total, label::bigint AS target FROM cases JOIN labelled USING (id)")
def n13(spark, sf):
    rows, known = N.split_truth(views.cases(spark, sf).select("id", "total", "diagnosis"))
    return tidy(rows) if known else tidy(rows.withColumn("target", F.lit(None).cast("bigint")))


@query("n14_filter", WITH_CASES + " SELECT id FROM cases WHERE diagnosis = 'M' AND status = 'F'")
def n14(spark, sf):
    return N.where_equal(views.cases(spark, sf), diagnosis="M", status="F").select("id")


@query("q1_shape", WITH_CASES + """
SELECT count(*) AS n_rows, 12::bigint AS n_cols, 9::bigint AS n_numeric, 3::bigint AS n_categorical,
       'id,total,n_lines,qty_sum,price_max,disc_avg,tax_avg,qty_min,score' AS numeric_columns, 'priority,status,diagnosis' AS categorical_columns
FROM cases""")
def q1(spark, sf):
    s = Q.shape(views.cases(spark, sf).drop("z"))
    return s.withColumns({c: F.array_join(c, ",") for c in ("numeric_columns", "categorical_columns")})


@query("q3_missing", WITH_CASES + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM cases" for c in (*NUMERIC, "priority", "status")) + ") WHERE missing > 0")
def q3(spark, sf):
    return Q.missing(views.cases(spark, sf))


@query("q3_missing_total", WITH_CASES + " SELECT (" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in NUMERIC)
       + ")::bigint AS missing_total FROM cases")
def q3_total(spark, sf):
    return Q.missing_total(views.cases(spark, sf))


@query("q4_duplicate_rows", "WITH " + DIRTY_SQL + """
SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)))::bigint AS duplicated_rows FROM dirty""")
def q4(spark, sf):
    return Q.duplicate_rows(views.dirty(spark, sf))


@query("q5_duplicate_ids", "WITH " + DIRTY_SQL + " SELECT count(*) - count(DISTINCT id) AS duplicated_ids FROM dirty")
def q5(spark, sf):
    return Q.duplicate_ids(views.dirty(spark, sf))


@query("q6_constant", "WITH " + DIRTY_SQL + "SELECT feature FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS k FROM dirty"
    for c in ("id", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_constant")) + ") WHERE k <= 1")
def q6(spark, sf):
    return Q.constant_columns(views.dirty(spark, sf))


@query("q7_impossible_zeros", "WITH " + DIRTY_SQL + "SELECT feature, zeros FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} = 0) AS zeros FROM dirty" for c in ("l_discount", "l_tax", "l_quantity")) + ") WHERE zeros > 0")
def q7(spark, sf):
    return Q.impossible_zeros(views.dirty(spark, sf), ("l_discount", "l_tax", "l_quantity"))


@query("q8_class_counts", "WITH " + TEXT_SQL + """
SELECT quality::varchar AS class, count(*) AS n, round(100::double * count(*) / sum(count(*)) OVER (), 2) AS pct FROM text_cases GROUP BY quality""")
def q8(spark, sf):
    return Q.class_counts(views.text_cases(spark, sf).withColumn("quality", F.col("quality").cast("string")), "quality")


@query("q9_imbalance", WITH_CASES + """
SELECT round(max(n) / min(n)::double, 3) AS imbalance_ratio FROM (SELECT count(*) AS n FROM cases GROUP BY diagnosis)""")
def q9(spark, sf):
    return Q.imbalance(views.cases(spark, sf))


def audited(spark, sf):
    """The dirty line items with a label, empty cells and zeros where there should be none."""
    d = views.dirty(spark, sf)
    return d.withColumns({"l_tax": F.when(F.col("l_quantity") >= 5, F.col("l_tax")), "diagnosis": F.when(F.col("l_quantity") > 35, "M").otherwise("B"),
                          "area_mean": F.when(F.col("l_quantity") == 7, 0.0).otherwise(F.col("l_quantity"))})


AUDITED = ("id", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_constant", "area_mean")


@query("q_audit", "WITH " + DIRTY_SQL + """,
audited AS (SELECT id, l_linenumber, l_quantity, l_extendedprice, l_discount, CASE WHEN l_quantity >= 5 THEN l_tax END AS l_tax, l_constant,
                   CASE WHEN l_quantity > 35 THEN 'M' ELSE 'B' END AS diagnosis, CASE WHEN l_quantity = 7 THEN 0 ELSE l_quantity END AS area_mean FROM dirty)
SELECT count(*) AS n_rows, sum((l_tax IS NULL)::int)::bigint AS missing_tax, (""" + " + ".join(f"count(*) - count({c})" for c in (*AUDITED, "diagnosis")) + """)::bigint AS missing_total,
       (count(*) - count(DISTINCT id))::bigint AS duplicated_ids, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM audited)))::bigint AS duplicated_rows,
       count(*) FILTER (WHERE diagnosis = 'M') AS n_m, round(100::double * count(*) FILTER (WHERE diagnosis = 'M') / count(*), 2) AS pct_m,
       round(greatest(count(*) FILTER (WHERE diagnosis = 'B'), count(*) FILTER (WHERE diagnosis = 'M'))
             / least(count(*) FILTER (WHERE diagnosis = 'B'), count(*) FILTER (WHERE diagnosis = 'M'))::double, 3) AS imbalance_ratio,
       concat_ws(',', """ + ", ".join(f"CASE WHEN min({c}) IS NOT DISTINCT FROM max({c}) THEN '{c}' END" for c in AUDITED) + """) AS constant_columns,
       sum((area_mean = 0)::int)::bigint AS zeros FROM audited""")
def q_audit(spark, sf):
    a = Q.audit(audited(spark, sf))
    return tidy(a.select("n_rows", F.col("missing_by_column")["l_tax"].alias("missing_tax"), "missing_total", "duplicated_ids",
                         "duplicated_rows", F.col("class_counts")["M"].alias("n_m"), F.col("class_balance_pct")["M"].alias("pct_m"),
                         "imbalance_ratio", F.array_join("constant_columns", ",").alias("constant_columns"), F.col("impossible_zeros")["area_mean"].alias("zeros")))


def _describe_sql(view: str, columns) -> str:
    parts = []
    for c in columns:
        x = f"{c}::double"
        parts.append(f"""SELECT '{c}' AS feature, count({c}) AS "count", round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std,
            round(min({x}), 4) AS "min", round(max({x}), 4) AS "max", round(quantile_cont({x}, 0.25), 4) AS q25,
            round(quantile_cont({x}, 0.5), 4) AS q50, round(quantile_cont({x}, 0.75), 4) AS q75, round(skewness({x}), 4) AS skew,
            round(kurtosis({x}), 4) AS kurtosis, round(stddev_samp({x}) / avg({x}), 4) AS cv, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM {view}""")
    return " UNION ALL ".join(parts)


D_COLUMNS = ("total", "n_lines", "qty_sum", "price_max", "qty_min", "disc_avg", "tax_avg")


def _pick(prefix: str, sql: str, columns: str) -> str:
    return f"{prefix} SELECT {columns} FROM ({sql})"


@query("d1_describe", _pick(WITH_CASES, _describe_sql("cases", D_COLUMNS), 'feature, "count", mean, std, "min", "max", q25, q50, q75'))
def d1(spark, sf):
    return D.describe_numeric(views.cases(spark, sf), D_COLUMNS).select("feature", "count", "mean", "std", "min", "max", "q25", "q50", "q75")


@query("d2_skewness", _pick("WITH " + SKEWED_SQL + ", " + CASES_SQL, _describe_sql("skewed", ["value"]) + " UNION ALL " + _describe_sql("cases", D_COLUMNS),
                            "feature, skew"))
def d2(spark, sf):
    rows = D.moment_rows(views.skewed(spark, sf), ["value"]).unionByName(D.moment_rows(views.cases(spark, sf), D_COLUMNS))
    return tidy(rows.select("feature", "skew"), 4)


@query("d3_kurtosis", _pick("WITH " + SKEWED_SQL + ", " + CASES_SQL, _describe_sql("skewed", ["value"]) + " UNION ALL " + _describe_sql("cases", D_COLUMNS),
                            "feature, kurtosis"))
def d3(spark, sf):
    rows = D.moment_rows(views.skewed(spark, sf), ["value"]).unionByName(D.moment_rows(views.cases(spark, sf), D_COLUMNS))
    return tidy(rows.select("feature", "kurtosis"), 4)


@query("d4_variation", _pick(WITH_CASES, _describe_sql("cases", D_COLUMNS), "feature, cv"))
def d4(spark, sf):
    return tidy(D.moment_rows(views.cases(spark, sf), D_COLUMNS).select("feature", "cv"), 4)


@query("d5_missing", _pick(WITH_CASES, _describe_sql("cases", D_COLUMNS), "feature, missing"))
def d5(spark, sf):
    return tidy(D.moment_rows(views.cases(spark, sf), D_COLUMNS).select("feature", "missing"))


@query("d6_scale_and_skew", _pick(WITH_CASES, _describe_sql("cases", D_COLUMNS), "feature, mean, std, skew, abs(skew) > 1 AS skewed"))
def d6(spark, sf):
    return tidy(D.scale_and_skew(views.cases(spark, sf), D_COLUMNS), 4)


@query("d7_class_balance", WITH_CASES + """,
c AS (SELECT diagnosis, count(*) AS n FROM cases GROUP BY diagnosis)
SELECT (diagnosis = 'M')::bigint AS place, diagnosis AS class, n, round(100::double * n / (SELECT sum(n) FROM c), 6) AS pct,
       round((SELECT max(n) / min(n)::double FROM c), 6) AS imbalance_ratio FROM c""")
def d7(spark, sf):
    return tidy(D.class_balance(views.cases(spark, sf)))


# Largest remainder on two classes: the class with the larger fractional part gets the odd row.
SPLIT_SQL = WITH_CASES + f""",
c AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
t AS (SELECT sum(n) AS total, ceil(0.2::double * sum(n))::bigint AS n_test FROM c),
r1 AS (SELECT label, n, n * (total - n_test) / total::double AS x, total - n_test AS size FROM c, t),
q1 AS (SELECT label, n, size, floor(x) + (row_number() OVER (ORDER BY x - floor(x) DESC, label DESC) <= size - sum(floor(x)) OVER ())::int AS rest FROM r1),
r2 AS (SELECT label, n, rest, rest * (size - ceil(0.25::double * size)) / size AS x, size - ceil(0.25::double * size) AS train_size FROM q1),
q2 AS (SELECT label, n, rest, floor(x) + (row_number() OVER (ORDER BY x - floor(x) DESC, label DESC) <= train_size - sum(floor(x)) OVER ())::int AS train FROM r2),
k AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_digest('split42')}, id) AS rn FROM labelled),
split AS (SELECT id, k.label, CASE WHEN rn <= n - rest THEN 'test' WHEN rn <= n - train THEN 'val' ELSE 'train' END AS split FROM k JOIN q2 USING (label))"""


def labelled_cases(spark, sf):
    """The labelled cases, written once: the jobs that find the cuts and the query read them again."""
    return written(views.labelled(spark, sf), "labelled")


def split_cases(spark, sf, labelled=None):
    return T.stratified_split((labelled_cases(spark, sf) if labelled is None else labelled).select("id", "label"), "label")


@query("t1_split", SPLIT_SQL + " SELECT id, label::bigint AS label, split FROM split")
def t1(spark, sf):
    return tidy(split_cases(spark, sf))


@query("t1b_hashed_split", WITH_CASES + f"""
SELECT id, CASE WHEN {sql_unit('split42')} < 0.2 THEN 'test' WHEN {sql_unit('split42')} < 0.4 THEN 'val' ELSE 'train' END AS split FROM cases""")
def t1b(spark, sf):
    return T.hashed_split(views.labelled(spark, sf).select("id"))


@query("t2_train_and_validation", SPLIT_SQL + " SELECT id, label::bigint AS label FROM split WHERE split <> 'test'")
def t2(spark, sf):
    return tidy(T.train_and_validation(split_cases(spark, sf)).select("id", "label"))


@query("t3_split_summary", SPLIT_SQL + """
SELECT split, count(*) AS n, round(100::double * count(*) / sum(count(*)) OVER (), 1) AS pct_of_total, count(*) FILTER (WHERE label = 0) AS negatives,
       count(*) FILTER (WHERE label = 1) AS positives, round(100::double * sum(label) / count(*), 2) AS prevalence_pct FROM split GROUP BY split""")
def t3(spark, sf):
    return T.split_summary(split_cases(spark, sf), "label")


# Classes are dealt over the folds one after the other; fold sizes per class come from that deal.
FOLD_SQL = WITH_CASES + f""",
k AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_digest('fold42')}, id) AS rn,
             row_number() OVER (ORDER BY label, id) - 1 AS dealt FROM labelled),
sizes AS (SELECT label, dealt % 5 AS fold, count(*) AS n FROM k GROUP BY ALL),
ends AS (SELECT label, fold, sum(n) OVER (PARTITION BY label ORDER BY fold) AS upto, n FROM sizes),
folds AS (SELECT id, k.label, fold::bigint AS fold FROM k JOIN ends ON k.label = ends.label AND rn <= upto AND rn > upto - n)"""


def fold_cases(spark, sf, labelled=None):
    return T.stratified_folds((labelled_cases(spark, sf) if labelled is None else labelled).select("id", "label"), "label")


@query("t4_folds", FOLD_SQL + " SELECT id, label::bigint AS label, fold FROM folds")
def t4(spark, sf):
    return tidy(fold_cases(spark, sf))


@query("t5_learning_subsets", FOLD_SQL + f""",
tr AS (SELECT id, h.held_out, row_number() OVER (PARTITION BY h.held_out ORDER BY {sql_digest('learn42')}, id) AS rn,
              count(*) OVER (PARTITION BY h.held_out) AS n FROM folds f, (SELECT unnest([0, 1, 2, 3, 4]) AS held_out) h WHERE f.fold <> h.held_out),
steps AS (SELECT unnest(range(8)) AS step),
subset_sizes AS (SELECT held_out, step, floor(n * (CASE WHEN step = 7 THEN 1 ELSE 0.15::double + (1 - 0.15::double) * step / 7 END)) AS size
          FROM (SELECT DISTINCT held_out, n FROM tr), steps),
placed AS (SELECT held_out, id, min(step) AS step FROM tr JOIN subset_sizes USING (held_out) WHERE rn <= size GROUP BY held_out, id)
SELECT held_out::bigint AS held_out, step::bigint AS step, count(*) AS n, sum(id)::bigint AS id_sum FROM placed GROUP BY ALL""")
def t5(spark, sf):
    subsets = T.learning_subsets(written(fold_cases(spark, sf), "folds"))
    return tidy(subsets.groupBy("held_out", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")))


@query("t6_split_checks", SPLIT_SQL + """,
planted AS (SELECT id, label, split FROM split WHERE id % 10 <> 4 UNION ALL SELECT id, label, 'test' FROM split WHERE id % 10 = 5
            UNION ALL SELECT -id, label, split FROM split WHERE id % 10 = 6),
placed AS (SELECT id, count(DISTINCT split) AS parts FROM planted GROUP BY id)
SELECT (SELECT count(*) FROM placed WHERE parts > 1) AS overlapping, (SELECT count(*) FROM split WHERE id NOT IN (SELECT id FROM placed)) AS unplaced,
       (SELECT count(*) FROM placed WHERE id NOT IN (SELECT id FROM split)) AS "foreign",
       round((SELECT max(abs(p - (SELECT avg(label) FROM planted))) FROM (SELECT avg(label) AS p FROM planted GROUP BY split)), 6) AS largest_gap""")
def t6(spark, sf):
    """A split with faults: ids in two parts, ids left out, ids from elsewhere."""
    whole, last = split_cases(spark, sf).select("id", "label", "split"), F.pmod("id", F.lit(10))
    parts = whole.where(last != 4).unionByName(whole.where(last == 5).withColumn("split", F.lit("test"))).unionByName(whole.where(last == 6).withColumn("id", -F.col("id")))
    checks = T.split_problems(parts, views.labelled(spark, sf))
    return tidy(checks.withColumn("largest_gap", T.prevalence_gap(parts, "label").scalar()))
