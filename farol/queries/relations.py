"""Queries for correlation and the exploratory tables (C and E operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.operators import correlate as C
from farol.operators import explore as E
from farol.operators import prep as P
from farol.queries import views
from farol.queries.registry import query, tidy
from farol.queries.views import CASES_SQL, SKEWED_SQL, WIDE_SQL

WITH_CASES = "WITH " + CASES_SQL
NUMERIC = list(views.NUMERIC)
WIDE = list(views.WIDE)


def labelled_cases(spark, sf):
    return views.cases(spark, sf).withColumn("label", (F.col("diagnosis") == "M").cast("int"))


def _pairs_sql(columns, expression, source, diagonal=True):
    rows = []
    for i, a in enumerate(columns):
        for j in range(i if diagonal else i + 1, len(columns)):
            b = columns[j]
            n = f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            r = "1::double" if i == j else expression(a, b)
            rows.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {n} AS n, {r} AS r FROM {source}")
    return " UNION ALL ".join(rows)


def _corr(a, b):
    return f"corr({a}::double, {b}::double)"


@query("c1_pearson", f"{WITH_CASES} SELECT feature_a, feature_b, n, round(r, 6) AS r FROM ({_pairs_sql(NUMERIC, _corr, 'cases')})")
def c1(spark, sf):
    m = C.correlation_matrix(views.cases(spark, sf), NUMERIC)
    return tidy(m.select("feature_a", "feature_b", "n", "r"))


@query("c1_pearson_wide", f"WITH {WIDE_SQL} SELECT feature_a, feature_b, n, round(r, 6) AS r FROM ({_pairs_sql(WIDE, _corr, 'wide')})")
def c1_wide(spark, sf):
    m = C.correlation_matrix(views.wide(spark, sf), WIDE)
    return tidy(m.select("feature_a", "feature_b", "n", "r"))


def _spearman_sql(columns):
    rows = []
    for i, a in enumerate(columns):
        for b in columns[i + 1:]:
            rank = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2::double"
            rows.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) AS n, corr(x, y) AS r FROM "
                        f"(SELECT {rank(a)} AS x, {rank(b)} AS y FROM cases WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return " UNION ALL ".join(rows)


SPEARMAN = ["total", "n_lines", "qty_sum", "price_max", "qty_min"]


@query("c2_spearman", f"{WITH_CASES} SELECT feature_a, feature_b, n, round(r, 6) AS r FROM ({_spearman_sql(SPEARMAN)})")
def c2(spark, sf):
    m = C.correlation_matrix(views.cases(spark, sf), SPEARMAN, "spearman")
    return tidy(m.where("i < j").select("feature_a", "feature_b", "n", "r"))


TARGET_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}::double, (diagnosis = 'M')::int::double) AS r FROM cases" for c in NUMERIC)


@query("c3_with_target", f"{WITH_CASES} SELECT feature, round(r, 6) AS corr_com_alvo FROM ({TARGET_SQL})")
def c3(spark, sf):
    return tidy(C.correlation_with_target(labelled_cases(spark, sf), NUMERIC, "label"))


@query("c4_redundant_pairs", f"""WITH {WIDE_SQL} SELECT feature_a, feature_b, round(r, 4) AS correlacao
FROM ({_pairs_sql([*WIDE, 'copy'], _corr, 'wide', False)}) WHERE abs(r) >= 0.9""")
def c4(spark, sf):
    return C.redundant_pairs(C.correlation_matrix(views.wide(spark, sf), [*WIDE, "copy"]), 0.90)


@query("c5_suggested_drops")
def c5(spark, sf):
    w = views.wide(spark, sf)
    columns = [*WIDE, "copy"]
    drops = C.suggested_drops(C.redundant_pairs(C.correlation_matrix(w, columns)), C.correlation_with_target(w, columns, "label"))
    return spark.createDataFrame([(d,) for d in drops], "feature string")


@query("c6_top_features", f"""{WITH_CASES} SELECT feature, round(r, 6) AS corr_com_alvo FROM ({TARGET_SQL}) ORDER BY abs(r) DESC, feature LIMIT 3""")
def c6(spark, sf):
    return tidy(C.top_features(labelled_cases(spark, sf), NUMERIC, "label", 3))


@query("c7_lower_triangle", f"""{WITH_CASES} SELECT feature_b AS "row", feature_a AS "column", round(r, 6) AS r FROM ({_pairs_sql(NUMERIC, _corr, 'cases')})""")
def c7(spark, sf):
    return tidy(C.lower_triangle(C.correlation_matrix(views.cases(spark, sf), NUMERIC)))


LONG = ["total", "qty_sum", "price_max"]
LONG_SQL = WITH_CASES + ", " + SKEWED_SQL + """,
long AS (""" + " UNION ALL ".join([f"SELECT '{c}' AS feature, diagnosis AS class, {c}::double AS value, id FROM cases WHERE {c} IS NOT NULL" for c in LONG]
                                  + ["SELECT 'value' AS feature, diagnosis AS class, value, id FROM skewed"]) + """),
span AS (SELECT feature, class, min(value) AS low, max(value) AS high, count(*) AS n, stddev_samp(value) AS s FROM long GROUP BY ALL)"""


def both(spark, sf, operator):
    """An operator on the cases and on the skewed event values, stacked."""
    return operator(views.cases(spark, sf), LONG).unionByName(operator(views.skewed(spark, sf), ["value"]))


@query("e1_density_histogram", LONG_SQL + """,
counted AS (SELECT feature, class, least(floor((value - low) / (high - low) * 28), 27)::bigint AS bin, count(*) AS "count", max(low) AS low,
                   max(high) AS high, max(n) AS n FROM long JOIN span USING (feature, class) GROUP BY ALL)
SELECT feature, class, bin, round(low + bin * ((high - low) / 28), 6) AS "left", "count", round("count" / (n * ((high - low) / 28)), 9) AS density FROM counted""")
def e1(spark, sf):
    h = both(spark, sf, E.density_histogram)
    return h.select("feature", "class", F.col("bin").cast("bigint").alias("bin"), F.round("left", 6).alias("left"), "count",
                    F.round("density", 9).alias("density"))


@query("e2_density_curve", LONG_SQL + """,
pos AS (SELECT feature, class, (value - low) / (high - low) * 2047 AS p FROM long JOIN span USING (feature, class)),
halves AS (SELECT feature, class, least(floor(p), 2046) AS node, least(floor(p), 2046) + 1 - p AS w FROM pos
           UNION ALL SELECT feature, class, least(floor(p), 2046) + 1, p - least(floor(p), 2046) FROM pos),
weights AS (SELECT feature, class, node, sum(w) AS w FROM halves GROUP BY ALL),
curve AS (SELECT feature, class, point, low + point * (high - low) / 199 AS x,
                 sum(w * exp(-0.5 * pow((low + point * (high - low) / 199 - (low + node * (high - low) / 2047)) / (s * pow(n, -0.2::double)), 2))
                     / (n * s * pow(n, -0.2::double) * sqrt(2 * pi()))) AS density
          FROM weights JOIN span USING (feature, class), (SELECT unnest(range(200)) AS point) GROUP BY ALL)
SELECT feature, class, point::bigint AS point, round(x, 6) AS x, round(density, 9) AS density FROM curve""")
def e2(spark, sf):
    c = both(spark, sf, E.density_curve)
    return c.select("feature", "class", F.col("point").cast("bigint").alias("point"), F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


BOX_SQL = LONG_SQL + """,
q AS (SELECT feature, class, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@query("e3_box_table", BOX_SQL + """
SELECT feature, class, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
       round(least(min(value) FILTER (WHERE value >= lo), max(q1)), 6) AS low_whisker,
       round(greatest(max(value) FILTER (WHERE value <= hi), max(q3)), 6) AS high_whisker,
       count(*) FILTER (WHERE value < lo OR value > hi) AS outliers FROM long JOIN f USING (feature, class) GROUP BY feature, class""")
def e3(spark, sf):
    return tidy(both(spark, sf, E.box_table))


@query("e3_outlier_rows", BOX_SQL + """
SELECT feature, class, id, round(value, 6) AS value FROM long JOIN f USING (feature, class) WHERE value < lo OR value > hi""")
def e3_rows(spark, sf):
    return tidy(both(spark, sf, E.outlier_rows))


@query("e4_component_variance")
def e4(spark, sf):
    return tidy(E.component_variance(views.wide(spark, sf), WIDE))


@query("e4_component_loadings")
def e4_loadings(spark, sf):
    return tidy(E.component_loadings(views.wide(spark, sf), WIDE))


@query("e5_projected_points")
def e5(spark, sf):
    return tidy(E.projected_points(views.wide(spark, sf), WIDE, label="label"))


def complete_cases(spark, sf):
    """The cases with missing cells filled by the median; written, as several steps read it."""
    c = labelled_cases(spark, sf).select("id", "label", *[F.col(n).cast("double").alias(n) for n in NUMERIC])
    return written(P.imputed(c, P.fit_medians(c, NUMERIC)), "cases")


def _components_sql(k: int, squarings: int = 20) -> str:
    """The leading components by a power of the matrix of correlations, squared again and again, each taken out before the next: v<j> of one row (v, l)."""
    p = len(NUMERIC)
    dot = "list_sum([u[1] * u[2] FOR u IN list_zip({0}, {1})])"
    every = f"range(1, {p + 1})"
    out = ["m0 AS MATERIALIZED (SELECT [" + ", ".join("[" + ", ".join(f"avg(x[{i}] * x[{j}])" for j in range(1, p + 1)) + "]" for i in range(1, p + 1)) + "] AS m FROM z)"]
    for j in range(k):
        start = "[" + ", ".join(f"{1 + i / 10}::double" for i in range(p)) + "]"
        out.append(f"""i{j}(step, q) AS (SELECT 0, m FROM m{j} UNION ALL SELECT step + 1, [[{dot.format('q[a]', 'q[b]')} / t FOR b IN {every}] FOR a IN {every}]
  FROM (SELECT step, q, list_sum([{dot.format('r', 'r')} FOR r IN q]) AS t FROM i{j} WHERE step < {squarings}))""")
        out.append(f"""w{j} AS (SELECT [{dot.format('r', start)} FOR r IN q] AS w FROM i{j} WHERE step = {squarings}),
u{j} AS (SELECT [y / sqrt(list_sum([t * t FOR t IN w])) * CASE WHEN list_max(w) >= -list_min(w) THEN 1 ELSE -1 END FOR y IN w] AS v FROM w{j}),
v{j} AS MATERIALIZED (SELECT v, {dot.format('v', f"[{dot.format('r', 'v')} FOR r IN m]")} AS l FROM u{j}, m{j})""")
        out.append(f"m{j + 1} AS MATERIALIZED (SELECT [[m[a][b] - l * v[a] * v[b] FOR b IN {every}] FOR a IN {every}] AS m FROM m{j}, v{j})")
    return ", ".join(out)


COMPONENTS_SQL = WITH_CASES.replace("WITH", "WITH RECURSIVE", 1) + ", med AS (SELECT " + ", ".join(f"quantile_cont({c}::double, 0.5) AS {c}" for c in NUMERIC) + """ FROM cases),
filled AS (SELECT id, diagnosis, """ + ", ".join(f"coalesce(g.{c}, m.{c})::double AS {c}" for c in NUMERIC) + """ FROM cases g, med m),
st AS (SELECT """ + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC) + """ FROM filled),
z AS MATERIALIZED (SELECT id, (diagnosis = 'M')::int AS label, [""" + ", ".join(f"({c} - a_{c}) / s_{c}" for c in NUMERIC) + "] AS x FROM filled, st), " + _components_sql(2)


@query("e4_case_variance", COMPONENTS_SQL + f"""
SELECT 1::bigint AS component, round(l / {len(NUMERIC)}, 5) AS variance_ratio, round(l / {len(NUMERIC)}, 5) AS cumulative_ratio FROM v0
UNION ALL SELECT 2, round(v1.l / {len(NUMERIC)}, 5), round((v0.l + v1.l) / {len(NUMERIC)}, 5) FROM v0, v1""")
def e4_case_variance(spark, sf):
    return tidy(E.component_variance(complete_cases(spark, sf), NUMERIC, 2), 5)


@query("e4_case_loadings", COMPONENTS_SQL + "".join(
    f"{' UNION ALL' if j else ''} SELECT {j + 1}::bigint AS component, unnest([{', '.join(repr(c) for c in NUMERIC)}]) AS feature, round(unnest(v), 5) AS loading FROM v{j}" for j in range(2)))
def e4_case_loadings(spark, sf):
    return tidy(E.component_loadings(complete_cases(spark, sf), NUMERIC, 2), 5)


@query("e5_case_points", COMPONENTS_SQL + """
SELECT id, label::bigint AS class, """ + ", ".join(f"round(list_sum([u[1] * u[2] FOR u IN list_zip(x, v{j}.v)]), 4) AS pc{j + 1}" for j in range(2)) + " FROM z, v0, v1")
def e5_case_points(spark, sf):
    return tidy(E.projected_points(complete_cases(spark, sf), NUMERIC, label="label"), 4)


@query("e6_scatter_pairs", WITH_CASES + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT id, diagnosis AS class, '{a}' AS feature_x, '{b}' AS feature_y, round({a}, 6) AS x, round({b}, 6) AS y FROM cases"
    for a, b in (("total", "qty_sum"), ("total", "price_max"), ("qty_sum", "price_max"))) + ")")
def e6(spark, sf):
    return tidy(E.scatter_pairs(views.cases(spark, sf), LONG))
