"""Queries for preprocessing, neighbours, explanations and array columns (P, M, I and G operators)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.operators import arrays as G
from farol.operators import explain as I
from farol.operators import metrics as M
from farol.operators import neighbors as K
from farol.operators import prep as P
from farol.operators import split as T
from farol.queries import views
from farol.queries.registry import query, tidy
from farol.queries.tables import FOLD_SQL, SPLIT_SQL, fold_cases, labelled_cases, split_cases
from farol.queries.views import CASES_SQL, SCORES_SQL, TEXT_SQL, WIDE_SQL, sql_digest, sql_unit

WITH_CASES = "WITH " + CASES_SQL
GAPPED = ["total", "n_lines", "qty_sum", "price_max", "qty_min"]


def gapped(spark, sf, fraction=0.1):
    """The cases with a tenth of the cells emptied, on top of the orders without line items."""
    return P.inject_missing(views.cases(spark, sf).select("id", "diagnosis", "priority", "status", *GAPPED), GAPPED, fraction)


GAPPED_SQL = WITH_CASES + ", gapped AS (SELECT id, diagnosis, priority, status, " + ", ".join(
    f"CASE WHEN {sql_unit(f'mcar|{c}')} >= 0.1::double THEN {c} END AS {c}" for c in GAPPED) + " FROM cases)"


@query("p10_inject_missing", GAPPED_SQL + " SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" if c != "n_lines" else c for c in GAPPED) + " FROM gapped")
def p10(spark, sf):
    return tidy(gapped(spark, sf).select("id", *GAPPED))


MEDIANS_SQL = GAPPED_SQL + ", med AS (SELECT " + ", ".join(f"quantile_cont({c}::double, 0.5) AS {c}" for c in GAPPED) + " FROM gapped)"


@query("p1_median_imputation", MEDIANS_SQL + " SELECT id, " + ", ".join(f"round(coalesce(g.{c}, m.{c}), 6) AS {c}" for c in GAPPED)
       + " FROM gapped g, med m")
def p1(spark, sf):
    g = gapped(spark, sf).select("id", *[F.col(c).cast("double").alias(c) for c in GAPPED])
    return tidy(P.imputed(g, P.fit_medians(g, GAPPED)))


FILLED_SQL = MEDIANS_SQL + ", filled AS (SELECT id, " + ", ".join(f"coalesce(g.{c}, m.{c})::double AS {c}" for c in GAPPED) + " FROM gapped g, med m)"


def _scaled(spark, sf, scaler):
    g = written(gapped(spark, sf), "gapped")
    model = P.Preprocessor(numericCols=GAPPED, scaler=scaler).fit(g)
    x = vector_to_array("features")
    return tidy(model.transform(g).select("id", *[x[i].alias(c) for i, c in enumerate(P.feature_names_out(model))]))


@query("p2_standard_scale", FILLED_SQL + ", s AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in GAPPED)
       + " FROM filled) SELECT id, " + ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in GAPPED) + " FROM filled, s")
def p2(spark, sf):
    return _scaled(spark, sf, "standard")


@query("p3_robust_scale", FILLED_SQL + ", s AS (SELECT " + ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in GAPPED)
       + " FROM filled) SELECT id, " + ", ".join(
           f"round(({c} - q_{c}[2]) / CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END, 6) AS {c}" for c in GAPPED) + " FROM filled, s")
def p3(spark, sf):
    return _scaled(spark, sf, "robust")


@query("p4_yeo_johnson", "WITH " + views.SKEWED_SQL + """
SELECT id, round(CASE WHEN v >= 0 THEN (pow(v + 1, 0.3::double) - 1) / 0.3::double ELSE -(pow(1 - v, 1.7::double) - 1) / 1.7::double END, 6) AS value
FROM (SELECT id, value - 50 AS v FROM skewed)""")
def p4(spark, sf):
    shifted = F.col("value") - 50.0
    return tidy(views.skewed(spark, sf).select("id", P.yeo_johnson(shifted, 0.3).alias("value")))


@query("p4_power_scale")
def p4_fit(spark, sf):
    return _scaled(spark, sf, "power")


@query("p5_no_scale", FILLED_SQL + " SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in GAPPED) + " FROM filled")
def p5(spark, sf):
    return _scaled(spark, sf, "none")


TEXT_GAPS_SQL = "WITH " + TEXT_SQL + f""",
t AS (SELECT id, quality, n_chars, CASE WHEN {sql_unit('mcar|lang')} >= 0.2::double THEN lang END AS lang,
             CASE WHEN {sql_unit('mcar|source')} >= 0.2::double THEN source END AS source FROM text_cases),
modes AS (SELECT (SELECT lang FROM t WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS lang,
                 (SELECT source FROM t WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS source),
filled AS (SELECT id, quality, n_chars, coalesce(t.lang, m.lang) AS lang, coalesce(t.source, m.source) AS source FROM t, modes m)"""


def text_gaps(spark, sf):
    return P.inject_missing(views.text_cases(spark, sf), ["lang", "source"], 0.2)


@query("p6_mode_imputation", TEXT_GAPS_SQL + " SELECT id, lang, source FROM filled")
def p6(spark, sf):
    t = text_gaps(spark, sf).select("id", "lang", "source")
    return P.imputed(t, P.fit_modes(t, ["lang", "source"]))


@query("p7_one_hot", TEXT_GAPS_SQL + """,
c AS (SELECT 'lang_' || lang AS feature, 'lang' AS kind, lang AS value FROM (SELECT DISTINCT lang FROM filled)
      UNION ALL SELECT 'source_' || source, 'source', source FROM (SELECT DISTINCT source FROM filled))
SELECT id, feature, (CASE WHEN kind = 'lang' THEN lang = value ELSE source = value END)::int::double AS hot FROM filled, c""")
def p7(spark, sf):
    t = text_gaps(spark, sf)
    model = P.Preprocessor(categoricalCols=["lang", "source"], scaler="none").fit(t)
    x = vector_to_array("features")
    cells = [F.struct(F.lit(n).alias("feature"), x[i].alias("hot")) for i, n in enumerate(P.feature_names_out(model))]
    return model.transform(t).select("id", F.explode(F.array(*cells)).alias("c")).select("id", "c.*")


@query("p8_roles_and_vector", TEXT_GAPS_SQL + """,
s AS (SELECT avg(n_chars) AS a, stddev_pop(n_chars) AS d FROM filled)
SELECT id, round((n_chars - a) / d, 6) AS n_chars, 1 + (SELECT count(DISTINCT lang) + count(DISTINCT source) FROM filled) AS width FROM filled, s""")
def p8(spark, sf):
    t = text_gaps(spark, sf)
    numeric, categorical = P.infer_roles(t, drop=["id", "quality"])
    model = P.Preprocessor(numericCols=numeric, categoricalCols=categorical).fit(t)
    x = vector_to_array("features")
    return tidy(model.transform(t).select("id", x[P.feature_names_out(model).index("n_chars")].alias("n_chars"), F.size(x).alias("width")))


@query("p9_fit_on_train", SPLIT_SQL + """,
j AS (SELECT id, split, total, qty_sum FROM cases JOIN split USING (id)),
m AS (SELECT quantile_cont(total, 0.5) AS mt, quantile_cont(qty_sum, 0.5) AS mq FROM j WHERE split = 'train'),
f AS (SELECT id, split, coalesce(total, mt) AS total, coalesce(qty_sum, mq) AS qty_sum FROM j, m),
s AS (SELECT avg(total) AS mt, stddev_pop(total) AS dt, avg(qty_sum) AS mq, stddev_pop(qty_sum) AS dq FROM f WHERE split = 'train')
SELECT id, split, round((total - mt) / dt, 6) AS total, round((qty_sum - mq) / dq, 6) AS qty_sum FROM f, s""")
def p9(spark, sf):
    c = T.stratified_split(views.cases(spark, sf).withColumn("label", (F.col("diagnosis") == "M").cast("int")), "label")
    model = P.Preprocessor(numericCols=["total", "qty_sum"]).fit(c.where("split = 'train'"))
    x = vector_to_array("features")
    return tidy(model.transform(c).select("id", "split", x[0].alias("total"), x[1].alias("qty_sum")))


# ---- neighbours --------------------------------------------------------------------------------------

def _wide_vectors(spark, sf):
    w = views.wide(spark, sf)
    return T.hashed_split(w).select("id", F.array(*views.WIDE).alias("x"), "label", "split")


def _knn_sql(distance: str, score: str) -> str:
    return "WITH " + WIDE_SQL + f""",
v AS (SELECT id, [{', '.join(views.WIDE)}] AS x, label, CASE WHEN {sql_unit('split42')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM wide),
d AS (SELECT q.id, r.id AS neighbour, r.label, {distance} AS distance FROM v q JOIN v r ON q.split = 'test' AND r.split = 'train'),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d QUALIFY rank <= 5)
{score}"""


def _split_vectors(spark, sf):
    v = _wide_vectors(spark, sf)
    return v.where("split = 'test'").select("id", "x"), v.where("split <> 'test'").select("id", "x", "label")


@query("m3_neighbours", _knn_sql("list_distance(q.x, r.x)", 'SELECT id, neighbour, round(distance, 6) AS distance, label::double AS label, rank FROM n'))
def m3(spark, sf):
    return tidy(K.nearest_neighbours(*_split_vectors(spark, sf), k=5))


@query("m3_knn_uniform", _knn_sql("list_distance(q.x, r.x)", "SELECT id, round(avg(label), 6) AS score FROM n GROUP BY id"))
def m3_uniform(spark, sf):
    return tidy(K.neighbour_scores(K.nearest_neighbours(*_split_vectors(spark, sf), k=5)))


@query("m3_knn_distance_manhattan", _knn_sql("list_sum(list_transform(range(1, 65), lambda i: abs(q.x[i] - r.x[i])))",
                                             "SELECT id, round(sum(label / distance) / sum(1 / distance), 6) AS score FROM n GROUP BY id"))
def m3_distance(spark, sf):
    return tidy(K.neighbour_scores(K.nearest_neighbours(*_split_vectors(spark, sf), k=5, p=1), "distance"))


# ---- explanations ------------------------------------------------------------------------------------

LINEAR = {"total": 0.3, "n_lines": -0.2, "qty_sum": 1.5, "price_max": 0.8, "qty_min": -0.1}


def _prepared(spark, sf):
    c = views.cases(spark, sf).select("id", "diagnosis", *GAPPED)
    return P.Preprocessor(numericCols=GAPPED).fit(c).transform(c)


PREPARED_SQL = WITH_CASES + ", med AS (SELECT " + ", ".join(f"quantile_cont({c}::double, 0.5) AS {c}" for c in GAPPED) + """ FROM cases),
filled AS (SELECT id, """ + ", ".join(f"coalesce(g.{c}, m.{c})::double AS {c}" for c in GAPPED) + """ FROM cases g, med m),
s AS (SELECT """ + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in GAPPED) + """ FROM filled),
prepared AS (SELECT id, """ + ", ".join(f"({c} - a_{c}) / s_{c} AS {c}" for c in GAPPED) + f""" FROM filled, s),
bg AS (SELECT """ + ", ".join(f"avg({c}) AS {c}" for c in GAPPED) + f""" FROM (SELECT * FROM prepared ORDER BY {sql_digest('42')}, id LIMIT 100)),
shap AS (""" + " UNION ALL ".join(f"SELECT p.id, '{c}' AS feature, p.{c} AS value, {w}::double * (p.{c} - b.{c}) AS shap FROM prepared p, bg b"
                                  for c, w in LINEAR.items()) + ")"


def _linear_shap(spark, sf):
    prepared = _prepared(spark, sf)
    means = I.background_matrix(prepared).mean(axis=0)
    return I.linear_shapley(prepared, list(LINEAR.values()), means, GAPPED)


@query("i7_linear_shapley", PREPARED_SQL + " SELECT id, feature, round(value, 6) AS value, round(shap, 6) AS shap FROM shap")
def i7(spark, sf):
    return tidy(_linear_shap(spark, sf))


@query("i8_global_importance", PREPARED_SQL + " SELECT feature, round(avg(abs(shap)), 6) AS shap_medio_abs FROM shap GROUP BY feature")
def i8(spark, sf):
    return tidy(I.global_importance(_linear_shap(spark, sf)))


@query("i9_single_case", PREPARED_SQL + """,
one AS (SELECT *, row_number() OVER (ORDER BY abs(shap) DESC, feature) AS rn FROM shap WHERE id = (SELECT min(id) FROM cases)),
pooled AS (SELECT least(rn, 4) AS place, CASE WHEN count(*) = 1 THEN min(feature) ELSE count(*)::varchar || ' other features' END AS feature,
                  CASE WHEN count(*) = 1 THEN min(value) END AS value, sum(shap) AS shap FROM one GROUP BY least(rn, 4)),
run AS (SELECT *, 0.25::double + sum(shap) OVER (ORDER BY place DESC) AS e FROM pooled)
SELECT place, feature, round(value, 6) AS value, round(shap, 6) AS shap, round(e - shap, 6) AS "start", round(e, 6) AS "end" FROM run""")
def i9(spark, sf):
    first = views.table(spark, sf, "orders").agg(F.min("o_orderkey")).first()[0]
    return tidy(I.single_case(_linear_shap(spark, sf), first, 0.25, shown=4))


@query("i10_beeswarm", PREPARED_SQL + """,
top AS (SELECT feature FROM shap GROUP BY feature ORDER BY avg(abs(shap)) DESC, feature LIMIT 3)
SELECT feature, id, round(value, 6) AS value, round(shap, 6) AS shap FROM shap JOIN top USING (feature)""")
def i10(spark, sf):
    return tidy(I.beeswarm(_linear_shap(spark, sf), 3))


@query("i11_representative_cases", "WITH " + SCORES_SQL + """,
picks AS (SELECT model, 'falso_negativo' AS "case", id, score, row_number() OVER (PARTITION BY model ORDER BY score, id) AS rn FROM scores WHERE label = 1 AND score < 0.5
          UNION ALL SELECT model, 'falso_positivo', id, score, row_number() OVER (PARTITION BY model ORDER BY score DESC, id) FROM scores WHERE label = 0 AND score >= 0.5
          UNION ALL SELECT model, 'verdadeiro_positivo', id, score, row_number() OVER (PARTITION BY model ORDER BY score DESC, id) FROM scores WHERE label = 1 AND score >= 0.5
          UNION ALL SELECT model, 'caso_ambiguo', id, score, row_number() OVER (PARTITION BY model ORDER BY abs(score - 0.5), id) FROM scores)
SELECT model, "case", id, round(score, 9) AS score FROM picks WHERE rn = 1""")
def i11(spark, sf):
    return I.representative_cases(views.scores(spark, sf), 0.5).withColumn("score", F.round("score", 9))


@query("i12_background", PREPARED_SQL + f" SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in GAPPED)
       + f" FROM prepared ORDER BY {sql_digest('42')}, id LIMIT 100")
def i12(spark, sf):
    x = vector_to_array("features")
    return tidy(I.background_rows(_prepared(spark, sf)).select("id", *[x[i].alias(c) for i, c in enumerate(GAPPED)]))


@query("i4_permutation", WITH_CASES + f""",
k AS (SELECT id, total, qty_sum, ('0x' || substr(md5('bucket42|0|' || id::varchar), 1, 8))::bigint % greatest(1, (SELECT count(*) // 2000 FROM cases)) AS bucket,
             {sql_digest('permute42|0')} AS d FROM cases)
SELECT id, round(CASE WHEN last THEN first_total ELSE next_total END, 6) AS total, round(CASE WHEN last THEN first_qty ELSE next_qty END, 6) AS qty_sum
FROM (SELECT id, lead(total) OVER w AS next_total, lead(qty_sum) OVER w AS next_qty, first(total) OVER w AS first_total, first(qty_sum) OVER w AS first_qty,
             row_number() OVER w = count(*) OVER (PARTITION BY bucket) AS last FROM k WINDOW w AS (PARTITION BY bucket ORDER BY d, id))""")
def i4_permutation(spark, sf):
    c = views.cases(spark, sf).select("id", "total", "qty_sum")
    donors = I.with_donors(c, ["total", "qty_sum"], 0, I.permutation_buckets(c.count()))
    return tidy(donors.select("id", "donor.*"))


# ---- array columns -----------------------------------------------------------------------------------

@query("g1_normalized_pixels", """
SELECT vec_id AS id, round(list_sum(list_transform(embedding, lambda x: (abs(x::double) * 255 / 255 - 0.5) / 0.5)), 6) AS pixel_sum,
       round((abs(embedding[1]::double) * 255 / 255 - 0.5) / 0.5, 6) AS first_pixel, len(embedding) AS n FROM embeddings""")
def g1(spark, sf):
    images = views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.abs(x.cast("double")) * 255.0).alias("pixels"))
    out = images.withColumn("pixels", G.normalized_pixels(F.col("pixels")))
    return tidy(out.select("id", F.aggregate("pixels", F.lit(0.0), lambda a, x: a + x).alias("pixel_sum"), F.col("pixels")[0].alias("first_pixel"),
                           F.size("pixels").alias("n")))


@query("g2_split_report", "WITH " + WIDE_SQL + f""",
p AS (SELECT label, CASE WHEN {sql_unit('split42')} < 0.2 THEN 'test' WHEN {sql_unit('split42')} < 0.4 THEN 'val' ELSE 'train' END AS split FROM wide)
SELECT split, count(*) AS n, round(100::double * count(*) / sum(count(*)) OVER (), 1) AS pct_of_total, count(*) FILTER (WHERE label = 0) AS negatives,
       count(*) FILTER (WHERE label = 1) AS positives, round(100::double * sum(label) / count(*), 2) AS prevalence_pct FROM p GROUP BY split""")
def g2(spark, sf):
    return T.split_summary(_wide_vectors(spark, sf), "label")


@query("g3_positive_weight", "WITH " + WIDE_SQL + f"""
SELECT round(count(*) FILTER (WHERE label = 0) / greatest(count(*) FILTER (WHERE label = 1), 1)::double, 6) AS pos_weight
FROM wide WHERE {sql_unit('split42')} >= 0.4""")
def g3(spark, sf):
    return tidy(G.positive_class_weight(_wide_vectors(spark, sf).where("split = 'train'")))


@query("g5_samples_per_class", WITH_CASES + f"""
SELECT id, label::bigint AS label FROM labelled QUALIFY row_number() OVER (PARTITION BY label ORDER BY {sql_digest('sample42')}, id) <= 6""")
def g5(spark, sf):
    return tidy(G.samples_per_class(views.labelled(spark, sf).select("id", "label")))


@query("g6_review_sample", WITH_CASES + f""",
e AS (SELECT id, label, score FROM labelled WHERE (score >= 0.5) <> (label = 1) ORDER BY abs(score - 0.5) DESC, id LIMIT 6),
ok AS (SELECT id, label, score, row_number() OVER (ORDER BY {sql_digest('review42')}, id) AS rn FROM labelled WHERE (score >= 0.5) = (label = 1))
SELECT id, label::bigint AS label, round(score, 9) AS score, false AS correct FROM e
UNION ALL SELECT id, label, round(score, 9), true FROM ok WHERE rn <= 12 - (SELECT count(*) FROM e)""")
def g6(spark, sf):
    return tidy(G.review_sample(views.labelled(spark, sf), 0.5), 9)


@query("g7_inspection_picks", WITH_CASES + """
SELECT * FROM (SELECT id, label::bigint AS label, round(score, 9) AS score, 'confident' AS reason FROM labelled ORDER BY abs(labelled.score - 0.5) DESC, id LIMIT 2)
UNION ALL SELECT * FROM (SELECT id, label::bigint, round(score, 9), 'error' FROM labelled WHERE (labelled.score >= 0.5) <> (label = 1) ORDER BY id LIMIT 2)""")
def g7(spark, sf):
    return tidy(G.inspection_picks(views.labelled(spark, sf), 0.5), 9)


@query("g8_official_test", SPLIT_SQL.replace(WITH_CASES, "WITH " + SCORES_SQL) + """,
va AS (SELECT s.label, s.score FROM scores s JOIN split USING (id) WHERE model = 'a' AND split = 'val'),
te AS (SELECT s.label, s.score FROM scores s JOIN split USING (id) WHERE model = 'a' AND split = 'test'),
grid AS (SELECT DISTINCT round_even(score * 1000000::double, 0) / 1000000::double AS threshold FROM va),
cum AS (SELECT score, sum(label) OVER (ORDER BY score DESC) AS tp FROM va),
pick AS (SELECT max(threshold) AS low FROM grid g ASOF LEFT JOIN cum c ON g.threshold <= c.score WHERE c.tp / (SELECT sum(label) FROM va)::double >= 0.98),
marks AS (SELECT 0.5::double AS threshold UNION ALL SELECT low FROM pick),
counted AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn,
             count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn FROM te, marks GROUP BY threshold)
SELECT 'a' AS model, round(threshold, 4) AS threshold, tp, fn, fp, tn, round(tp / (tp + fn)::double, 4) AS recall, round(tp / (tp + fp)::double, 4) AS "precision" FROM counted""")
def g8(spark, sf):
    labelled = labelled_cases(spark, sf)
    parts = written(labelled.join(split_cases(spark, sf, labelled).select("id", "split"), "id"), "parts")
    scores = views.scores_of(parts).where("model = 'a'")
    return tidy(G.official_test(scores).select("model", "threshold", "tp", "fn", "fp", "tn", "recall", "precision"))


def _make_predictor():
    weights = np.linspace(-1.0, 1.0, 64)

    def predict(x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(np.asarray(x, dtype=float) @ weights)))

    return predict


@query("g9_batch_scores", """
SELECT vec_id AS id, round(1 / (1 + exp(-list_sum(list_transform(range(1, 65), lambda i: embedding[i]::double * (-1 + (i - 1) * 2 / 63::double))))), 6) AS score FROM embeddings""")
def g9(spark, sf):
    images = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return tidy(G.batch_scores(images, _make_predictor, "embedding", 64).select("id", "score"))
