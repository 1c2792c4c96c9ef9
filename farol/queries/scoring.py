"""Queries for metrics, curves, threshold calibration and triage (V and H operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farol.operators import metrics as M
from farol.operators import report as R
from farol.operators import threshold as H
from farol.queries import views
from farol.queries.registry import query, tidy
from farol.queries.views import CASES_SQL, SCORES_SQL, sql_unit

WITH_SCORES = "WITH " + SCORES_SQL

COUNTS_SQL = WITH_SCORES + """,
counts AS (SELECT model, count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
                  count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp,
                  count(*) AS n FROM scores GROUP BY model)"""

# Rank formula for the area and cumulative counts over distinct scores for the average precision.
RANKING_SQL = """,
ranks AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
                 + (count(*) OVER (PARTITION BY model, score) - 1) / 2::double AS r FROM scores),
areas AS (SELECT model, CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN
                 (sum(r) FILTER (WHERE label = 1) - sum(label)::double * (sum(label) + 1) / 2)
                 / (sum(label)::double * sum(1 - label)::double) END AS roc_auc FROM ranks GROUP BY model),
grouped AS (SELECT model, score, sum(label) AS pos, count(*) AS n FROM scores GROUP BY model, score),
upto AS (SELECT model, score, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS alarms, sum(pos) OVER (PARTITION BY model) AS p,
                sum(n) OVER (PARTITION BY model) AS total
         FROM grouped WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
steps AS (SELECT model, CASE WHEN max(p) > 0 THEN sum(pos::double / nullif(p, 0) * tp / alarms) END AS pr_auc
          FROM upto GROUP BY model)"""

RATES = {
    "accuracy": "(tp + tn) / n::double",
    "balanced_accuracy": """CASE WHEN tp + fn = 0 THEN tn / (tn + fp)::double WHEN tn + fp = 0 THEN tp / (tp + fn)::double
                            ELSE (tp / (tp + fn)::double + tn / (tn + fp)::double) / 2 END""",
    "precision": "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::double END",
    "recall": "CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::double END",
    "specificity": "CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp)::double END",
    "f1": "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::double END",
    "mcc": """CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0
              ELSE (tp::double * tn - fp::double * fn) / sqrt((tp + fp)::double * (tp + fn) * (tn + fp) * (tn + fn)) END""",
}


@query("v1_confusion", COUNTS_SQL + " SELECT model, 0.5::double AS threshold, tn, fp, fn, tp, n FROM counts")
def v1(spark, sf):
    return tidy(M.confusion_counts(views.scores(spark, sf)))


def _rate(key: str, name: str) -> None:
    @query(key, COUNTS_SQL + f' SELECT model, round(({RATES[name]})::double, 6) AS "{name}" FROM counts')
    def run(spark, sf):
        return tidy(M.threshold_metrics(views.scores(spark, sf)).select("model", name))


_rate("v2_accuracy", "accuracy")
_rate("v3_balanced_accuracy", "balanced_accuracy")
_rate("v4_precision", "precision")
_rate("v5_recall", "recall")
_rate("v6_specificity", "specificity")
_rate("v7_f1", "f1")
_rate("v8_mcc", "mcc")


@query("v9_roc_auc", WITH_SCORES + RANKING_SQL + " SELECT model, round(roc_auc, 6) AS roc_auc FROM areas")
def v9(spark, sf):
    return tidy(M.roc_auc(views.scores(spark, sf)))


@query("v10_average_precision", WITH_SCORES + RANKING_SQL + " SELECT model, round(pr_auc, 6) AS pr_auc FROM steps")
def v10(spark, sf):
    return tidy(M.average_precision(views.scores(spark, sf)))


@query("v11_brier", WITH_SCORES + " SELECT model, round(avg((score - label) * (score - label)), 6) AS brier FROM scores GROUP BY model")
def v11(spark, sf):
    return tidy(M.brier(views.scores(spark, sf)))


ALL_RATES = ", ".join(f'round(({e})::double, 4) AS "{n}"' for n, e in RATES.items() if n != "n")


@query("v12_metrics_table", COUNTS_SQL + RANKING_SQL + f""",
briers AS (SELECT model, avg((score - label) * (score - label)) AS brier FROM scores GROUP BY model)
SELECT model, {ALL_RATES}, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(brier, 4) AS brier, 0.5::double AS threshold,
       tp, fn, fp, tn FROM counts JOIN areas USING (model) JOIN steps USING (model) JOIN briers USING (model)""")
def v12(spark, sf):
    return tidy(M.metrics_table(M.compute_metrics(views.scores(spark, sf))))


@query("v13_confusion_matrix", COUNTS_SQL + """,
cells AS (SELECT model, unnest([0, 0, 1, 1])::bigint AS actual, unnest([0, 1, 0, 1])::bigint AS predicted, unnest([tn, fp, fn, tp]) AS n,
                 unnest([tn + fp, tn + fp, fn + tp, fn + tp]) AS whole FROM counts)
SELECT model, actual, predicted, n, round(CASE WHEN whole = 0 THEN 0 ELSE 100::double * n / whole END, 6) AS pct_of_actual FROM cells""")
def v13(spark, sf):
    return tidy(M.confusion_matrix(views.scores(spark, sf)))


@query("v14_roc_points", WITH_SCORES + """,
g AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY model, score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS q,
             lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS k
      FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
kept AS (SELECT * FROM c WHERE k = 1 OR np IS NULL OR np <> pos OR nn <> neg)
SELECT model, round(CASE WHEN q > 0 THEN fp / q::double END, 6) AS fpr, round(CASE WHEN p > 0 THEN tp / p::double END, 6) AS tpr,
       round(score, 9) AS threshold FROM kept
UNION ALL SELECT DISTINCT model, CASE WHEN q > 0 THEN 0::double END, CASE WHEN p > 0 THEN 0::double END, 'infinity'::double FROM c""")
def v14(spark, sf):
    curve = M.roc_curve(views.scores(spark, sf))
    return curve.select("model", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"), F.round("threshold", 9).alias("threshold"))


@query("v15_pr_points", WITH_SCORES + """,
g AS (SELECT model, score, sum(label) AS pos, count(*) AS n FROM scores GROUP BY model, score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS alarms, sum(pos) OVER (PARTITION BY model) AS p
      FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC))
SELECT model, round(CASE WHEN p > 0 THEN tp / p::double ELSE 1 END, 6) AS recall, round(tp / alarms::double, 6) AS precision,
       round(score, 9) AS threshold FROM c
UNION ALL SELECT DISTINCT model, 0::double, 1::double, NULL FROM c""")
def v15(spark, sf):
    curve = M.pr_curve(views.scores(spark, sf))
    return curve.select("model", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"),
                        F.round("threshold", 9).alias("threshold"))


@query("v16_prevalence", WITH_SCORES + " SELECT model, round(avg(label), 6) AS prevalence FROM scores GROUP BY model")
def v16(spark, sf):
    return tidy(M.prevalence(views.scores(spark, sf)))


@query("v17_model_comparison", COUNTS_SQL + RANKING_SQL + f""",
t AS (SELECT model, round(({RATES['recall']})::double, 4) AS recall, round(({RATES['f1']})::double, 4) AS f1,
             round(({RATES['precision']})::double, 4) AS "precision", round(roc_auc, 4) AS roc_auc FROM counts JOIN areas USING (model)),
p AS (SELECT *, dense_rank() OVER (ORDER BY recall, model) AS place FROM t)
SELECT place, model, unnest(['recall', 'f1', 'precision', 'roc_auc']) AS metric, unnest([recall, f1, "precision", roc_auc]) AS value FROM p""")
def v17(spark, sf):
    return tidy(M.model_comparison(M.metrics_table(M.compute_metrics(views.scores(spark, sf)))))


@query("v18_calibration", WITH_SCORES + """,
edges AS (SELECT model, quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM scores GROUP BY model),
placed AS (SELECT model, score, label, len(list_filter(e, lambda x: x < score)) AS bin FROM scores JOIN edges USING (model))
SELECT model, bin, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS share_positive, count(*) AS n FROM placed GROUP BY model, bin""")
def v18(spark, sf):
    return tidy(M.calibration_curve(views.scores(spark, sf)))


@query("v19_score_histogram", WITH_SCORES + """
SELECT model, label::bigint AS label, least(floor(score * 40), 39)::bigint AS bin, count(*) AS n FROM scores GROUP BY ALL""")
def v19(spark, sf):
    return tidy(M.score_histogram(views.scores(spark, sf)))


@query("v19_score_range_histogram", WITH_SCORES + """,
span AS (SELECT model, min(score) AS low, max(score) AS high FROM scores GROUP BY model)
SELECT model, least(floor((score - low) / ((high - low) / 25)), 24)::bigint AS bin, count(*) AS n, round(min(low), 6) AS low,
       round(max(high), 6) AS high FROM scores JOIN span USING (model) GROUP BY ALL""")
def v19_range(spark, sf):
    return tidy(M.score_range_histogram(views.scores(spark, sf)))


@query("v21_error_list", "WITH " + CASES_SQL + """
SELECT id AS indice_original, CASE WHEN diagnosis = 'M' THEN 'Maligno' ELSE 'Benigno' END AS classe_real,
       CASE WHEN score >= 0.5 THEN 'Maligno' ELSE 'Benigno' END AS classe_prevista, round(score, 4) AS prob_malignidade,
       CASE WHEN diagnosis = 'M' THEN 'FALSO NEGATIVO' ELSE 'falso positivo' END AS tipo_erro,
       round(qty_sum, 3) AS qty_sum, round(price_max, 3) AS price_max, n_lines
FROM cases WHERE (score >= 0.5) <> (diagnosis = 'M')""")
def v21(spark, sf):
    c = views.cases(spark, sf).withColumn("label", (F.col("diagnosis") == "M").cast("int"))
    return M.error_list(c, 0.5, top_features=["qty_sum", "price_max", "n_lines"], by=())


@query("v22_two_thresholds", WITH_SCORES + RANKING_SQL + f""",
t AS (SELECT unnest([0.5, 0.220514])::double AS threshold),
counts AS (SELECT model, threshold, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
                  count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp, count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn,
                  count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) AS n, avg((score - label) * (score - label)) AS brier
           FROM scores, t GROUP BY model, threshold)
SELECT model, round(threshold, 4) AS threshold, {ALL_RATES}, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(brier, 4) AS brier, tp, fn, fp, tn
FROM counts JOIN areas USING (model) JOIN steps USING (model)""")
def v22(spark, sf):
    return tidy(M.metrics_table(M.compute_metrics(views.scores(spark, sf), [0.5, 0.220514])))


@query("v24_log_loss", WITH_SCORES + """
SELECT model, round(avg(CASE WHEN label = 1 THEN -ln(greatest(1e-15, least(1 - 1e-15, score)))
                             ELSE -ln(1 - greatest(1e-15, least(1 - 1e-15, score))) END), 6) AS log_loss FROM scores GROUP BY model""")
def v24(spark, sf):
    return tidy(M.log_loss(views.scores(spark, sf)))


GRID_SQL = WITH_SCORES + """,
grid AS (SELECT DISTINCT model, round_even(score * 1000000::double, 0) / 1000000::double AS threshold FROM scores
         UNION SELECT DISTINCT model, unnest([0, 1])::double FROM scores)"""


@query("h1_candidates", GRID_SQL + " SELECT model, round(threshold, 6) AS threshold FROM grid")
def h1(spark, sf):
    return tidy(H.candidate_grid(views.scores(spark, sf)))


# Counts of scores at or above each candidate, by looking up the raw scores below it.
SWEEP_SQL = GRID_SQL + """,
grouped AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY model, score),
cumulated AS (SELECT model, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM grouped WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
totals AS (SELECT model, sum(label) AS p, sum(1 - label) AS q FROM scores GROUP BY model),
counted AS (SELECT g.model, g.threshold, coalesce(c.tp, 0) AS tp, coalesce(c.fp, 0) AS fp, p, q
            FROM grid g ASOF LEFT JOIN cumulated c ON g.model = c.model AND g.threshold <= c.score JOIN totals t ON t.model = g.model),
sweep AS (SELECT model, threshold, tp, fp, CASE WHEN p > 0 THEN tp / p::double ELSE 0 END AS recall,
                 CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::double ELSE 0 END AS "precision",
                 CASE WHEN tp + fp + p > 0 THEN 2 * tp / (tp + fp + p)::double ELSE 0 END AS f1,
                 (q - fp) / greatest(q, 1)::double AS specificity, 100::double * (tp + fp) / (p + q) AS alarms FROM counted)"""

SWEEP_COLUMNS = """round(threshold, 6) AS threshold, round(recall, 6) AS recall, round("precision", 6) AS "precision", round(f1, 6) AS f1,
round(specificity, 6) AS specificity, round(alarms, 6) AS "alarmes_%", tp::bigint AS tp, fp::bigint AS fp"""


@query("h2_sweep", SWEEP_SQL + f" SELECT model, {SWEEP_COLUMNS} FROM sweep")
def h2(spark, sf):
    return tidy(H.threshold_sweep(views.scores(spark, sf)))


@query("h3_tune", SWEEP_SQL + f""",
best AS (SELECT model, max(threshold) FILTER (WHERE recall >= 0.99) AS hit, max(recall) AS top FROM sweep GROUP BY model),
pick AS (SELECT s.model, coalesce(hit, min(s.threshold) FILTER (WHERE s.recall = top)) AS threshold, hit IS NOT NULL AS reached
         FROM sweep s JOIN best USING (model) GROUP BY s.model, hit)
SELECT model, 0.99::double AS target_recall, reached, {SWEEP_COLUMNS} FROM sweep JOIN pick USING (model, threshold)""")
def h3(spark, sf):
    return tidy(H.tune_threshold(views.scores(spark, sf)))


BAND_SQL = """CASE WHEN score >= 0.9 THEN 'vermelho' WHEN score >= 0.220514 THEN 'amarelo' ELSE 'verde' END"""


@query("h4_bands", WITH_SCORES + f" SELECT model, id, {BAND_SQL} AS faixa_triagem FROM scores")
def h4(spark, sf):
    return H.with_band(views.scores(spark, sf), 0.220514).select("model", "id", "faixa_triagem")


@query("h5_band_counts", WITH_SCORES + f" SELECT model, {BAND_SQL} AS faixa_triagem, count(*) AS n FROM scores GROUP BY ALL")
def h5(spark, sf):
    return H.band_counts(H.with_band(views.scores(spark, sf), 0.220514), by=["model"])


REPORT_SQL = "WITH " + CASES_SQL + """,
report AS (SELECT id AS exame, score, round(score, 4) AS prob_malignidade, CASE WHEN score >= 0.220514 THEN 'SUSPEITO' ELSE 'sem sinais' END AS sugestao_ia,
       CASE WHEN score >= 0.9 THEN 'VERMELHO' WHEN score >= 0.220514 THEN 'AMARELO' ELSE 'VERDE' END AS faixa_triagem,
       CASE WHEN score >= 0.9 THEN 'Encaminhamento imediato ao mastologista'
            WHEN score >= 0.220514 THEN 'Revisao humana prioritaria (zona de incerteza)' ELSE 'Seguir fila de rotina' END AS conduta_sugerida,
       CASE WHEN label = 1 THEN 'Maligno' ELSE 'Benigno' END AS diagnostico_real, (score >= 0.220514)::int = label AS acertou FROM labelled)"""


@query("h6_report", REPORT_SQL + " SELECT * EXCLUDE (score) FROM report")
def h6(spark, sf):
    return R.triage_report(views.labelled(spark, sf), 0.220514, truth="label")


@query("h7_hits", REPORT_SQL + " SELECT count(*) FILTER (WHERE acertou) AS hits, count(*) AS n FROM report")
def h7(spark, sf):
    return R.hits(R.triage_report(views.labelled(spark, sf), 0.220514, truth="label"))


@query("h8_queue", "WITH " + CASES_SQL + """
SELECT id, round(score, 9) AS score FROM labelled ORDER BY score DESC, id""")
def h8(spark, sf):
    queue = R.urgency_queue(views.labelled(spark, sf).select("id", "score"))
    return queue.select("id", F.round("score", 9).alias("score"))


@query("flagship_triage", SWEEP_SQL + """,
pick AS (SELECT max(threshold) AS low FROM sweep WHERE model = 'a' AND recall >= 0.99),
chosen AS (SELECT s.* FROM sweep s, pick WHERE model = 'a' AND threshold = low),
banded AS (SELECT CASE WHEN score >= 0.9 THEN 'VERMELHO' WHEN score >= low THEN 'AMARELO' ELSE 'VERDE' END AS faixa_triagem FROM scores, pick WHERE model = 'a')
SELECT faixa_triagem, count(*) AS n, round(max(threshold), 6) AS threshold, round(max(recall), 6) AS recall, round(max("precision"), 6) AS "precision"
FROM banded, chosen GROUP BY faixa_triagem""")
def flagship(spark, sf):
    """At 99 per cent recall: which threshold, at what cost, and how many cases in each band?"""
    scored = views.labelled(spark, sf)
    choice = H.tune_threshold(scored.withColumn("model", F.lit("a")))
    best = {c: choice.select(c).scalar() for c in ("threshold", "recall", "precision")}
    counts = R.triage_report(scored, best["threshold"]).groupBy("faixa_triagem").agg(F.count(F.lit(1)).alias("n"))
    return tidy(counts.select("faixa_triagem", "n", *[c.alias(n) for n, c in best.items()]))
