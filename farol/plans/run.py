"""The whole training run and the batch scoring of new cases."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farol import vocabulary as words
from farol.functions.columns import col
from farol.functions.storage import written
from farol.operators import audit as A
from farol.operators import correlate as C
from farol.operators import describe as D
from farol.operators import explain as E
from farol.operators import explore as X
from farol.operators import metrics as M
from farol.operators import threshold as H
from farol.operators.normalize import check_labels, normalize, sample_rows, split_truth, with_target
from farol.operators.prep import fit_medians, imputed, infer_roles
from farol.operators.split import split_summary, stratified_split, train_and_validation
from farol.plans import training as T
from farol.plans.catalog import FAMILIES, Family, with_score
from farol.sources.artifact import Artifact, load_artifact, save_artifact
from farol.sources.tables import (accepted_rows, feature_schema, read_cases, read_contract, rejected_rows, write_manifest, write_metrics,
                                  write_report)


def train_triage(cases: DataFrame, output: str, families: Sequence[Family] = FAMILIES, target_recall: float = words.TARGET_RECALL,
                 k: int = words.FOLDS, seed: int = words.SEED, quick: bool = False, repeats: int = 20, shapley: bool = True,
                 learning: bool = True, figures: bool = True, id_col: str = words.ID_COLUMN, label: str = words.LABEL_COLUMN, parallelism: int = 4) -> dict:
    """From a normalised case table to a saved model, with all result tables under `output`. Returns the manifest.

    The table is written once with its target and split; every later step reads that file. The test
    rows are used only after model and threshold are fixed. `figures` writes the tables behind the figures.
    """
    spark, started = cases.sparkSession, time.perf_counter()
    manifest: dict = {"executado_em": datetime.now(timezone.utc).isoformat(timespec="seconds"), "semente": seed,
                      "recall_alvo": target_recall, "modo_rapido": quick}
    numeric, categorical = infer_roles(cases, [id_col, label])
    roles = T.Roles(numeric, categorical)
    target = with_target(check_labels(cases, label), label, name="label").withColumn("label", F.col("label").cast("int"))
    parts = written(stratified_split(target.withColumnRenamed(id_col, "id"), "label", seed=seed), "cases", "split")

    findings = A.audit(parts.drop("label", "split"), "id", label).first().asDict(recursive=True)
    write_manifest(spark, findings, f"{output}/01_audit")
    write_metrics(D.describe_numeric(parts, numeric), f"{output}/02_describe", "feature")
    manifest["dataset"] = {"n_amostras": findings["n_rows"], "n_features": len(roles.features), "valores_ausentes": findings["missing_total"],
                           "linhas_duplicadas": findings["duplicated_rows"]}
    with_label = C.correlation_with_target(parts, numeric, "label")
    top = [r["feature"] for r in with_label.limit(9).collect()]
    pairs = C.redundant_pairs(C.correlation_matrix(parts, numeric))
    write_metrics(with_label, f"{output}/03_with_target", "feature")
    write_metrics(pairs, f"{output}/04_redundant_pairs")
    manifest["correlacao"] = {"colunas_redundantes": C.suggested_drops(pairs, with_label)}
    summary = split_summary(parts, "label")
    write_metrics(summary, f"{output}/06_split", "split")
    manifest["particoes"] = [r.asDict() for r in summary.collect()]

    if figures:
        shown = top or numeric
        write_metrics(D.class_balance(parts, label), f"{output}/figures/class_balance", "class")
        write_metrics(D.scale_and_skew(parts, numeric), f"{output}/figures/scale_and_skew", "feature")
        write_metrics(X.density_histogram(parts, shown, label), f"{output}/figures/histograms", "feature")
        write_metrics(X.density_curve(parts, shown, label), f"{output}/figures/densities", "feature")
        write_metrics(X.box_table(parts, shown, label), f"{output}/figures/boxes", "feature")
        write_metrics(C.lower_triangle(C.correlation_matrix(parts, numeric)), f"{output}/figures/correlation")
        complete = imputed(parts, fit_medians(parts, numeric))
        write_metrics(X.component_variance(complete, numeric), f"{output}/figures/component_variance", "component")
        write_metrics(X.component_loadings(complete, numeric), f"{output}/figures/component_loadings", "component")
        write_report(X.projected_points(complete, numeric, label, "id"), f"{output}/figures/projection")
        write_report(X.scatter_pairs(parts, (top or numeric)[:4], label, "id"), f"{output}/figures/pairs")

    train, validation, test = (parts.where(F.col("split") == s) for s in ("train", "val", "test"))
    trained = T.train_all(train, roles, families, k, seed, quick, parallelism)
    best = None
    for t in trained.values():
        best = t.summary if best is None else best.unionByName(t.summary)
    write_metrics(T.cv_table(best), f"{output}/07_cross_validation", "family")
    scorers = {key: t.scorer for key, t in trained.items()}
    on_validation = written(T.score_table(scorers, validation), "validation")
    validation_metrics = M.compute_metrics(on_validation)
    write_metrics(M.metrics_table(validation_metrics), f"{output}/08_validation", "model")
    ranking = T.selection_ranking(best, validation_metrics.withColumnRenamed("model", "family"))
    write_metrics(ranking, f"{output}/08b_ranking", "chave")
    champion = trained[ranking.first()["chave"]]
    manifest["selecao_campeao"] = {"campeao": champion.family.label, "ranking": [r.asDict() for r in ranking.collect()]}

    sweep = H.threshold_sweep(on_validation.where(F.col("model") == champion.family.key))
    write_metrics(sweep.orderBy("threshold"), f"{output}/09_threshold_curve")
    choice = H.choose_threshold(sweep, target_recall).first()
    threshold = choice["threshold"]
    manifest["limiar"] = {"valor": round(threshold, 4), "recall_validacao": round(choice["recall"], 4),
                          "precisao_validacao": round(choice["precision"], 4), "recall_alvo": target_recall}

    final = T.refit(parts, roles, champion, seed)
    tested = written(final.score(test).withColumn("model", F.lit(champion.family.key)), "test")
    clinical = M.compute_metrics(tested, [words.DEFAULT_THRESHOLD, threshold])
    write_metrics(M.metrics_table(clinical), f"{output}/10_test", "model")
    everyone = M.compute_metrics(T.score_table(scorers, test))
    write_metrics(M.metrics_table(everyone), f"{output}/11_test_all_models", "model")
    errors = M.error_list(tested, threshold, top_features=top)
    write_report(errors, f"{output}/12_errors")
    bands = {r[0]: r["n"] for r in H.band_counts(H.with_band(tested, threshold)).collect()}
    rows = {r["threshold"]: r.asDict() for r in clinical.collect()}
    manifest["teste"] = {"campeao": champion.family.label, "limiar_padrao_0.50": rows[words.DEFAULT_THRESHOLD], "limiar_clinico": rows[threshold],
                         "faixas_triagem": bands, "n_erros_limiar_clinico": rows[threshold]["fp"] + rows[threshold]["fn"]}
    if figures:
        write_report(M.roc_curve(on_validation), f"{output}/figures/roc")
        write_report(M.pr_curve(on_validation), f"{output}/figures/precision_recall")
        write_metrics(M.model_comparison(M.metrics_table(validation_metrics)), f"{output}/figures/comparison")
        write_metrics(M.confusion_matrix(tested, threshold), f"{output}/figures/confusion")
        write_metrics(M.score_histogram(tested), f"{output}/figures/scores")
        write_metrics(M.calibration_curve(tested), f"{output}/figures/calibration")
    if learning:
        write_metrics(T.learning_curve(parts, roles, champion.family, champion.params, k, seed, parallelism=parallelism), f"{output}/16_learning_curve")

    native = E.native_importance(spark, final.model, final.names())
    if native is not None:
        write_metrics(native, f"{output}/13_native_importance", "feature")
    reference = T.reference_logistic(parts, roles, seed)
    odds = E.native_importance(spark, reference.model, reference.names())
    write_metrics(odds, f"{output}/17_reference_logistic", "feature")
    manifest["referencia_logistica"] = [r.asDict() for r in odds.limit(10).collect()]
    permuted = E.permutation_importance(test.select("id", "label", *[col(c) for c in roles.features]), roles.features, final.score,
                                        repeats=repeats, seed=seed)
    write_metrics(permuted, f"{output}/14_permutation", "feature")
    if shapley:
        shap, base = explain(final, train_and_validation(parts), test, seed)
        shap = written(shap, "shap")
        write_metrics(E.global_importance(shap), f"{output}/15_shapley", "feature")
        write_report(E.beeswarm(shap), f"{output}/figures/beeswarm")
        manifest["shap_base"] = base
        for r in E.representative_cases(tested, threshold).collect():
            write_metrics(E.single_case(shap, r["id"], base), f"{output}/22_case_{r['case']}")
    write_metrics(T.missing_robustness(final, test, roles, threshold, seed=seed), f"{output}/16_missing", "pct_celulas_ausentes")

    metadata = {"threshold": threshold, "model_label": champion.family.label, "model_key": champion.family.key, "best_params": champion.params,
                "feature_order": roles.features, "schema": feature_schema(cases, id_col, roles.features).json(), "class_names": list(words.CLASS_NAMES), "trained_at": manifest["executado_em"],
                "test_metrics": rows[threshold]}
    save_artifact(f"{output}/model", final, metadata)
    manifest |= {"modelo_salvo": f"{output}/model", "melhores_hiperparametros": champion.params,
                 "duracao_segundos": round(time.perf_counter() - started, 1)}
    write_manifest(spark, manifest, f"{output}/00_manifest")
    return manifest


def explain(scorer: T.Scorer, background: DataFrame, rows: DataFrame, seed: int = words.SEED) -> tuple[DataFrame, float]:
    """I5 and I6 for a fitted scorer of any family: Shapley values of `rows` against a sample of `background`, and the base value.

    Models with a numpy form are walked inside tasks, the others score a table of masked rows.
    """
    matrix, prepared = E.background_matrix(scorer.prep.transform(background), seed=seed), scorer.prep.transform(rows)
    if scorer.model.__class__.__name__ not in E.TASK_SIDE:
        return E.shapley_by_transform(prepared, lambda table: with_score(scorer.model.transform(table)), matrix, scorer.names(), seed=seed)
    score = E.scorer_of(scorer.model)
    return E.shapley_values(prepared, score, matrix, scorer.names(), seed=seed), E.base_value(score, matrix)


def score_file(spark: SparkSession, model: str | Artifact, input_path: str, output_path: str | None = None, label: str = words.LABEL_COLUMN) -> DataFrame:
    """Batch inference: read, normalise, check the feature contract, score, and write the report if asked. The label is optional.

    A CSV is read once, with the types the model was trained on; lines that do not keep to them are written beside the report with the reason.
    """
    artifact = load_artifact(spark, model) if isinstance(model, str) else model
    if "schema" in artifact.metadata and not input_path.rstrip("/").endswith(".parquet"):
        checked = written(read_contract(spark, input_path, StructType.fromJson(json.loads(artifact.metadata["schema"])), label), "checked")
        rows, known = split_truth(normalize(accepted_rows(checked), label), label)
        if output_path:
            write_report(rejected_rows(checked), f"{output_path}-rejected")
    else:
        rows, known = split_truth(read_cases(spark, input_path), label)
    report = artifact.report(rows, truth=words.TARGET_NAME if known else None)
    if output_path:
        write_report(report, output_path)
    return report


def demo_report(artifact: Artifact, cases: DataFrame, n: int = 10, seed: int = words.SEED) -> DataFrame:
    """The report of n cases drawn from a labelled table; some of them were seen in training."""
    return artifact.report(with_target(sample_rows(cases, n, seed=seed)), truth=words.TARGET_NAME)
