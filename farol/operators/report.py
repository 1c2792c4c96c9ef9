"""The triage report: one line per case with suggestion, band and action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col
from farol.operators.threshold import band


def triage_report(scored: DataFrame, threshold: float | Column, high: float = words.HIGH_RISK, id_col: str = words.ID_COLUMN,
                  score: str = "score", truth: str | None = None) -> DataFrame:
    """H6: suggestion and band use the unrounded score; with `truth` (0/1) the real class and a hit flag.

    A plain projection: no shuffle, and it works on a stream as it does on a table.
    """
    low = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    value = col(score)
    suspicious = value >= low
    color = band(value, low, high, upper=True)
    action = F.try_element_at(F.create_map(*[F.lit(x) for kv in words.ACTIONS.items() for x in kv]), color)
    cells = [col(id_col).alias("exame"), F.round(value, 4).alias("prob_malignidade"),
             F.when(suspicious, words.SUGGESTION_POSITIVE).when(~suspicious, words.SUGGESTION_NEGATIVE).alias("sugestao_ia"),
             color.alias("faixa_triagem"), action.alias("conduta_sugerida")]
    if truth:
        cells += [F.when(col(truth) == 1, words.CLASS_NAMES[1]).when(col(truth) == 0, words.CLASS_NAMES[0]).alias("diagnostico_real"),
                  (suspicious.cast("int") == col(truth)).alias("acertou")]
    return scored.select(*cells)


def hits(report: DataFrame) -> DataFrame:
    """H7: correct suggestions and rows."""
    return report.agg(F.count_if("acertou").alias("hits"), F.count(F.lit(1)).alias("n"))


def urgency_queue(scored: DataFrame, id_col: str = words.ID_COLUMN, score: str = "score") -> DataFrame:
    """H8: most urgent case first; a range-partitioned sort."""
    return scored.orderBy(F.desc(score), col(id_col))
