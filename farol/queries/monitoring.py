"""Queries for scores over time (X2): events as scored cases that arrive some time after they happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.functions.keys import keyed_int
from farol.functions.storage import fresh_path
from farol.queries import views
from farol.queries.registry import query, tidy
from farol.streaming import drift as D

DELAY, THRESHOLD, BASELINE_DAYS = 7200, 0.5, 7


def arrivals(events: DataFrame) -> DataFrame:
    """Scored events: one in twenty arrives up to a day after it happened, the others within an hour."""
    happened = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")) if dict(events.dtypes)["ts"] == "timestamp_ntz" else F.col("ts")
    draw = keyed_int("arrival", F.col("event_id"))
    wait = F.when(F.pmod(draw, F.lit(20)) == 0, F.pmod(draw, F.lit(86400))).otherwise(F.pmod(draw, F.lit(3600)))
    rows = events.select("event_id", "event_type", (F.col("value") / (F.col("value") + 50.0)).alias("score"), happened.alias("time"), wait.alias("wait"))
    return rows.withColumn("arrival", F.timestamp_micros(F.unix_micros("time") + F.col("wait") * 1000000)).drop("wait")


def first_days(rows: DataFrame) -> D.Baseline:
    begin = rows.agg(F.min("time")).first()[0]
    return D.baseline(rows.where(F.col("time") < F.lit(begin) + F.make_dt_interval(days=F.lit(BASELINE_DAYS))))


def shown(table: DataFrame) -> DataFrame:
    return tidy(table.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")}))


_BINS = range(10)
DRIFT_SQL = f"""
WITH d AS (SELECT event_id, event_type, value / (value + 50::double) AS score, epoch_us(ts) AS t,
                  ('0x' || substr(md5('arrival|' || event_id::varchar), 1, 8))::bigint AS draw FROM events),
a AS (SELECT *, CASE WHEN draw % 20 = 0 THEN draw % 86400 ELSE draw % 3600 END AS wait FROM d),
first AS (SELECT score FROM a WHERE t < (SELECT min(t) FROM a) + {BASELINE_DAYS} * 86400000000),
edges AS (SELECT list_distinct(quantile_cont(score, [{', '.join(str(i / 10) for i in range(1, 10))}])) AS e FROM first),
base AS (SELECT len(list_filter(e, lambda x: x < score)) AS bin, count(*) AS n FROM first, edges GROUP BY 1),
placed AS (SELECT event_type, score, wait > {DELAY} AS late, CASE WHEN wait > {DELAY} THEN t + wait * 1000000 ELSE t END AS placed_at,
                  len(list_filter(e, lambda x: x < score)) AS bin FROM a, edges),
w AS (SELECT placed_at // 86400000000 AS day, event_type, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS late,
             count(*) FILTER (NOT late AND score IS NULL) AS unscored, avg(score) FILTER (NOT late) AS mean_score,
             avg((score >= {THRESHOLD})::int) FILTER (NOT late) AS alarm_rate
      FROM placed WHERE placed_at IS NOT NULL GROUP BY ALL),
met AS (SELECT w.day, w.event_type, b.bin, b.n AS base_rows, w.n - w.unscored AS scored, count(p.score) AS seen_rows
        FROM w CROSS JOIN base b LEFT JOIN placed p ON p.placed_at // 86400000000 = w.day AND p.event_type IS NOT DISTINCT FROM w.event_type AND p.bin = b.bin AND NOT p.late
        GROUP BY ALL),
bins AS (SELECT day, event_type, bin, (base_rows + 0.5::double) / (sum(base_rows) OVER g + 0.5::double * count(*) OVER g) AS expected,
                (seen_rows + 0.5::double) / (scored + 0.5::double * count(*) OVER g) AS seen FROM met WINDOW g AS (PARTITION BY day, event_type)),
upto AS (SELECT *, sum(seen - expected) OVER (PARTITION BY day, event_type ORDER BY bin) AS gap FROM bins),
s AS (SELECT day, event_type, sum((seen - expected) * ln(seen / expected)) AS stability, max(abs(gap)) AS distance FROM upto GROUP BY ALL),
drift AS (SELECT w.day * 86400 AS window_start, (w.day + 1) * 86400 AS window_end, w.event_type, n, late, unscored, round(mean_score, 6) AS mean_score, round(alarm_rate, 6) AS alarm_rate,
                 CASE WHEN n > unscored THEN round(stability, 6) END AS stability, CASE WHEN n > unscored THEN round(distance, 6) END AS distance,
                 CASE WHEN n = unscored THEN NULL WHEN stability >= {D.DRIFTED} THEN 'drifted' WHEN stability >= {D.SHIFTED} THEN 'shifted' ELSE 'stable' END AS state
          FROM w JOIN s ON s.day = w.day AND s.event_type IS NOT DISTINCT FROM w.event_type)
SELECT * FROM drift"""


@query("x2_drift", DRIFT_SQL)
def x2(spark: SparkSession, sf: str) -> DataFrame:
    rows = arrivals(views.table(spark, sf, "events"))
    return shown(D.drift(rows, first_days(rows), THRESHOLD, delay=DELAY, by=["event_type"]))


@query("x2_drift_stream", DRIFT_SQL + f" WHERE window_end * 1000 <= (SELECT max(placed_at) // 1000 FROM placed) - {DELAY} * 1000")
def x2_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The windows that the stream has closed when it has read the whole table."""
    events = views.table(spark, sf, "events")
    stream = arrivals(spark.readStream.schema(events.schema).parquet(f"{sf}/events.parquet*"))  # a pattern: the table may be one file or a folder
    table = D.drift(stream, first_days(arrivals(events)), THRESHOLD, delay=DELAY, by=["event_type"])
    output = fresh_path(spark, "drift")
    D.stream_drift(table, output, fresh_path(spark, "drift-state")).awaitTermination()
    return shown(spark.read.schema(table.schema).parquet(output))
