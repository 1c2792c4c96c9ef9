"""Views of the given tables in the shapes the operators expect.

`cases` is one row per order with a planted label and a planted score, so every operator has an
input that grows with the tables. The SQL texts define the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.functions.keys import TWO_32, keyed_int, keyed_unit

NUMERIC = ("total", "n_lines", "qty_sum", "price_max", "disc_avg", "tax_avg", "qty_min")
WIDE = tuple(f"f{i:02d}" for i in range(64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; large files are split by bytes, AQE sizes the partitions after the first shuffle."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("double").alias("qty_sum"),
        F.max("l_extendedprice").cast("double").alias("price_max"), F.avg("l_discount").cast("double").alias("disc_avg"),
        F.avg("l_tax").cast("double").alias("tax_avg"), F.min("l_quantity").cast("double").alias("qty_min"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_totalprice").cast("double").alias("total"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    joined = orders.join(lines, "id", "left")
    z = (F.coalesce("qty_sum", F.lit(0.0)) / 100.0 + F.coalesce("price_max", F.lit(0.0)) / 100000.0
         + keyed_int("noise", F.col("id")) / F.lit(TWO_32))
    draws = [keyed_int(s, F.col("id")) for s in ("s1", "s2", "s3")]
    score = F.when(F.col("z") > 2.55, F.greatest(*draws)).otherwise(F.least(*draws)) / F.lit(TWO_32)
    return joined.withColumn("z", z).select(
        "id", "total", "n_lines", "qty_sum", "price_max", "disc_avg", "tax_avg", "qty_min", "priority", "status", "z",
        F.when(F.col("z") > 2.55, "M").otherwise("B").alias("diagnosis"), score.alias("score"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, score) of the cases."""
    return cases(spark, sf_dir).select("id", (F.col("diagnosis") == "M").cast("int").alias("label"), "score")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, id, label, score): `a` good, `b` uninformative, `c` with heavy ties, `d` with one class only."""
    return scores_of(labelled(spark, sf_dir))


def scores_of(base: DataFrame) -> DataFrame:
    """The score table of a table (id, label, score); its other columns stay with their rows."""
    more = [c for c in base.columns if c not in ("id", "label", "score")]
    per_model = F.explode(F.array(
        F.struct(F.lit("a").alias("model"), F.col("score").alias("s")),
        F.struct(F.lit("b").alias("model"), keyed_unit("b", F.col("id")).alias("s")),
        F.struct(F.lit("c").alias("model"), (F.rint(F.col("score") * 100.0) / 100.0).alias("s")),
        F.struct(F.lit("d").alias("model"), F.when(F.col("label") == 0, F.col("score")).alias("s"))))
    long = base.select("id", "label", *more, per_model.alias("m"))
    return long.select("m.model", "id", "label", F.col("m.s").alias("score"), *more).where("score IS NOT NULL")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimensions of the embeddings as numeric features, `copy` a near copy of the first, and a 0/1 label."""
    e = table(spark, sf_dir, "embeddings")
    features = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(WIDE)]
    near = (F.col("embedding")[0].cast("double") + 0.01 * F.col("embedding")[1].cast("double")).alias("copy")
    return e.select(F.col("vec_id").alias("id"), *features, near, (F.col("label") < 4).cast("int").alias("label"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with repeated ids, repeated rows and a constant column."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"), F.col("l_discount").cast("double").alias("l_discount"),
        F.col("l_tax").cast("double").alias("l_tax"), F.lit(7).alias("l_constant"))
    return lines.unionAll(lines.where("l_linenumber = 1"))


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive, right-skewed event values with a two-valued class."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("value").cast("double").alias("value"),
                    F.when(F.col("event_type") == "error", "M").otherwise("B").alias("diagnosis"))


def text_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label: one numeric and two categorical features."""
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"), F.col("n_chars").cast("double").alias("n_chars"),
        "lang", "source")


CASES_SQL = """
l AS (SELECT l_orderkey, count(*) n_lines, sum(l_quantity)::double qty_sum, max(l_extendedprice)::double price_max,
             avg(l_discount)::double disc_avg, avg(l_tax)::double tax_avg, min(l_quantity)::double qty_min
      FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o.o_orderkey::bigint id, o.o_totalprice::double total, l.n_lines, l.qty_sum, l.price_max, l.disc_avg, l.tax_avg,
             l.qty_min, o.o_orderpriority priority, o.o_orderstatus status,
             coalesce(l.qty_sum, 0)::double / 100::double + coalesce(l.price_max, 0)::double / 100000::double
             + ('0x' || substr(md5('noise|' || o.o_orderkey::varchar), 1, 8))::bigint / 4294967296::double z
      FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey),
h AS (SELECT *, ('0x' || substr(md5('s1|' || id::varchar), 1, 8))::bigint h1,
             ('0x' || substr(md5('s2|' || id::varchar), 1, 8))::bigint h2,
             ('0x' || substr(md5('s3|' || id::varchar), 1, 8))::bigint h3 FROM b),
cases AS (SELECT id, total, n_lines, qty_sum, price_max, disc_avg, tax_avg, qty_min, priority, status, z,
                 CASE WHEN z > 2.55::double THEN 'M' ELSE 'B' END diagnosis,
                 CASE WHEN z > 2.55::double THEN greatest(h1, h2, h3) ELSE least(h1, h2, h3) END / 4294967296::double score
          FROM h),
labelled AS (SELECT id, (diagnosis = 'M')::int AS label, score FROM cases)"""

SCORES_SQL = CASES_SQL + """,
scores AS (SELECT 'a' AS model, id, label, score FROM labelled
           UNION ALL SELECT 'b', id, label, ('0x' || substr(md5('b|' || id::varchar), 1, 8))::bigint / 4294967296::double FROM labelled
           UNION ALL SELECT 'c', id, label, round_even(score * 100::double, 0) / 100::double FROM labelled
           UNION ALL SELECT 'd', id, label, score FROM labelled WHERE label = 0)"""

WIDE_SQL = ("wide AS (SELECT vec_id AS id, "
            + ", ".join(f"embedding[{i + 1}]::double AS {c}" for i, c in enumerate(WIDE))
            + ", embedding[1]::double + 0.01::double * embedding[2]::double AS copy, (label < 4)::int AS label FROM embeddings)")

DIRTY_SQL = """
lines AS (SELECT l_orderkey AS id, l_linenumber, l_quantity::double AS l_quantity, l_extendedprice::double AS l_extendedprice,
                 l_discount::double AS l_discount, l_tax::double AS l_tax, 7 AS l_constant FROM lineitem),
dirty AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber = 1)"""

SKEWED_SQL = """
skewed AS (SELECT event_id AS id, value::double AS value, CASE WHEN event_type = 'error' THEN 'M' ELSE 'B' END AS diagnosis FROM events)"""

TEXT_SQL = """
text_cases AS (SELECT doc_id AS id, quality::int AS quality, n_chars::double AS n_chars, lang, source
               FROM labels JOIN documents USING (doc_id))"""


def sql_unit(salt: str, key: str = "id") -> str:
    """DuckDB text of the keyed uniform number."""
    return f"('0x' || substr(md5('{salt}|' || {key}::varchar), 1, 8))::bigint / 4294967296::double"


def sql_digest(salt: str, key: str = "id") -> str:
    return f"md5('{salt}|' || {key}::varchar)"
