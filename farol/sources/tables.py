"""Reading case tables and writing results."""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farol import vocabulary as words
from farol.functions.columns import col, missing_to_null
from farol.operators.normalize import normalize, rename_parts, trim_names


def case_schema(features: Sequence[str] | None = None) -> T.StructType:
    """id, label and the features in order."""
    names = list(features or words.feature_columns())
    return T.StructType([T.StructField(words.ID_COLUMN, T.LongType()), T.StructField(words.LABEL_COLUMN, T.StringType()),
                         *[T.StructField(c, T.DoubleType()) for c in names]])


def read_cases(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None, label: str = words.LABEL_COLUMN) -> DataFrame:
    """The first readable path of the list, normalised, NaN as NULL; an error if there is none.

    With a schema nothing is inferred and a malformed line fails the job. Parquet paths carry their own schema.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    for path in paths:
        try:
            return normalize(missing_to_null(_open(spark, path, schema)), label)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"none of these paths exists: {paths}")


def _open(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("nanValue", "NaN")
    return reader.schema(schema).option("enforceSchema", False).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def feature_schema(df: DataFrame, id_col: str, features: Sequence[str]) -> T.StructType:
    """The types a table's id and features have, to be kept beside a model."""
    return T.StructType([T.StructField(words.ID_COLUMN, df.schema[id_col].dataType), *[T.StructField(c, df.schema[c].dataType) for c in features]])


def read_contract(spark: SparkSession, path: str, schema: T.StructType, label: str = words.LABEL_COLUMN) -> DataFrame:
    """S1 under a contract: every line of CSV files with the columns of `schema`, `_reason` why it breaks the contract (NULL if it doesn't), its
    text in `_line` and its file in `_file`. Nothing is inferred; lines are one row each, so line breaks within quotes are not read.

    Columns are found by the header's names, in any order; others are left out, a label is kept as text. A missing feature is an error; a missing id
    is numbered. Finding the header reads up to the first such line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    id_name, first = schema.fieldNames()[0], schema.fieldNames()[1]
    plain = F.transform(F.split("value", ","), lambda c: F.replace(F.trim(F.regexp_replace(c, '"', "")), F.lit(" "), F.lit("_")))
    header = lines.where(F.array_contains(plain, first)).first()
    if header is None:
        raise ValueError(f"no header with a column '{first}' in {path}")
    cells = [c.strip() or f"_{i}" for i, c in enumerate(next(csv.reader([header["value"]], skipinitialspace=True)))]
    names = rename_parts(trim_names(spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in cells])))).columns
    place = {c: i for i, c in reversed(list(enumerate(names)))}
    absent = [c for c in schema.fieldNames()[1:] if c not in place]
    if absent:
        raise ValueError(f"{len(absent)} column(s) missing from the input: {absent[:6]}")
    text = ", ".join(f"c{i} STRING" for i in range(len(names))) + ", bad STRING"
    rows = lines.where(F.col("value") != F.lit(header["value"])).where(F.length(F.trim("value")) > 0)
    rows = rows.withColumn("_c", F.from_csv("value", text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}))
    reason, typed = F.when(F.col("_c.bad").isNotNull(), F.lit("wrong number of cells")), []
    for f in schema.fields:
        if f.name == id_name and id_name not in place:
            typed.append(F.monotonically_increasing_id().alias(id_name))
            continue
        cell = F.col(f"_c.c{place[f.name]}")
        value = cell.try_cast(f.dataType)
        reason = reason.when(cell.isNotNull() & value.isNull(), F.lit(f"{f.name} is not a {f.dataType.simpleString()}"))
        typed.append(value.alias(f.name))
    if id_name in place:
        reason = reason.when(F.col(f"_c.c{place[id_name]}").isNull(), F.lit(f"{id_name} is missing"))
    known = [F.col(f"_c.c{place[label]}").alias(label)] if label in place else []
    return rows.select(*typed, *known, reason.alias("_reason"), F.col("value").alias("_line"), "_file")


def accepted_rows(checked: DataFrame) -> DataFrame:
    """The rows of `read_contract` that keep the contract, NaN as NULL."""
    return missing_to_null(checked.where("_reason IS NULL").drop("_reason", "_line", "_file"))


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The lines of `read_contract` that break the contract: reason, line and file."""
    return checked.where("_reason IS NOT NULL").select("_reason", "_line", "_file")


def read_headerless(spark: SparkSession, path: str, features: Sequence[str] | None = None) -> DataFrame:
    """A CSV without header: id, label, then the features in their fixed order."""
    return normalize(missing_to_null(spark.read.schema(case_schema(features)).option("mode", "FAILFAST").csv(path, header=False)))


def keep_copy(df: DataFrame, path: str) -> None:
    """Write the table unless there already is one."""
    df.write.mode("ignore").parquet(path)


def write_metrics(table: DataFrame, path: str, key: str | None = None) -> None:
    """A metric-sized table as one CSV part with the key column first."""
    columns = ([key] if key else []) + [c for c in table.columns if c != key]
    table.select(*[col(c) for c in columns]).coalesce(1).write.mode("overwrite").csv(path, header=True)


def manifest_table(spark: SparkSession, manifest: dict) -> DataFrame:
    """A nested record as one row with a `value` column of JSON text."""
    return spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False, default=str),)], "value string")


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """The record as UTF-8 JSON, one document."""
    manifest_table(spark, manifest).coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_report(report: DataFrame, path: str) -> None:
    """The triage report as CSV with header; every task writes its own part."""
    report.write.mode("overwrite").csv(path, header=True, encoding="UTF-8")


def read_images(spark: SparkSession, path: str, pixels: str = "pixels", split: str = "split") -> DataFrame:
    """Images as an array column next to their label and official split."""
    images = spark.read.parquet(path)
    names = [f.name for f in images.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if pixels not in names or split not in images.columns:
        raise ValueError(f"expected an array column '{pixels}' and a column '{split}', found {images.columns}")
    parts = [r[0] for r in images.select(col(split)).distinct().limit(10).collect()]
    unknown = sorted(set(map(str, parts)) - {"train", "val", "test"})
    if unknown:
        raise ValueError(f"unknown split names: {unknown}")
    return images


def read_image_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw image files as (path, length, content); the split is the folder `train`, `val` or `test`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "content", F.regexp_extract("path", "/(train|val|test)/", 1).alias("split"))
