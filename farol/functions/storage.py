"""Cutting lineage with a written table in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
JOB_BY_JOB = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; on a local master without it, one temporary folder per session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[key] = tempfile.mkdtemp(prefix="farol-")
    return _LOCAL_FOLDERS[key]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/farol/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, part: str | None = None) -> DataFrame:
    """Write the table once and read it back: later jobs start from files, also after an executor is lost.

    With `part` the files are kept apart by that column, so a filter on it reads only its own files.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=part)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def job_by_job(spark: SparkSession) -> Iterator[None]:
    """For a loop of queries over narrow rows: the settings of JOB_BY_JOB hold within it.

    The shuffle files of a query are deleted when it ends, not when the driver happens to collect its garbage, so the loop needs the disk of one query;
    a query run a second time repeats its stages. Batches for Python are cut by rows alone, as the bytes of a batch are added up anew for each row.
    """
    before = {k: spark.conf.get(k, None) for k in JOB_BY_JOB}
    for k, v in JOB_BY_JOB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
