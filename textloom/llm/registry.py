"""Queries of this subpackage and, where SQL can say the same, their SQL form."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from textloom.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Bytes of texts handed to a Python worker at once, unless the session states its own.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_BATCH_BYTES = str(64 << 20)

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application, and bound what they are given at once."""
    if spark.conf.get(_BATCH_SETTING, _SPARK_BATCH_BYTES).rstrip("b") == _SPARK_BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="textloom-code-"), "textloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
