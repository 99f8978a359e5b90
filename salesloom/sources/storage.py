"""Tables written to the folder that all executors share.

A written table is how lineage is cut: it survives the loss of any executor, and
a reader sees the same rows in the same files however often it is retried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_METHOD_BYTES = 8000  # HotSpot's own limit


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or one below the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/salesloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def compiled_methods(spark: SparkSession) -> None:
    """Have Spark split up methods of over 8000 bytes, unless the session asks for less: the JVM never compiles those.

    A projection of many columns would otherwise be interpreted, row by row. The setting stays with
    the session, as tables and results are computed later.
    """
    if int(spark.conf.get(_METHOD_LIMIT)) > _METHOD_BYTES:
        spark.conf.set(_METHOD_LIMIT, str(_METHOD_BYTES))


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a finished write frees its shuffle files at once instead of at the next garbage run."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def write_and_read(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` as Parquet and return the written rows, with no lineage or shuffle files behind them."""
    with short_lived_shuffles(df.sparkSession):
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    # Partition columns come last when read; the select puts them back in their place.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    return write_and_read(df, fresh_path(df.sparkSession, label), partition_by=partition_by)


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside by ``pass_on`` are deleted at the end: what they were written for must then be written."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            _delete(spark, path)


def pass_on(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` for a step on the way to a table; outside of ``passing_tables`` the files stay."""
    path = fresh_path(df.sparkSession, label)
    paths = _passing.get()
    if paths is not None:
        paths.append(path)
    return write_and_read(df, path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application has written below the shared folder; nothing reads it later."""
    _delete(spark, f"{shared_dir(spark)}/salesloom/{spark.sparkContext.applicationId}")
