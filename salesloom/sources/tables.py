"""Stored tables: definition, append, load that skips known keys, views, metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators.numbering import new_members


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> DataFrame:
    """Create an empty Parquet table at ``path`` unless the name exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def append(df: DataFrame, name: str) -> None:
    """Append rows to a stored table, columns matched by name and cast to its types."""
    target = df.sparkSession.table(name)
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    rows.write.insertInto(name)


def create_clustered(df: DataFrame, name: str, by: str, buckets: int, path: str) -> DataFrame:
    """Store ``df`` as a table in buckets of ``by``, sorted by it.

    Groupings and joins by that column then need no shuffle: equal values lie in files of one bucket.
    The rows are dealt out as the buckets are, so each bucket is one file.
    """
    dealt = df.repartition(buckets, by)
    dealt.write.option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)


def append_new_members(
    incoming: DataFrame,
    name: str,
    unique: Sequence[str],
    key: str,
    attributes: Sequence[str] = (),
) -> None:
    """Append the members a stored dimension lacks; running it again changes nothing."""
    existing = incoming.sparkSession.table(name)
    append(new_members(existing, incoming, unique, key, attributes), name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a named view and read it back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(len(df.columns)).cast("long").alias("column_count"), F.count("*").alias("row_count")
    )


def data_dictionary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: position, type, and the table's row count.

    Types come from the schemas; the rows are counted from the tables, a count
    the Parquet footers answer without reading a column.
    """
    parts = []
    for name, df in tables.items():
        entries = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                F.lit(position).alias("ordinal"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit("YES" if field.nullable else "NO").alias("is_nullable"),
                F.col("n").alias("table_rows"),
            )
            for position, field in enumerate(df.schema.fields, 1)
        ]
        rows = df.agg(F.count("*").alias("n"))
        parts.append(rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("table_name", "ordinal")
