"""Catalog-level helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES


def register_tables(spark: SparkSession, paths: dict[str, str]) -> None:
    """Expose Parquet folders as temp views for SQL."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def execute_query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Ad-hoc SQL returning a lazy DataFrame.

    Values are bound as named parameters (``:name``), never interpolated into
    the SQL text.
    """
    return spark.sql(sql, args=params or None)


def create_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Create the five empty tables as Parquet folders with their schemas."""
    out = {}
    for name, schema in TABLES.items():
        path = f"{root}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        out[name] = path
    return out


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, column count, row count.

    Column counts come from the schema (metadata); row counts from one
    aggregate per table, unioned into one result.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "n_rows")
        for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_schema(tables: dict[str, DataFrame]) -> DataFrame:
    """Every table's columns and types as one DataFrame."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, f.name, f.dataType.simpleString(), f.nullable)
            for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, "
                                       "data_type string, nullable boolean")


def missing_tables(spark: SparkSession, expected: list[str], present: list[str]) -> DataFrame:
    """Expected-vs-present table names as a left join of the expected list."""
    e = spark.createDataFrame([(t,) for t in expected], "table_name string")
    p = spark.createDataFrame([(t,) for t in present], "table_name string").withColumn("present", F.lit(True))
    return e.join(p, "table_name", "left").select("table_name", F.coalesce("present", F.lit(False)).alias("present"))


def get_table_info(df: DataFrame) -> DataFrame:
    """Column names, types and nullability of one table, as a DataFrame (metadata only)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def get_row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (lazy; nothing is collected here)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
