"""Tables of the corpus and how they are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MOVIES = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("full_script", T.StringType()),
    T.StructField("scenes", T.ArrayType(T.StringType())),
    T.StructField("tropes", T.ArrayType(T.StringType())),
    T.StructField("global_analysis", T.StringType()),
])
TROPES = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("definition", T.StringType()),
])


def load(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """A Parquet table, cut to ``columns`` so that the scan reads no others."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Create an empty Parquet table; False when it was there already."""
    if spark.catalog.tableExists(table):
        return False
    spark.catalog.createTable(table, source="parquet", schema=schema)
    return True
