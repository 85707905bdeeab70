"""Small Spark helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histdim.session import frozen as stored  # noqa: F401  (used by the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads; other columns, whatever their
    names, stay out of its way."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
