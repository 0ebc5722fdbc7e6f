"""Batch sources and sinks over files (SRC1-3, SRC6, SNK1, SNK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan (SRC1); filters and column pruning reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register tables for SQL (SRC2), the non-deprecated form of registerTempTable."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def write_jsonl(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> str:
    """JSON Lines sink (SNK1). ``files`` bounds the file count with a coalesce
    (no shuffle); by default every partition writes its own file in parallel."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).json(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON Lines bulk load with an explicit schema (SRC3): no inference pass."""
    return spark.read.schema(schema).json(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Set-wise append of rows to a table folder (SNK7)."""
    df.write.mode("append").format(fmt).save(path)
    return path
