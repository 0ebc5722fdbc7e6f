"""Pages by offset over a stored sort order (LIM1 with SRT3/SRT4).

``offset(n).limit(m)`` makes every task and the driver keep n + m rows, so page
after page of a long result costs more. ``build`` writes a table once in its sort
order, in parts of about ``ROWS_PER_PART`` rows, with a directory: the rows of each
part, and how many rows lie before it. ``page_at`` finds the one or two parts that
hold a page in the directory and reads these alone, at any offset.

``within`` columns come before the sort order, and the directory counts the rows of
each of their values by part: a page of the rows with one value (one carrier's
flights) is found the same way, and a value that most rows have is spread over as
many parts as it needs.
"""

from __future__ import annotations

import json
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Rows of a part (some 80 MB in a sort, which is then not spilled), and the most parts of
#: a table (they are the reduce tasks of the build).
ROWS_PER_PART = 250_000
MAX_PARTS = 20_000

PART, START, ROWS = "_part", "_start", "_rows"


def _with_part(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(PART, IntegerType())])


def build(df: DataFrame, order: list[str], path: str, within: list[str] | None = None, rows_per_part: int = ROWS_PER_PART,
          descending: tuple[str, ...] = ()) -> str:
    """Write ``df`` in the order ``within`` + ``order`` (missing values last). The order
    should be total; rows that are equal in it may take each other's places."""
    spark, within = df.sparkSession, list(within or [])
    keys = [F.col(c) for c in within] + [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in order]
    parts = max(1, min(MAX_PARTS, -(-df.count() // rows_per_part)))
    # A row's part follows from its values and the sampled range bounds; the number is
    # written with the row, so nothing depends on how files are read back.
    sorted_rows = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id())
    sorted_rows.write.partitionBy(PART).parquet(f"{path}/rows")
    kept = spark.read.schema(_with_part(df.schema)).parquet(f"{path}/rows")  # stated, as an empty table has no file to tell it
    counts = kept.groupBy(*within, PART).agg(F.count(F.lit(1)).alias(ROWS))
    # Without ``within`` this window holds a row for each part, MAX_PARTS at most.
    before = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(START, F.coalesce(F.sum(ROWS).over(before), F.lit(0)))
    (starts.sortWithinPartitions(*within, PART) if within else starts).write.parquet(f"{path}/directory")
    facts = json.dumps({"order": order, "descending": list(descending), "schema": df.schema.json()})
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.text(f"{path}/facts")
    return path


def parts_of(spark: SparkSession, path: str, offset: int, size: int, values: Mapping[str, Any] | None = None) -> list[tuple[int, int]]:
    """(part, rows before it) of the parts that hold the rows offset .. offset + size - 1."""
    where = (F.col(START) < offset + size) & (F.col(START) + F.col(ROWS) > offset)
    for c, v in (values or {}).items():
        where = where & F.col(c).eqNullSafe(F.lit(v))
    rows = spark.read.parquet(f"{path}/directory").where(where).select(PART, START).collect()  # size / ROWS_PER_PART + 2
    return sorted((r[PART], r[START]) for r in rows)


def page_at(spark: SparkSession, path: str, offset: int, size: int, values: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows offset .. offset + size - 1 of the stored order (of the rows with these
    ``within`` values, which must then be given for all ``within`` columns)."""
    found = parts_of(spark, path, offset, size, values) if size > 0 else []
    facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
    schema = _with_part(StructType.fromJson(json.loads(facts["schema"])))
    rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col(PART).isin([p for p, _ in found])).drop(PART)
    for c, v in (values or {}).items():
        rows = rows.where(F.col(c).eqNullSafe(F.lit(v)))
    keys = [F.col(c).desc_nulls_last() if c in facts["descending"] else F.col(c).asc_nulls_last() for c in facts["order"]]
    return rows.orderBy(*keys).offset(offset - found[0][1] if found else 0).limit(size)
