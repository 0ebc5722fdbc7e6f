"""Nested documents, one for each key, in pages of bounded size (AGG6, AGG7).

The reference keeps one record for each airplane with the array of its flights, and one
for each carrier with its airplanes. An array of unknown length would have to fit in
one task, so a document is written as pages of at most ``page_rows`` members each. The
members are counted by key first. A key with no more than a page of them is one page:
these rows are dealt by key, once, and gathered where they land. The rows of longer keys
are range-sorted by (key, order) over all tasks, so a key that holds a third of all rows
is spread over as many parts as it needs; a page is made of members of one part. Each
page and the directory, a row for each key, tell how many members the key has.

A missing key is a key of its own. Members that are equal in the order may take each
other's places. An empty table has no pages and no keys.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from aerolake.operators import pages
from aerolake.operators.joins import broadcast_if_bounded
from aerolake.operators.pages import PART, ROWS, START

#: Members of a page: an array of this many short records is well under a megabyte.
PAGE_ROWS = 1_000
#: Pages of one output file, and the most files of a table.
PAGES_PER_FILE = 250
MAX_FILES = 20_000
#: Keys of more than a page are told from the others by a broadcast up to this many.
LONG_KEYS_MAX = 500_000

MEMBERS = "n_members"


def build(df: DataFrame, key: str, order: list[str], path: str, members: str = "members", page_rows: int = PAGE_ROWS,
          rows_per_part: int = pages.ROWS_PER_PART) -> str:
    """Write the documents of ``df``: pages (``key``, page, first, ``members``, n_members)
    under ``path/pages``, sorted by key and page, and ``path/keys`` (``key``, n_members,
    n_pages). ``first`` is the place of a page's first member in its document; ``members`` is
    an array of all other columns, in the order given."""
    spark = df.sparkSession
    df.groupBy(key).agg(F.count(F.lit(1)).alias(ROWS)).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    long_keys = counts.where(F.col(ROWS) > page_rows)
    totals = {r["long"]: r["n"] for r in counts.groupBy((F.col(ROWS) > page_rows).alias("long")).agg(F.sum(ROWS).alias("n")).collect()}
    short, long = df, None
    if totals.get(True):
        own = broadcast_if_bounded(long_keys.select(F.col(key).alias("_long")), LONG_KEYS_MAX)
        same = F.col(key).eqNullSafe(F.col("_long"))
        short, long = df.join(own, same, "left_anti"), df.join(own, same, "left_semi")
    parts = int(max(1, min(MAX_FILES, -(-totals.get(False, 0) // rows_per_part))))
    _write(_one_page(short.repartitionByRange(parts, key), key, order, members).sortWithinPartitions(key), key, path)
    if long is not None:
        _write(_many_pages(long, key, order, path, members, page_rows, rows_per_part), key, path)
    made = spark.read.parquet(f"{path}/pages").groupBy(key).agg(F.first(MEMBERS).alias(MEMBERS), F.count(F.lit(1)).alias("n_pages"))
    made.sortWithinPartitions(key).write.parquet(f"{path}/keys")
    return path


def _write(made: DataFrame, key: str, path: str) -> None:
    made.write.mode("append").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{path}/pages")


def _one_page(df: DataFrame, key: str, order: list[str], members: str) -> DataFrame:
    """Documents of one page, of rows dealt by key: the grouping moves no row again."""
    fields = [c for c in df.columns if c != key]
    first = [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"_null{i}"), F.col(c))]  # missing values last
    gathered = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*first, *[c for c in fields if c not in order]))).alias("_rows"))
    plain = F.transform("_rows", lambda m: F.struct(*[m[c].alias(c) for c in fields]))
    return gathered.select(key, F.lit(0).cast("long").alias("page"), F.lit(0).cast("long").alias("first"), plain.alias(members),
                           F.size("_rows").cast("long").alias(MEMBERS))


def _many_pages(df: DataFrame, key: str, order: list[str], path: str, members: str, page_rows: int, rows_per_part: int) -> DataFrame:
    """Documents of any length, sorted by key and page."""
    spark = df.sparkSession
    pages.build(df, order, f"{path}/sorted", within=[key], rows_per_part=rows_per_part)
    counted = spark.read.parquet(f"{path}/sorted/directory")
    n_pages = F.ceil(F.col(ROWS) / page_rows)
    # A key has a directory row in each part that holds it, at most pages.MAX_PARTS.
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = counted.withColumns({"_page": F.coalesce(F.sum(n_pages).over(before), F.lit(0)), MEMBERS: F.sum(ROWS).over(Window.partitionBy(key))})
    # Plain join columns: the join, the window and the grouping then share one shuffle.
    named = {"_none": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit(""))}
    own = [PART, "_none", "_key"]
    rows = spark.read.schema(pages._with_part(df.schema)).parquet(f"{path}/sorted/rows").withColumns(named)
    sort = [F.col(c).asc_nulls_last() for c in order]
    placed = rows.join(parts.withColumns(named).select(*own, START, "_page", MEMBERS), own).withColumn(
        "_pos", F.row_number().over(Window.partitionBy(*own).orderBy(*sort)) - 1)
    fields = F.struct("_pos", *[c for c in df.columns if c != key])
    made = (placed.withColumn("_in", F.floor(F.col("_pos") / page_rows))
            .groupBy(*own, "_in").agg(
                F.first(key).alias(key), (F.min(START) + F.min("_pos")).cast("long").alias("first"),
                (F.min("_page") + F.col("_in")).cast("long").alias("page"), F.sort_array(F.collect_list(fields)).alias("_rows"), F.min(MEMBERS).alias(MEMBERS)))
    made = made.select(key, "page", "first", F.transform("_rows", lambda m: m.dropFields("_pos")).alias(members), MEMBERS)
    total = counted.agg(F.sum(n_pages)).first()[0] or 0
    files = int(max(1, min(MAX_FILES, -(-total // PAGES_PER_FILE))))
    return made.repartitionByRange(files, key, "page").sortWithinPartitions(key, "page")


def document(spark: SparkSession, path: str, key: str, value: Any, page: int | None = None) -> DataFrame:
    """The pages of one document in order (or one page of it). The filters reach the scan,
    and pages lie sorted by key: few row groups are read."""
    found = spark.read.parquet(f"{path}/pages").where(F.col(key).eqNullSafe(F.lit(value)))
    if page is not None:
        found = found.where(F.col("page") == page)
    return found.orderBy("page")


def directory(spark: SparkSession, path: str) -> DataFrame:
    """(key, n_members, n_pages) of every document."""
    return spark.read.parquet(f"{path}/keys")


def exploded(made: DataFrame, key: str, members: str = "members", total: str | None = None) -> DataFrame:
    """One row for each member, with its place in its document; with the number of the
    document's members in a last column ``total``, if that is named."""
    more = [F.col(MEMBERS).alias(total)] if total else []
    rows = made.select(key, "first", F.posexplode(members).alias("_at", "_member"), *more)
    return rows.select(key, (F.col("first") + F.col("_at")).alias("place"), "_member.*", *([total] if total else []))
