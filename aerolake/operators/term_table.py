"""Term table: full-text match without reading texts (FIL7).

``build`` writes, once for a table of texts,

    postings/bucket=b   (term, level, row, id, tf, dl), a bucket for each hash of the term
    levels/bucket=b     (term, level, n), the number of postings by term and level
    corpus              (n_rows, avgdl, buckets)

A posting's impact is its BM25 factor tf * (k1 + 1) / (tf + norm), between 0 and k1 + 1;
``level`` is the impact in steps of 1 / ``STEPS``. A text's words are counted within its
row, so that only the postings are moved, once. They are range-partitioned by
(bucket, term, level, row), so a term that stands in every text is spread over many
tasks and files, and a file's statistics tell which terms and levels it holds.

``matches`` scores all rows that hold a query word; it reads the buckets of the query's
words alone. ``top_k`` reads less: the levels say, before any posting is read, that the
k-th best score is at least ``floor`` (k rows have a word at some level or above). A
posting whose level keeps its row below ``floor`` even with the greatest impact of all
other words is not read, and words that can't lift a row to ``floor`` among themselves
only add to the rows that the other words found. The k rows are those of ``matches``.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolake.operators import relevance
from aerolake.operators.relevance import B, K1
from aerolake.operators.rollups import tokens

BUCKETS = 64
#: Levels of impact to a point.
STEPS = 32
#: Postings that one reduce task of the build sorts (some 50 MB, not spilled), and the most such tasks.
POSTINGS_PER_PART = 500_000
MAX_PARTS = 20_000


def bucket_of(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def _impact(tf: Column, dl: Column, avgdl: float) -> Column:
    return tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * dl / F.lit(avgdl)))


def _postings_schema(id_type: str) -> str:
    """Stated, as a table without words has no file to tell it."""
    return f"term string, level int, row long, id {id_type}, tf int, dl int, bucket int"


def _counted(words: DataFrame) -> DataFrame:
    """(row, id, dl, term, tf) of each row's distinct words: equal words stand together in the
    sorted array, and a word's count is the way to where the next one starts."""
    in_order = words.select("row", "id", F.size("words").alias("dl"), F.sort_array("words").alias("_words"))
    starts = F.expr("CASE WHEN dl > 0 THEN filter(sequence(0, dl - 1), i -> i = 0 OR get(_words, i) != get(_words, i - 1)) END")
    runs = F.expr("transform(_starts, (p, j) -> struct(get(_words, p) AS term, coalesce(get(_starts, j + 1), dl) - p AS tf))")
    return in_order.withColumn("_starts", starts).select("row", "id", "dl", F.inline(runs))


def build(df: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS) -> str:
    """Write the term table of ``df`` to ``path``. A null text counts as a row without words."""
    spark = df.sparkSession
    words = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), tokens(text_col, lower=True).alias("words"))
    stats = words.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.size("words")).alias("avgdl"),
                      F.sum(F.size(F.array_distinct("words"))).alias("postings")).first()
    kind = words.schema["id"].dataType.simpleString()
    spark.createDataFrame([(stats["n_rows"], stats["avgdl"] or 0.0, buckets, kind)], "n_rows long, avgdl double, buckets int, id_type string").write.parquet(f"{path}/corpus")
    counted = _counted(words)
    level = F.floor(_impact(F.col("tf").cast("double"), F.col("dl").cast("double"), stats["avgdl"] or 1.0) * STEPS).cast("int")
    postings = counted.select((F.crc32(F.col("term").cast("binary")) % buckets).cast("int").alias("bucket"), "term", level.alias("level"), "row", "id", "tf", "dl")
    keys = ["bucket", "term", "level", "row"]
    parts = int(min(MAX_PARTS, max(spark.sparkContext.defaultParallelism, (stats["postings"] or 0) // POSTINGS_PER_PART + 1)))
    postings.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.partitionBy("bucket").parquet(f"{path}/postings")
    stored = spark.read.schema(_postings_schema(kind)).parquet(f"{path}/postings")
    levels = stored.groupBy("bucket", "term", "level").agg(F.count(F.lit(1)).alias("n"))
    levels.repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/levels")
    return path


@dataclass
class Reading:
    """What a query reads: its words, their statistics, and the least level of each word."""

    terms: list[str]
    n_rows: int
    avgdl: float
    buckets: int
    id_type: str
    levels: dict[str, dict[int, int]]
    least: dict[str, int] = field(default_factory=dict)
    essential: list[str] = field(default_factory=list)
    floor: float = 0.0

    @property
    def df(self) -> list[int]:
        return [sum(self.levels[t].values()) for t in self.terms]

    def idf(self, term: str) -> float:
        n = sum(self.levels[term].values())
        return math.log(1.0 + (self.n_rows - n + 0.5) / (n + 0.5))

    def postings(self, kept: bool = True) -> int:
        """Postings of the query's words that are read (``kept=False``: that there are)."""
        return sum(n for t in self.terms for level, n in self.levels[t].items() if not kept or level >= self.least.get(t, 0))


def _reading(spark: SparkSession, path: str, query: str) -> Reading:
    corpus = spark.read.parquet(f"{path}/corpus").first()
    terms = relevance.query_terms(query)
    own = sorted({bucket_of(t, corpus["buckets"]) for t in terms})
    levels: dict[str, dict[int, int]] = {t: {} for t in terms}
    if terms:  # a word has as many rows as there are levels, some 70 at most
        for r in spark.read.schema("term string, level int, n long, bucket int").parquet(f"{path}/levels").where(F.col("bucket").isin(own) & F.col("term").isin(terms)).collect():
            levels[r["term"]][r["level"]] = r["n"]
    return Reading(terms, corpus["n_rows"], corpus["avgdl"], corpus["buckets"], corpus["id_type"], levels, essential=list(terms))


def plan_top_k(spark: SparkSession, path: str, query: str, k: int) -> Reading:
    """The levels and words that can still hold one of the k best rows."""
    reading = _reading(spark, path, query)
    held = [t for t in reading.terms if reading.levels[t]]
    most = {t: reading.idf(t) * (max(reading.levels[t]) + 1) / STEPS for t in held}
    for t in held:
        n = 0
        for level in sorted(reading.levels[t], reverse=True):
            n += reading.levels[t][level]
            if n >= k:  # k rows have the word at this level or above
                reading.floor = max(reading.floor, reading.idf(t) * level / STEPS)
                break
    below = reading.floor * (1 - 1e-9)
    for t in held:
        others = sum(most.values()) - most[t]
        reading.least[t] = min((x for x in reading.levels[t] if reading.idf(t) * (x + 1) / STEPS + others >= below), default=max(reading.levels[t]) + 1)
    lifted, extra = 0.0, []
    for t in sorted(held, key=most.get):
        lifted += most[t]
        if lifted >= below:
            break
        extra.append(t)
    reading.essential = [t for t in held if t not in extra]
    return reading


def _postings(spark: SparkSession, path: str, reading: Reading, terms: list[str]) -> DataFrame:
    rows = spark.read.schema(_postings_schema(reading.id_type)).parquet(f"{path}/postings")
    wanted = F.lit(False)
    for t in terms:
        own = F.col("term") == F.lit(t)
        wanted = wanted | ((own & (F.col("level") >= reading.least[t])) if reading.least.get(t) else own)
    return rows.where(F.col("bucket").isin(sorted({bucket_of(t, reading.buckets) for t in terms})) & wanted).select("row", "id", "dl", "term", "tf")


def _scored(spark: SparkSession, path: str, reading: Reading) -> DataFrame:
    """row, id, score of the rows that the essential words find."""
    if not reading.essential:
        return spark.createDataFrame([], f"row long, id {reading.id_type}, score double")
    rows = _postings(spark, path, reading, reading.essential)
    extra = [t for t in reading.terms if t not in reading.essential and reading.levels[t]]
    if extra:
        rows = rows.unionByName(_postings(spark, path, reading, extra).join(rows.select("row").distinct(), "row", "left_semi"))
    tfs = [F.coalesce(F.max(F.when(F.col("term") == F.lit(t), F.col("tf"))), F.lit(0)).cast("double").alias(f"tf{i}") for i, t in enumerate(reading.terms)]
    held = rows.groupBy("row", "id", "dl").agg(*tfs)
    stats = {"N": reading.n_rows, "avgdl": reading.avgdl, "df": reading.df}
    score = relevance.bm25_sum(F.col("dl").cast("double"), [F.col(f"tf{i}") for i in range(len(tfs))], stats)
    return held.select("row", "id", score.alias("score"))


def matches(spark: SparkSession, path: str, query: str, id_col: str = "id", digits: int | None = 6) -> DataFrame:
    """id and score of all rows that hold a word of the query."""
    found = _scored(spark, path, _reading(spark, path, query))
    return found.select(F.col("id").alias(id_col), (F.col("score") if digits is None else F.round("score", digits)).alias("score"))


def top_k(spark: SparkSession, path: str, query: str, k: int, id_col: str = "id", digits: int | None = 6) -> DataFrame:
    """The k best rows of ``matches``: greatest score, then smallest id."""
    found = _scored(spark, path, plan_top_k(spark, path, query, k))
    best = found.orderBy(F.col("score").desc(), F.col("id").asc_nulls_first(), "row").limit(k)
    return best.select(F.col("id").alias(id_col), (F.col("score") if digits is None else F.round("score", digits)).alias("score"))
