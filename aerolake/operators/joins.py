"""Joins the reference does key by key in application code (JOIN1-3, JOIN5).

Broadcast choices: a side is broadcast only when its size is bounded and
checked. ``broadcast_if_bounded`` counts at most ``max_rows + 1`` rows of a
side (cheap on a written table) and falls back to Spark's own plan (a
shuffled join) above the bound. Without it, AQE converts a join to a broadcast
join from the runtime size of the finished shuffle stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolake.functions.labels import STATUS_WAIT, status_column


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows, else leave it."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def enrich_distance(requests: DataFrame, distances: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Route distance for every request, on (Origin, Dest), kept when missing
    (JOIN1). Works for batch and for a stream joined to a static table."""
    right = distances.select("Origin", "Dest", F.col("Distance").alias("_route_distance"))
    if max_rows is not None:
        right = broadcast_if_bounded(right, max_rows)
    base = requests.drop("Distance") if "Distance" in requests.columns else requests
    return base.join(right, ["Origin", "Dest"], "left").withColumnRenamed("_route_distance", "Distance")


def airline_profile(airlines: DataFrame, carriers: DataFrame) -> DataFrame:
    """Airline summary next to its fleet summary; either side may be missing
    (JOIN2, full outer join on CarrierCode = Carrier). Both sides have one row
    per carrier."""
    j = airlines.join(carriers, airlines.CarrierCode == carriers.Carrier, "full_outer")
    return j.select(F.coalesce(airlines.CarrierCode, carriers.Carrier).alias("CarrierCode"),
                    airlines.Name, carriers.n_airplanes, carriers.n_flights)


def airline_airplanes(airlines: DataFrame, airplanes: DataFrame) -> DataFrame:
    """The airplanes of every airline with its name (JOIN2), flat: one row per
    (airline, airplane) plus the fleet size; an airline without airplanes keeps
    one row. Airlines are few, airplanes may be many of one airline: the join
    moves no airplane row when Spark broadcasts the airlines, and AQE splits a
    large airline otherwise."""
    j = airplanes.join(airlines, airlines.CarrierCode == airplanes.Carrier, "full_outer")
    return j.select(F.coalesce(airlines.CarrierCode, airplanes.Carrier).alias("CarrierCode"),
                    airlines.Name, airplanes.TailNum, airplanes.n_airplanes)


def first_reply(responses: DataFrame, key: str = "UUID", time_col: str = "rs_ts",
                value_col: str = "prediction") -> DataFrame:
    """The earliest reply per key (ties by value). A min over a struct is a
    partial+final aggregate: a key with many replies costs one row per task."""
    m = responses.groupBy(key).agg(F.min(F.struct(time_col, value_col)).alias("_r"))
    return m.select(key, F.col(f"_r.{time_col}").alias(time_col), F.col(f"_r.{value_col}").alias(value_col))


def request_status(requests: DataFrame, responses: DataFrame, key: str = "UUID") -> DataFrame:
    """Status of every request: OK with its prediction when a reply exists,
    else WAIT (JOIN3, SCA12)."""
    replies = first_reply(responses, key).select(key, "prediction", F.lit(True).alias("_hit"))
    j = requests.join(replies, key, "left")
    return j.withColumn("status", status_column(F.col("_hit").isNotNull(), STATUS_WAIT)).drop("_hit")


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """String category -> index by descending frequency, ties alphabetical,
    as ``StringIndexer(stringOrderType="frequencyDesc")`` orders its labels
    (JOIN5). All columns are counted in one aggregation over a stacked frame;
    the ranking is spread over all tasks (``ranking.ranked``), so even a
    column with a huge vocabulary is never gathered into one task.
    """
    from aerolake.operators.ranking import ranked
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("_kv")).select("_kv.column", "_kv.value").where(F.col("value").isNotNull())
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    out = ranked(counts, "column", [F.desc("n"), F.asc("value")])
    return out.withColumn("idx", F.col("idx").cast("double"))

