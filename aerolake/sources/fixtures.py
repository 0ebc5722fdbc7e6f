"""Fixture views that map the driver's tables onto the reference's data model.

Each view is the DataFrame form of the SQL in FIXTURES.md part B; the oracle
module holds the same SQL for DuckDB. ``nation`` (25 rows at every scale) is
broadcast after a checked row count (``broadcast_if_bounded``); every other
join is left to Spark's size checks and AQE, which pick broadcast or
sort-merge from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake.operators.joins import broadcast_if_bounded
from aerolake.session import spread
from aerolake.sources.tables import read_table

# A dimension above this many rows is joined by shuffle instead of broadcast.
NATION_MAX_ROWS = 10_000
#: Two short columns of a supplier: some 50 MB as a broadcast table.
SUPPLIER_MAX_ROWS = 500_000


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broadcast_if_bounded(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
                                NATION_MAX_ROWS)


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight history (A4): one row per line item."""
    return flight_fields(flight_rows(spark, sf_dir))


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows that flights are derived from, half as wide as the flights.

    Join order matters at scale: the dimensions are narrowed first (customer
    and supplier get their nation names; orders gets carrier and destination
    from its customer), so the line-item stream is shuffled once per key it
    joins on (order, part, and supplier above ``SUPPLIER_MAX_ROWS``) and never
    for the customer key.
    """
    t = lambda n: read_table(spark, sf_dir, n)
    nation = _nation(spark, sf_dir)
    cust = (t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Dest")),
                  "c_nationkey"))
    ords = (t("orders").select("o_orderkey", "o_custkey")
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", F.col("c_mktsegment").alias("Carrier"), "Dest"))
    sup = (t("supplier").select("s_suppkey", "s_nationkey")
           .join(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("Origin")),
                 "s_nationkey")
           .select("s_suppkey", "Origin"))
    p = t("part").select("p_partkey", "p_retailprice")
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    sup = broadcast_if_bounded(sup, SUPPLIER_MAX_ROWS)
    j = (li.join(ords, li.l_orderkey == ords.o_orderkey)
         .join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(sup, F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select(*li.columns, "p_retailprice", "Carrier", "Origin", "Dest")


#: What ``flight_rows`` are dealt by: the time of flight, then keys that part a day's rows.
FLIGHT_DEAL = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def flight_fields(j: DataFrame) -> DataFrame:
    """The flight of each of ``flight_rows``."""
    ship = F.col("l_shipdate").cast("date")
    flight_id = F.md5(F.concat_ws(
        "|", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
        _s(F.col("l_quantity").cast("int")), _s(ship)))
    return j.select(
        flight_id.alias("FlightId"),
        "Carrier", "Origin", "Dest",
        F.concat(F.lit("N"), _s("l_partkey")).alias("TailNum"),
        _s("l_suppkey").alias("FlightNum"),
        ship.alias("FlightDate"),
        F.year("l_shipdate").cast("int").alias("Year"),
        F.month("l_shipdate").cast("int").alias("Month"),
        F.when(F.col("l_linenumber") != 7, F.lpad(_s((F.col("l_partkey") * 7) % 2400), 4, "0")).alias("DepTime"),
        F.lpad(_s((F.col("l_partkey") * 7 + F.col("l_linenumber") * 100) % 2400), 4, "0").alias("ArrTime"),
        (F.col("l_quantity") - 25).alias("DepDelay"),
        (F.col("l_quantity") - 25 + F.col("l_linenumber") * 4 - 12).cast("double").alias("ArrDelay"),
        F.floor("p_retailprice").cast("double").alias("Distance"),
    )


def airplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airplane registry: one row per part."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("N"), _s("p_partkey")).alias("TailNum"),
        F.col("p_name").alias("Owner"),
        F.concat(F.lit("S"), _s(F.col("p_size") % 7)).alias("OwnerState"),
        F.col("p_brand").alias("Manufacturer"),
        F.col("p_type").alias("Model"),
        _s(F.lit(1950) + F.col("p_size")).alias("ManufacturerYear"),
        _s(F.col("p_partkey") * 7919).alias("SerialNumber"),
        F.concat(F.lit("E"), F.col("p_brand")).alias("EngineManufacturer"),
        F.concat(F.col("p_type"), F.lit("-"), _s(F.col("p_size") % 5)).alias("EngineModel"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline summaries: one row per carrier code."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("CarrierCode")).distinct()
    return c.select("CarrierCode", F.concat(F.col("CarrierCode"), F.lit(" AIR")).alias("Name"))


# Fixed values of the fixture: the carrier code a request gets from event_id % 6
# (index 5 is a carrier never seen in the flight history).
REQUEST_CARRIERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "ZZ"]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests as sent on the request topic: (event_id, ts, event_type,
    value JSON text). ``error`` events carry truncated JSON; destination
    ``XXX`` has no route distance; carrier ``ZZ`` is unseen."""
    ev = spread(read_table(spark, sf_dir, "events"))
    nation = _nation(spark, sf_dir)
    no = nation.select(F.col("n_nationkey").alias("_o_key"), F.col("n_name").alias("_o_name"))
    nd = nation.select(F.col("n_nationkey").alias("_d_key"), F.col("n_name").alias("_d_name"))
    j = (ev.join(no, (F.col("user_id") % 25) == F.col("_o_key"), "left")
           .join(nd, (F.col("event_id") % 26) == F.col("_d_key"), "left"))
    carrier = F.element_at(F.array(*[F.lit(x) for x in REQUEST_CARRIERS]),
                           (F.col("event_id") % 6 + 1).cast("int"))
    delay = _s(F.floor("value").cast("int") % 50 - 24)
    value = F.concat(
        F.lit('{"Origin":"'), F.coalesce("_o_name", F.lit("XXX")),
        F.lit('","Dest":"'), F.coalesce("_d_name", F.lit("XXX")),
        F.lit('","Carrier":"'), carrier,
        F.lit('","FlightNum":"'), _s("user_id"),
        F.lit('","FlightDate":"'), _s(F.col("ts").cast("date")),
        F.lit('","DepDelay":'), delay, F.lit(".0"),
        F.lit(',"UUID":"'), F.md5(_s("event_id")), F.lit('"'),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}")),
    )
    return j.select("event_id", "ts", "event_type", value.alias("value"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies on the response topic: (UUID, rs_ts, prediction). Every 10th
    request has no reply, every 7th a late one (30 s); the others are answered
    after 2 s. Of those, event_id % 11 = 0 get a second reply after 3 s,
    event_id % 13 = 0 another one after 15 s, and event_id % 17 = 0 a stale one
    dated 3 s before the request."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts").where(F.col("event_id") % 10 != 0)
    e = F.col("event_id")
    uuid = F.md5(_s("event_id")).alias("UUID")

    def reply(rows: DataFrame, after, shift: int) -> DataFrame:
        return rows.select(uuid, after.alias("rs_ts"), ((e + shift) % 4).cast("double").alias("prediction"))

    def later(seconds: int):
        return F.col("ts") + F.expr(f"INTERVAL {seconds} SECONDS")

    prompt = ev.where(e % 7 != 0)
    return (reply(ev, F.when(e % 7 == 0, later(30)).otherwise(later(2)), 0)
            .unionByName(reply(prompt.where(e % 11 == 0), later(3), 0))
            .unionByName(reply(prompt.where(e % 13 == 0), later(15), 1))
            .unionByName(reply(prompt.where(e % 17 == 0), later(-3), 2)))
