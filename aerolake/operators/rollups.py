"""Aggregations and summary tables (AGG1-8, SRT1).

Every grouping here is an ordinary ``groupBy`` so Spark aggregates partially on
the map side before the shuffle: a hot key (one carrier or airplane holding a
third of all flights) shrinks to one partial row per task before it is moved.
Per-key "documents" of the reference (flights of an airplane, airplanes of a
carrier) are kept flat, one row per member plus the group's size, instead of
being collected into one array per key: a hot key's array would have to fit in
one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

# Fixed value: word delimiters of the word-count job (blank, tab, newline,
# carriage return, form feed), as Java's StringTokenizer default.
WORD_DELIMITERS = r"[ \t\n\r\f]+"


def route_distance(flights: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean distance per (Origin, Dest) (AGG1), ordered by distance with ties
    broken by the key (SRT1)."""
    out = flights.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))
    return out.orderBy("Distance", "Origin", "Dest") if ordered else out


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """Count of (filtered) rows as a one-row frame (AGG2, AGG3)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def flights_by_month(flights: DataFrame) -> DataFrame:
    """Flights per (Year, Month), ordered by both (AGG4)."""
    return (flights.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("total_flights"))
            .orderBy("Year", "Month"))


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    """Airplanes per manufacturer (AGG5), largest first."""
    return (airplanes.groupBy("Manufacturer").agg(F.count(F.lit(1)).alias("total_airplanes"))
            .orderBy(F.desc("total_airplanes"), "Manufacturer"))


FLIGHT_FIELDS = ["FlightId", "FlightDate", "Carrier", "FlightNum", "Origin", "Dest", "DepTime", "ArrTime"]


def flights_per_airplane(flights: DataFrame, fields=FLIGHT_FIELDS) -> DataFrame:
    """Flights of every airplane (AGG6), flat: one row per flight with the
    airplane's flight count. The count is a partial+final aggregate joined back
    on TailNum; AQE splits a skewed TailNum partition of the big side."""
    counts = flights.groupBy("TailNum").agg(F.count(F.lit(1)).alias("n_flights"))
    return flights.select("TailNum", *fields).join(counts, "TailNum")


def airplanes_per_carrier(flights: DataFrame) -> DataFrame:
    """Distinct airplanes of every carrier (AGG7), flat: (Carrier, TailNum,
    n_airplanes). The distinct runs on the composite key, so a hot carrier is
    spread over many tasks; the per-carrier count is one row per carrier."""
    pairs = flights.select("Carrier", "TailNum").distinct()
    counts = pairs.groupBy("Carrier").agg(F.count(F.lit(1)).alias("n_airplanes"))
    return pairs.join(counts, "Carrier")


def carrier_summary(flights: DataFrame) -> DataFrame:
    """One summary row per carrier: airplanes and flights (the airline list)."""
    return flights.groupBy("Carrier").agg(
        F.count_distinct("TailNum").alias("n_airplanes"),
        F.count(F.lit(1)).alias("n_flights"))


def tokens(text_col, lower: bool = False) -> F.Column:
    """Whitespace tokens of a text column, empty tokens removed."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    if lower:
        c = F.lower(c)
    return F.filter(F.split(c, WORD_DELIMITERS), lambda t: t != "")


def python_tokens(text: str, lower: bool = False) -> list[str]:
    """The same tokenisation for a literal (query text given by the caller)."""
    t = text.lower() if lower else text
    return [w for w in re.split(WORD_DELIMITERS, t) if w]


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Word count over whole texts (AGG8): explode tokens, count per word.
    The partial aggregation plays the role of the combiner."""
    words = docs.select(F.explode(tokens(text_col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
