"""The request path as DataFrame functions (SCA2-9, PRJ1-4, SNK3, SNK7-8, FIL8).

raw request text -> parse -> (valid rows) -> enrich with distance and date
parts -> message / task -> score -> response message. Every step is a
per-row projection or a join with the (small, bounded) route table, so the
same functions run on a batch table and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aerolake import schemas
from aerolake.functions import coerce, dates, messages
from aerolake.functions.labels import delay_class
from aerolake.operators.joins import enrich_distance
from aerolake.operators.search import day_range_text

# Fields a client sends (the form fields of a prediction request).
FORM_FIELDS = ["DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin"]
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss"


def parse_requests(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Request text -> typed fields (SCA2), permissive: a malformed message
    gives nulls and a non-null ``_corrupt_record``."""
    keep = [c for c in (keep if keep is not None else raw.columns) if c != value_col]
    # Exploding a one-element array keeps a later filter on the result above the
    # parse: without it the optimizer parses once to filter and again to project.
    return raw.select(*keep, F.explode(F.array(messages.parse_request(value_col))).alias("flight"))


def valid_only(parsed: DataFrame) -> DataFrame:
    """Rows whose message parsed fully (no corrupt record)."""
    return parsed.where(F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNull())


def flatten(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Struct -> columns (PRJ1): the fields the scoring job keeps."""
    keep = [c for c in (keep or []) if c in parsed.columns]
    return parsed.select(*keep, *[F.col(f"flight.{f}").alias(f) for f in schemas.FLATTENED_FIELDS])


def with_route(df: DataFrame) -> DataFrame:
    """Route = Origin-Dest; null when either is null (PRJ2, SCA4)."""
    return df.withColumn("Route", F.concat(F.col("Origin"), F.lit("-"), F.col("Dest")))


def with_date_parts(df: DataFrame, date_col: str = "FlightDate") -> DataFrame:
    """DayOfYear, DayOfMonth, DayOfWeek of a date (SCA6)."""
    for name, col in dates.date_parts(date_col).items():
        df = df.withColumn(name, col)
    return df


def coerce_fields(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Form-style text fields -> typed values, null on failure (SCA5). The
    float route reads DepDelay as float, the regression route as int."""
    keep = [c for c in (keep or []) if c in raw.columns]
    # One parse per message into text fields; a malformed message gives nulls.
    fields = F.from_json(F.col(value_col), "map<string,string>")
    txt = lambda f: fields.getItem(f)
    return raw.select(
        *keep,
        coerce.try_double(txt("DepDelay")).alias("DepDelay"),
        coerce.try_int(txt("DepDelay")).alias("DepDelay_int"),
        coerce.try_text(txt("Carrier")).alias("Carrier"),
        coerce.try_text(txt("FlightDate")).alias("FlightDate"),
        coerce.try_text(txt("Dest")).alias("Dest"),
        coerce.try_text(txt("FlightNum")).alias("FlightNum"),
        coerce.try_int(txt("FlightNum")).alias("FlightNum_int"),
        coerce.try_text(txt("Origin")).alias("Origin"),
    )


def enrich(valid: DataFrame, distances: DataFrame, ts: Column | None = None,
           uuid: Column | None = None, distance_max_rows: int | None = None) -> DataFrame:
    """What the request handler adds before publishing: route distance
    (JOIN1), date parts (SCA6), a time stamp (SCA7) and an id (SCA8).
    ``ts``/``uuid`` default to ``current_timestamp()`` / ``uuid()``; callers
    inject columns for deterministic output."""
    base = valid.select(*[F.col(f"flight.{f}").alias(f) for f in FORM_FIELDS + ["UUID"]],
                        *[c for c in valid.columns if c != "flight"])
    out = enrich_distance(base, distances, max_rows=distance_max_rows)
    out = with_date_parts(out)
    out = out.withColumn("Timestamp", ts if ts is not None else F.current_timestamp())
    out = out.withColumn("UUID", uuid if uuid is not None else F.coalesce(F.col("UUID"), F.expr("uuid()")))
    return out


REQUEST_MESSAGE_FIELDS = ["DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin", "Distance",
                          "DayOfYear", "DayOfMonth", "DayOfWeek", "Timestamp", "UUID"]


def request_messages(enriched: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Publishable request records (SNK8): key = UUID, value = JSON of the
    features (plus ``keep`` columns). Write them with ``.write.format(...)``."""
    return enriched.select(F.col("UUID").alias("key"),
                           messages.to_message(*REQUEST_MESSAGE_FIELDS).alias("value"), *(keep or []))


def make_tasks(enriched: DataFrame) -> DataFrame:
    """Scoring tasks (SNK7 rows): the features without id, time stamp as text."""
    return enriched.select(
        "DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin", "Distance",
        "DayOfYear", "DayOfMonth", "DayOfWeek",
        F.date_format("Timestamp", TIMESTAMP_TEXT).alias("Timestamp"))


def rule_results(tasks: DataFrame) -> DataFrame:
    """Stand-in results that need no model: prediction = delay class of
    DepDelay. Used to check the result readers against SQL."""
    return tasks.withColumn("prediction", delay_class("DepDelay"))


RESULT_DAY_COLUMN = "Day"


def store_results(results: DataFrame, path: str, ts_col: str = "Timestamp") -> str:
    """Append batch results to the result table (ML5), a folder for each day of
    their time stamp, so that a day's results are read without the others."""
    day = dates.iso_day(F.col(ts_col).cast("string"))
    results.withColumn(RESULT_DAY_COLUMN, day).write.mode("append").partitionBy(RESULT_DAY_COLUMN).parquet(path)
    return path


def results_for_day(results: DataFrame, iso_date: str, ts_col: str = "Timestamp") -> DataFrame:
    """Results of one day (FIL5, SCA9). A text time stamp is compared as text
    between the day and the next day, as stored results are; a TIMESTAMP
    column gets the half-open range [day, day + 1). The stored result table is
    pruned to the folders of these two days."""
    d = F.lit(iso_date)
    if RESULT_DAY_COLUMN in results.columns:
        results = results.where(F.col(RESULT_DAY_COLUMN).between(dates.iso_day(d), dates.day_after(d))).drop(RESULT_DAY_COLUMN)
    kind = results.schema[ts_col].dataType.simpleString()
    if kind.startswith("timestamp"):
        start = dates.iso_day(d).cast(kind)
        end = dates.day_after(d).cast(kind)
        return results.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))
    return day_range_text(results, ts_col, dates.iso_day(d), dates.day_after(d))


def response_messages(scored: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Response records (SNK3, PRJ4, SCA3): key = UUID, value = JSON of the
    result fields (null fields left out), plus ``keep`` columns."""
    return scored.select(F.col("UUID").alias("key"),
                         messages.to_message(*schemas.RESPONSE_FIELDS).alias("value"), *(keep or []))


def parse_responses(msgs: DataFrame, value_col: str = "value") -> DataFrame:
    """Response text -> typed columns."""
    keep = [c for c in msgs.columns if c != value_col]
    return msgs.select(*keep, F.from_json(F.col(value_col), schemas.RESPONSE).alias("r")).select(*keep, "r.*")


def response_lookup(msgs: DataFrame, uuid: str, value_col: str = "value", order: list[str] | None = None) -> DataFrame:
    """The first message whose JSON value is an object with this UUID (FIL8): first in
    ``order`` (a topic's position or time columns) for a batch; a stream, read in the
    topic's order, gives none."""
    found = msgs.where(F.get_json_object(F.col(value_col), "$.UUID") == F.lit(uuid))
    return (found.orderBy(*order) if order else found).limit(1)
