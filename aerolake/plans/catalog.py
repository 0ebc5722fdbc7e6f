"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables in full (through the fixture views, or
tables Spark derives from them and stores per input fingerprint) and exercises
one operator of SURVEY section 2. Parameters (lookup keys, search
criteria, page bounds) are fixed values that exist in the driver's data; the
SQL oracle in ``oracle.py`` uses the same ones.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake import schemas
from aerolake.functions.labels import delay_class, prediction_label
from aerolake.operators import documents, incremental, joins, ml, pages, relevance, rollups, search, sparse_regression, term_table
from aerolake.operators import requests as rq
from aerolake.plans.context import AIRPLANE_SUMMARIES, FLIGHT_SUMMARIES, ROUTE_MAX_ROWS, Tables
from aerolake.session import shared_path, spread
from aerolake.sources.tables import append_table, read_jsonl, register_views, write_jsonl
from aerolake.streaming import results
from aerolake.streaming.topics import as_text, publish, topic_records

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# Fixed parameters of the registered queries (values present in the driver data).
LOOKUP = {"Carrier": "HOUSEHOLD", "FlightDate": dt.date(1995, 1, 2), "FlightNum": "45"}
ROUTE_DAY = {"Origin": "NATION_11", "Dest": "NATION_13", "FlightDate": dt.date(1995, 2, 16)}
TAIL_NUMBER = "N1"
FLIGHT_SEARCH = {"Carrier": "BUILDING", "FlightDate": None, "Origin": "NATION_3", "Dest": "",
                 "TailNum": None, "FlightNum": None}
FLIGHT_SORT = ["FlightDate", "DepTime", "Carrier", "FlightNum"]
FLIGHT_PAGE = (20, 20)
AIRPLANE_FIELDS = ["TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
                   "SerialNumber", "EngineManufacturer", "EngineModel"]
AIRPLANE_SEARCH = {"Owner": "red plate", "OwnerState": "S3"}
AIRPLANE_TEXT_FIELDS = ["Owner"]
AIRPLANE_PAGE = (10, 20)
#: Every text field of an airplane can be matched by its words; the others by their whole value.
AIRPLANE_TEXT_FIELDS_ALL = ["Owner", "Manufacturer", "Model", "EngineManufacturer", "EngineModel"]
AIRPLANE_TEXT_SEARCH = {"Model": "economy copper", "Owner": "plate red", "OwnerState": "S3"}
FLIGHT_TEXT_FIELDS = ["Carrier", "Origin", "Dest", "TailNum", "FlightNum"]
FLIGHT_TEXT_SEARCH = {"Carrier": "building machinery", "Origin": "nation_3"}
OWNER_QUERY = "red plate"
DOCUMENT_QUERY = "the river of"
KEYSET_SORT = ["FlightDate", "DepTime", "Carrier", "FlightNum", "FlightId"]
#: The second page starts inside the flights without a departure time.
KEYSET_AFTER_NULL = {"FlightDate": dt.date(1995, 6, 1), "DepTime": None, "Carrier": "BUILDING",
                     "FlightNum": "50", "FlightId": "8"}
KEYSET_AFTER = {"FlightDate": dt.date(1995, 6, 1), "DepTime": "1200", "Carrier": "BUILDING",
                "FlightNum": "50", "FlightId": "8"}
KEYSET_SIZE = 50
TOP_K = 100
#: Sorted pages by offset: this many rows, and (of one carrier) from this row on.
PAGE_AT_SIZE = 50
PAGE_CARRIER = "BUILDING"
CARRIER_PAGE_AT = 500
RESULT_DAY = "2024-01-15"
LOOKUP_UUID_EVENT = 123
CATEGORY_COLUMNS = ["Carrier", "Origin", "Dest", "Route"]
TS_TEXT = rq.TIMESTAMP_TEXT


def _ts_text(df: DataFrame, col: str = "Timestamp") -> DataFrame:
    return df.withColumn(col, F.date_format(col, TS_TEXT))


# --- Rollups (AGG*, SRT1) -------------------------------------------------

@register("route_distance")
def q_route_distance(spark, sf):
    return rollups.route_distance(Tables(spark, sf).flights)


@register("jsonl_roundtrip")
def q_jsonl_roundtrip(spark, sf):
    path = shared_path(spark, "route_distance_jsonl", unique=True)
    write_jsonl(rollups.route_distance(Tables(spark, sf).flights), path)
    return read_jsonl(spark, path, schemas.ROUTE_DISTANCE)


@register("flights_by_month")
def q_flights_by_month(spark, sf):
    return rollups.flights_by_month(Tables(spark, sf).flights)


@register("flights_by_month_json")
def q_flights_by_month_json(spark, sf):
    m = rollups.flights_by_month(Tables(spark, sf).flights)
    return m.select(F.to_json(F.struct("Year", "Month", "total_flights")).alias("json"))


@register("manufacturer_totals")
def q_manufacturer_totals(spark, sf):
    return rollups.manufacturer_totals(Tables(spark, sf).airplanes)


@register("flights_per_airplane")
def q_flights_per_airplane(spark, sf):
    return rollups.flights_per_airplane(Tables(spark, sf).flights)


@register("airplane_documents")
def q_airplane_documents(spark, sf):
    """Every airplane's document of flights (AGG6), its pages opened again for the comparison."""
    path = Tables(spark, sf).airplane_documents()
    return documents.exploded(spark.read.parquet(f"{path}/pages"), "TailNum", "flights", "n_flights").where(F.col("TailNum").isNotNull())


@register("airplane_document")
def q_airplane_document(spark, sf):
    """One airplane's document (AGG6, FIL6)."""
    return documents.exploded(documents.document(spark, Tables(spark, sf).airplane_documents(), "TailNum", TAIL_NUMBER), "TailNum", "flights")


@register("carrier_documents")
def q_carrier_documents(spark, sf):
    """Every carrier's document of airplanes (AGG7), opened again."""
    path = Tables(spark, sf).carrier_documents()
    return documents.exploded(spark.read.parquet(f"{path}/pages"), "Carrier", "airplanes", "n_airplanes").where(F.col("Carrier").isNotNull())


@register("route_distance_refreshed")
def q_route_distance_refreshed(spark, sf):
    """Mean distances after three appends (AGG1)."""
    return incremental.result(spark, Tables(spark, sf).refreshed_summaries(), "routes", FLIGHT_SUMMARIES["routes"])


@register("flights_by_month_refreshed")
def q_flights_by_month_refreshed(spark, sf):
    return incremental.result(spark, Tables(spark, sf).refreshed_summaries(), "months", FLIGHT_SUMMARIES["months"])


@register("airplanes_per_carrier_refreshed")
def q_airplanes_per_carrier_refreshed(spark, sf):
    return incremental.result(spark, Tables(spark, sf).refreshed_summaries(), "carrier_airplanes", FLIGHT_SUMMARIES["carrier_airplanes"])


@register("manufacturer_totals_refreshed")
def q_manufacturer_totals_refreshed(spark, sf):
    return incremental.result(spark, Tables(spark, sf).refreshed_airplanes(), "manufacturers", AIRPLANE_SUMMARIES["manufacturers"])


@register("airplanes_per_carrier")
def q_airplanes_per_carrier(spark, sf):
    return rollups.airplanes_per_carrier(Tables(spark, sf).flights)


@register("all_airlines")
def q_all_airlines(spark, sf):
    """The stored airline list (SRC6)."""
    return Tables(spark, sf).carriers


@register("airline_profile")
def q_airline_profile(spark, sf):
    t = Tables(spark, sf)
    return joins.airline_profile(t.airlines, t.carriers)


@register("airline_airplanes")
def q_airline_airplanes(spark, sf):
    t = Tables(spark, sf)
    return joins.airline_airplanes(t.airlines, t.carrier_airplanes)


@register("month_counts_stored")
def q_month_counts_stored(spark, sf):
    """The stored month table, read as the month page does."""
    return Tables(spark, sf).months


@register("manufacturer_totals_stored")
def q_manufacturer_totals_stored(spark, sf):
    return Tables(spark, sf).manufacturers


@register("views_sql")
def q_views_sql(spark, sf):
    """Plain SQL over registered tables (SRC2): ordered quantity and parts by ship year."""
    register_views(spark, sf, ["lineitem"])
    return spark.sql("SELECT year(l_shipdate) AS ship_year, count(*) AS n_items, count(DISTINCT l_partkey) AS n_parts "
                     "FROM lineitem GROUP BY year(l_shipdate)")


@register("word_count")
def q_word_count(spark, sf):
    return rollups.word_count(spread(Tables(spark, sf).table("documents").select("text")))


# --- Lookups, search, paging (FIL*, SRT2-4, LIM*) -------------------------

@register("flight_lookup")
def q_flight_lookup(spark, sf):
    return search.lookup_first(Tables(spark, sf).flights, LOOKUP, tie=["FlightId"])


@register("flight_lookup_many")
def q_flight_lookup_many(spark, sf):
    """FIL1 for every key at once: the first flight of each
    (Carrier, FlightDate, FlightNum) present in the history."""
    fl = Tables(spark, sf).flights
    keys = ["Carrier", "FlightDate", "FlightNum"]
    return search.lookup_many(fl, None, keys, tie=["FlightId"])


@register("list_flights")
def q_list_flights(spark, sf):
    return search.list_matches(Tables(spark, sf).flights, ROUTE_DAY, order=["DepTime", "ArrTime", "FlightId"])


@register("list_flights_count")
def q_list_flights_count(spark, sf):
    return rollups.count_rows(Tables(spark, sf).flights.where(search.criteria_predicate(ROUTE_DAY)), "flight_count")


@register("flights_of_airplane")
def q_flights_of_airplane(spark, sf):
    fl = Tables(spark, sf).flights
    return search.list_matches(fl, {"TailNum": TAIL_NUMBER}, order=["FlightDate", "FlightId"])


@register("search_flights")
def q_search_flights(spark, sf):
    start, size = FLIGHT_PAGE
    return search.search(Tables(spark, sf).flights, FLIGHT_SEARCH, FLIGHT_SORT, tie=["FlightId"],
                         start=start, size=size)


@register("search_flights_count")
def q_search_flights_count(spark, sf):
    return search.search_count(Tables(spark, sf).flights, FLIGHT_SEARCH)


@register("search_airplanes")
def q_search_airplanes(spark, sf):
    start, size = AIRPLANE_PAGE
    return search.search(Tables(spark, sf).airplanes, AIRPLANE_SEARCH, ["Owner"], tie=["TailNum"],
                         start=start, size=size, text_fields=AIRPLANE_TEXT_FIELDS)


@register("search_airplanes_count")
def q_search_airplanes_count(spark, sf):
    return search.search_count(Tables(spark, sf).airplanes, AIRPLANE_SEARCH, AIRPLANE_TEXT_FIELDS)


@register("search_airplanes_text")
def q_search_airplanes_text(spark, sf):
    """Text match on several fields at once, in any case (FIL4)."""
    return search.search(Tables(spark, sf).airplanes, AIRPLANE_TEXT_SEARCH, [], tie=["TailNum"],
                         start=0, size=50, text_fields=AIRPLANE_TEXT_FIELDS_ALL)


@register("search_flights_text")
def q_search_flights_text(spark, sf):
    """Flights by text match, so that the score orders them (SRT3)."""
    return search.search(Tables(spark, sf).flights, FLIGHT_TEXT_SEARCH, ["FlightDate"], tie=["FlightId"],
                         start=0, size=50, text_fields=FLIGHT_TEXT_FIELDS)


@register("match_relevance")
def q_match_relevance(spark, sf):
    return relevance.match_relevance(Tables(spark, sf).airplanes, "Owner", OWNER_QUERY, id_cols=["TailNum"])


@register("match_relevance_documents")
def q_match_relevance_documents(spark, sf):
    docs = spread(Tables(spark, sf).table("documents").select("doc_id", "text"))
    return relevance.scored(docs, "text", DOCUMENT_QUERY).drop("text")


@register("match_top_k")
def q_match_top_k(spark, sf):
    """The best documents of a text search, from the term table alone (FIL7)."""
    return term_table.top_k(spark, Tables(spark, sf).document_terms(), DOCUMENT_QUERY, TOP_K, id_col="doc_id")


@register("match_terms_documents")
def q_match_terms_documents(spark, sf):
    """All documents of a text search, from the term table alone (FIL7)."""
    return term_table.matches(spark, Tables(spark, sf).document_terms(), DOCUMENT_QUERY, id_col="doc_id")


@register("flights_page_at")
def q_flights_page_at(spark, sf):
    """A page by its offset, half-way through the sorted flights (LIM1, SRT3)."""
    t = Tables(spark, sf)
    return pages.page_at(spark, t.flight_pages(), t.flights.count() // 2, PAGE_AT_SIZE)


@register("search_page_at")
def q_search_page_at(spark, sf):
    """A page by its offset among one carrier's flights, sorted (FIL3, LIM1)."""
    return pages.page_at(spark, Tables(spark, sf).carrier_pages(), CARRIER_PAGE_AT, PAGE_AT_SIZE, {"Carrier": PAGE_CARRIER})


@register("flights_page_keyset")
def q_flights_page_keyset(spark, sf):
    return search.keyset_page(Tables(spark, sf).flights, KEYSET_SORT, KEYSET_AFTER, KEYSET_SIZE)


@register("flights_page_keyset_null")
def q_flights_page_keyset_null(spark, sf):
    return search.keyset_page(Tables(spark, sf).flights, KEYSET_SORT, KEYSET_AFTER_NULL, KEYSET_SIZE)


@register("delay_bucket")
def q_delay_bucket(spark, sf):
    fl = Tables(spark, sf).flights
    return fl.select("FlightId", "ArrDelay", delay_class("ArrDelay").alias("ArrDelayBucket"))


@register("category_index")
def q_category_index(spark, sf):
    fl = rq.with_route(Tables(spark, sf).flights)
    return joins.category_index(fl, CATEGORY_COLUMNS)


# --- Request path (SCA*, PRJ*, JOIN1/3, SNK3/7/8, FIL5/8) -----------------

@register("request_parse")
def q_request_parse(spark, sf):
    p = Tables(spark, sf).parsed
    return p.select("event_id", *[F.col(f"flight.{f}").alias(f) for f in
                                  ["Origin", "Dest", "Carrier", "FlightNum", "FlightDate", "DepDelay", "UUID"]],
                    F.col(f"flight.{schemas.CORRUPT_COLUMN}").isNull().alias("is_valid"))


@register("coerce_fields")
def q_coerce_fields(spark, sf):
    return rq.coerce_fields(Tables(spark, sf).requests, keep=["event_id"])


@register("date_features")
def q_date_features(spark, sf):
    v = Tables(spark, sf).valid
    d = v.select("event_id", F.col("flight.FlightDate").alias("FlightDate"))
    return rq.with_date_parts(d)


@register("enrich_distance")
def q_enrich_distance(spark, sf):
    t = Tables(spark, sf)
    base = t.valid.select("event_id", "flight.Origin", "flight.Dest")
    return joins.enrich_distance(base, t.distances, max_rows=ROUTE_MAX_ROWS)


def _request_messages(t: Tables) -> DataFrame:
    return rq.request_messages(t.enriched)


def _through_topic(spark: SparkSession, messages: DataFrame, name: str) -> DataFrame:
    """Publish messages (key, value) to a topic and read it back as text."""
    path = shared_path(spark, "topics", name, unique=True)
    publish(topic_records(messages, "key", "value"), "parquet", path)
    return as_text(spark.read.schema(schemas.TOPIC).parquet(path)).select("key", "value")


@register("make_requests")
def q_make_requests(spark, sf):
    msgs = _through_topic(spark, _request_messages(Tables(spark, sf)), "requests")
    parsed = msgs.select("key", F.from_json("value", schemas.REQUEST).alias("m"))
    cols = [c for c in rq.REQUEST_MESSAGE_FIELDS]
    return _ts_text(parsed.select("key", *[F.col(f"m.{c}").alias(c) for c in cols]))


@register("request_flatten")
def q_request_flatten(spark, sf):
    msgs = _request_messages(Tables(spark, sf))
    flat = rq.flatten(rq.parse_requests(msgs, keep=[]))
    return _ts_text(flat)


@register("request_features")
def q_request_features(spark, sf):
    msgs = _request_messages(Tables(spark, sf))
    return _ts_text(rq.with_route(rq.flatten(rq.parse_requests(msgs, keep=[]))))


@register("make_tasks")
def q_make_tasks(spark, sf):
    path = shared_path(spark, "prediction_tasks", unique=True)
    append_table(Tables(spark, sf).tasks, path)
    return spark.read.schema(schemas.TASK).parquet(path)


@register("batch_results_for_day")
def q_batch_results_for_day(spark, sf):
    """A day of the stored result table."""
    stored = spark.read.parquet(Tables(spark, sf).results_path())
    return with_class_flag(rq.results_for_day(stored, RESULT_DAY)).drop(*ml_work_columns(stored))


def _rule_scored(t: Tables) -> DataFrame:
    return t.enriched.withColumn("prediction", delay_class("DepDelay"))


@register("response_messages")
def q_response_messages(spark, sf):
    msgs = _through_topic(spark, rq.response_messages(_rule_scored(Tables(spark, sf))), "responses")
    return _ts_text(rq.parse_responses(msgs))


@register("response_lookup")
def q_response_lookup(spark, sf):
    msgs = rq.response_messages(_rule_scored(Tables(spark, sf)), keep=["Timestamp"])
    first = rq.response_lookup(msgs, _md5_text(LOOKUP_UUID_EVENT), order=["Timestamp", "value"])
    return _ts_text(rq.parse_responses(first.select("key", "value")))


def _md5_text(n: int) -> str:
    return hashlib.md5(str(n).encode()).hexdigest()


@register("request_status")
def q_request_status(spark, sf):
    t = Tables(spark, sf)
    return joins.request_status(t.keyed_requests.select("UUID"), t.responses)


@register("result_poll")
def q_result_poll(spark, sf):
    """The status page's call: one request's status and result (FIL6, JOIN3)."""
    path = Tables(spark, sf).polled_results()
    return _ts_text(results.poll(spark, f"{path}/store", f"{path}/index", _md5_text(LOOKUP_UUID_EVENT)))


@register("result_poll_all")
def q_result_poll_all(spark, sf):
    """The same for every request."""
    t = Tables(spark, sf)
    path = t.polled_results()
    return _ts_text(results.poll_many(spark, f"{path}/store", f"{path}/index", t.keyed_requests))


@register("prediction_label")
def q_prediction_label(spark, sf):
    t = Tables(spark, sf)
    st = joins.request_status(t.keyed_requests.select("UUID"), t.responses)
    return st.select("UUID", "prediction", prediction_label("prediction").alias("label"))


# --- Models (ML*) ------------------------------------------------------------

@register("delay_regression")
def q_delay_regression(spark, sf):
    return ml.fit_line(Tables(spark, sf).flights, "DepDelay", "ArrDelay")


@register("assemble_features")
def q_assemble_features(spark, sf):
    """The assembled feature vector of every flight, one column per slot
    (numeric features, then the four frequency-rank indexes)."""
    train = ml.training_frame(Tables(spark, sf).flights)
    out = ml.features_as_array(ml.assemble_features(train).select("FlightId", "features", ml.LABEL))
    slots = ml.NUMERIC + ml.INDEX_COLS
    return out.select("FlightId", ml.LABEL, *[F.col("features")[i].alias(f"f_{c}") for i, c in enumerate(slots)])


def _trained(t: Tables):
    return t.classifier()


#: A prediction depends on the learned trees, which SQL can't say; that it is one of
#: the four classes, and equal to another run's, it can.
CLASSES = (0.0, 1.0, 2.0, 3.0)


def with_class_flag(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.withColumn("in_classes", F.col(prediction).isin(*CLASSES)).drop(prediction)


def ml_work_columns(df: DataFrame) -> list[str]:
    return [c for c in ("Route",) if c in df.columns]


@register("train_metrics")
def q_train_metrics(spark, sf):
    m = ml.train_metrics(ml.training_frame(Tables(spark, sf).flights))
    return m.select("n_test", "majority_rate", "num_trees", (F.col("accuracy") > F.col("majority_rate")).alias("beats_majority"))


@register("score_batch")
def q_score_batch(spark, sf):
    t = Tables(spark, sf)
    return with_class_flag(_ts_text(ml.score(_trained(t), t.enriched.drop("event_id", "ts"))))


def same_again(model, scored: DataFrame) -> DataFrame:
    """Score rows once more and tell whether each prediction is the same."""
    again = ml.score(model, scored.withColumnRenamed("prediction", "_first"))
    return again.withColumn("same", F.col("prediction").eqNullSafe(F.col("_first"))).drop("_first")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """Scores of the model and of its saved and reloaded copy, row by row."""
    t = Tables(spark, sf)
    model = _trained(t)
    path = ml.save_model(model, shared_path(spark, "models", "delay_classifier", unique=True))
    scored = ml.score(model, t.enriched.drop("event_id", "ts"))
    return with_class_flag(_ts_text(same_again(ml.load_model(path), scored)))


@register("score_tasks")
def q_score_tasks(spark, sf):
    """All rows of the stored result table."""
    stored = spark.read.parquet(Tables(spark, sf).results_path())
    return with_class_flag(stored).drop(rq.RESULT_DAY_COLUMN, *ml_work_columns(stored))


@register("delay_regression_predict")
def q_delay_regression_predict(spark, sf):
    t = Tables(spark, sf)
    out = ml.predict_delay(t.regressor(), t.tasks)
    return out.withColumn("has_delay", F.col("Delay").isNotNull() & ~F.isnan("Delay")).drop("Delay")


@register("regression_report")
def q_regression_report(spark, sf):
    return ml.regressor_report(rq.with_date_parts(Tables(spark, sf).flights))


@register("delay_regression_exact")
def q_delay_regression_exact(spark, sf):
    """What is left of each category's normal equation, from the predicted delay of every flight."""
    t = Tables(spark, sf)
    return sparse_regression.gradients(t.sparse_regressor(), rq.with_date_parts(t.flights))
