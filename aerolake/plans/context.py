"""Shared building blocks of the registered queries over the driver's tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolake.operators import documents, incremental, pages, requests as rq, rollups, term_table
from aerolake.functions.labels import delay_class
from aerolake.schemas import RESPONSE_FIELDS
from aerolake.session import spread
from aerolake.sources import fixtures
from aerolake.sources.materialize import cached_model, materialize, materialize_path
from aerolake.sources.tables import read_table
from aerolake.streaming import results
from aerolake.streaming.scoring import store_writer

#: Routes up to which the stored route table (three short columns) is broadcast: some 10 MB.
ROUTE_MAX_ROWS = 200_000
#: Order of the flight pages (a total one).
PAGE_SORT = ["FlightDate", "DepTime", "Carrier", "FlightNum", "FlightId"]
FLIGHT_INPUTS = ["lineitem", "orders", "customer", "supplier", "part", "nation"]
#: Summaries kept up to date from appended files.
FLIGHT_SUMMARIES = {"routes": incremental.route_distance(), "months": incremental.flights_by_month(),
                    "carrier_airplanes": incremental.airplanes_per_carrier()}
AIRPLANE_SUMMARIES = {"manufacturers": incremental.manufacturer_totals()}


class Tables:
    """Lazily built views over one scale-factor folder. Nothing is computed
    until a query's DataFrame runs; properties only build plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def paths(self, *names: str) -> list[str]:
        return [f"{self.sf_dir.rstrip('/')}/{n}.parquet" for n in names]

    @cached_property
    def flights(self) -> DataFrame:
        """The flight fact table, stored once per input fingerprint, clustered
        by date (lookups by day read few row groups)."""
        return materialize(self.spark, "flights", self.paths(*FLIGHT_INPUTS),
                           lambda: fixtures.flight_rows(self.spark, self.sf_dir),
                           cluster_by=["FlightDate", "FlightId"], lookup_by=["TailNum", "FlightNum"],
                           deal_by=fixtures.FLIGHT_DEAL, finish=fixtures.flight_fields, rows=self.table("lineitem").count)

    @cached_property
    def flights_view(self) -> DataFrame:
        """The same rows as an unmaterialized plan over the driver's tables."""
        return fixtures.flights(self.spark, self.sf_dir)

    def classifier(self):
        """The delay classifier trained on these flights (stored artifact)."""
        from aerolake.operators import ml
        return cached_model(self.spark, "delay_classifier", self.paths(*FLIGHT_INPUTS),
                            lambda: ml.train_classifier(ml.training_frame(self.flights)))

    def regressor(self):
        from aerolake.operators import ml
        return cached_model(self.spark, "delay_regressor", self.paths(*FLIGHT_INPUTS),
                            lambda: ml.train_regressor(rq.with_date_parts(self.flights)))

    def sparse_regressor(self) -> str:
        """The delay regression with a weight for every category (stored artifact)."""
        from aerolake.operators import sparse_regression
        return materialize_path(self.spark, "sparse_regressor", self.paths(*FLIGHT_INPUTS), lambda: None,
                                write=lambda to: sparse_regression.fit(rq.with_date_parts(self.flights), to))

    @cached_property
    def airplanes(self) -> DataFrame:
        return fixtures.airplanes(self.spark, self.sf_dir)

    @cached_property
    def airlines(self) -> DataFrame:
        return fixtures.airlines(self.spark, self.sf_dir)

    @cached_property
    def requests(self) -> DataFrame:
        return fixtures.requests(self.spark, self.sf_dir)

    @cached_property
    def responses(self) -> DataFrame:
        return fixtures.responses(self.spark, self.sf_dir)

    @cached_property
    def distances(self) -> DataFrame:
        """The route table, stored once: requests read it, not the flight history."""
        return materialize(self.spark, "route_distance", self.paths(*FLIGHT_INPUTS),
                           lambda: rollups.route_distance(self.flights, ordered=False))

    def _summary(self, name: str, inputs: list[str], build) -> DataFrame:
        """A finished summary, stored once and read by key afterwards."""
        return materialize(self.spark, name, self.paths(*inputs), build)

    @cached_property
    def carriers(self) -> DataFrame:
        return self._summary("carrier_summary", FLIGHT_INPUTS, lambda: rollups.carrier_summary(self.flights))

    @cached_property
    def months(self) -> DataFrame:
        return self._summary("month_counts", FLIGHT_INPUTS, lambda: rollups.flights_by_month(self.flights))

    @cached_property
    def carrier_airplanes(self) -> DataFrame:
        return self._summary("carrier_airplanes", FLIGHT_INPUTS, lambda: rollups.airplanes_per_carrier(self.flights))

    @cached_property
    def manufacturers(self) -> DataFrame:
        return self._summary("manufacturer_totals", ["part"], lambda: rollups.manufacturer_totals(self.airplanes))

    def results_path(self) -> str:
        """The result table of batch scoring: the scored tasks, by day."""
        from aerolake.operators import ml
        return materialize_path(self.spark, "prediction_results", self.paths("events", *FLIGHT_INPUTS),
                                lambda: self.tasks, write=lambda to: rq.store_results(ml.score(self.classifier(), self.tasks), to))

    def document_terms(self) -> str:
        """The term table of the documents' texts."""
        return materialize_path(self.spark, "document_terms", self.paths("documents"), lambda: None,
                                write=lambda to: term_table.build(spread(self.table("documents")), "doc_id", "text", to))

    def flight_pages(self) -> str:
        """The flights in the order of the flight pages."""
        return materialize_path(self.spark, "flight_pages", self.paths(*FLIGHT_INPUTS), lambda: None,
                                write=lambda to: pages.build(self.flights, PAGE_SORT, to))

    def carrier_pages(self) -> str:
        """The flights of each carrier in the order of the flight pages."""
        return materialize_path(self.spark, "carrier_pages", self.paths(*FLIGHT_INPUTS), lambda: None,
                                write=lambda to: pages.build(self.flights, PAGE_SORT, to, within=["Carrier"]))

    def airplane_documents(self) -> str:
        """A document for each airplane: its flights in pages."""
        return materialize_path(self.spark, "airplane_documents", self.paths(*FLIGHT_INPUTS), lambda: None,
                                write=lambda to: documents.build(self.flights.select("TailNum", *rollups.FLIGHT_FIELDS), "TailNum",
                                                                 ["FlightDate", "FlightId"], to, "flights"))

    def carrier_documents(self) -> str:
        """A document for each carrier: its airplanes in pages."""
        return materialize_path(self.spark, "carrier_documents", self.paths(*FLIGHT_INPUTS), lambda: None,
                                write=lambda to: documents.build(self.flights.select("Carrier", "TailNum").distinct(), "Carrier",
                                                                 ["TailNum"], to, "airplanes"))

    def refreshed_summaries(self) -> str:
        """Summaries kept up to date: the flights are appended in three steps, each of which
        reads the new files alone."""
        def write(to: str) -> None:
            for n in range(3):
                (self.flights.where(F.pmod(F.xxhash64("FlightId"), F.lit(3)) == n)
                 .select("Origin", "Dest", "Distance", "Year", "Month", "Carrier", "TailNum").write.mode("append").parquet(f"{to}/flights"))
                incremental.refresh(self.spark, f"{to}/flights", f"{to}/store", FLIGHT_SUMMARIES)
        return materialize_path(self.spark, "refreshed_summaries", self.paths(*FLIGHT_INPUTS), lambda: None, write=write) + "/store"

    def refreshed_airplanes(self) -> str:
        def write(to: str) -> None:
            for n in range(3):
                (self.airplanes.where(F.pmod(F.xxhash64("TailNum"), F.lit(3)) == n)
                 .select("TailNum", "Manufacturer").write.mode("append").parquet(f"{to}/airplanes"))
                incremental.refresh(self.spark, f"{to}/airplanes", f"{to}/store", AIRPLANE_SUMMARIES)
        return materialize_path(self.spark, "refreshed_airplanes", self.paths("part"), lambda: None, write=write) + "/store"

    def polled_results(self) -> str:
        """A result store as a stream leaves it: four batches, the first three folded into
        an index in two steps. (The rule's classes stand in for a model's.)"""
        def write(to: str) -> None:
            rows = self.enriched.withColumn("prediction", delay_class("DepDelay"))
            for n in range(4):
                own = rows.where(F.col("event_id") % 4 == n).select(*RESPONSE_FIELDS)
                store_writer(f"{to}/store")(own, n)
                if n in (0, 2):
                    results.compact(self.spark, f"{to}/store", f"{to}/index", buckets=16)
        return materialize_path(self.spark, "polled_results", self.paths("events", *FLIGHT_INPUTS), lambda: None, write=write)

    @cached_property
    def parsed(self) -> DataFrame:
        return rq.parse_requests(self.requests, keep=["event_id", "ts"])

    @cached_property
    def valid(self) -> DataFrame:
        return rq.valid_only(self.parsed)

    @cached_property
    def enriched(self) -> DataFrame:
        """Valid requests with distance, date parts; time stamp and id taken
        from the event (deterministic stand-ins for now() and uuid4())."""
        return rq.enrich(self.valid, self.distances,
                         ts=F.col("ts").cast("timestamp"),
                         uuid=F.md5(F.col("event_id").cast("string")),
                         distance_max_rows=ROUTE_MAX_ROWS)

    @cached_property
    def tasks(self) -> DataFrame:
        return rq.make_tasks(self.enriched)

    @cached_property
    def keyed_requests(self) -> DataFrame:
        """Every request with its topic key (UUID) and time."""
        return self.requests.select(F.md5(F.col("event_id").cast("string")).alias("UUID"),
                                    F.col("ts").cast("timestamp").alias("rq_ts"), "value")
