"""Live requests enriched with the route distance while the route table is published anew (JOIN1).

A stream-static join keeps the table it was planned with. Here each micro-batch asks which
publication is the latest and joins that one; the answer is noted in the ledger, so a batch
that is run again joins the publication it had before and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators.joins import enrich_distance
from aerolake.sources import versions
from aerolake.streaming.ledger import Ledger
from aerolake.streaming.scoring import BatchWriter, _writer

ROUTES = "Origin string, Dest string, Distance double"
NONE_YET = "-"


def start_enriched(requests: DataFrame, routes_root: str, write: BatchWriter, checkpoint_root: str,
                   max_rows: int | None = None, trigger: dict | None = None, name: str = "enrich") -> StreamingQuery:
    """Requests (with Origin and Dest) plus Distance to ``write``, batch by batch. Before
    the first publication, and for unknown routes, Distance is null. ``max_rows`` is the size
    up to which a publication is broadcast; a larger one is joined by shuffle."""
    ledger = Ledger(requests.sparkSession, f"{checkpoint_root.rstrip('/')}/{name}_ledger")

    def enrich(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = ledger.get("routes", batch_id) or ledger.put("routes", batch_id, versions.latest(spark, routes_root) or NONE_YET)
        routes = spark.createDataFrame([], ROUTES) if version == NONE_YET else spark.read.parquet(f"{routes_root}/{version}")
        write(enrich_distance(batch, routes, max_rows=max_rows), batch_id)
    return _writer(requests, name, checkpoint_root, trigger).foreachBatch(enrich).start()
