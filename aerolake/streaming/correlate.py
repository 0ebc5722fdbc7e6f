"""Request/response correlation with a time limit (JOIN4, STR4).

A reader waits for the reply to its own request and gives up after a limit. As a
stream: requests and replies are watermarked and joined left-outer on UUID with
``rs_ts BETWEEN rq_ts AND rq_ts + limit``; of the replies inside that window the
earliest answers the request. The join keeps a request until the watermark has
passed its limit, and only then the request's one row is final: OK with the
earliest reply, or TIMEOUT. State is bounded by limit plus watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolake.functions.labels import STATUS_TIMEOUT, status_column


def correlate(requests: DataFrame, responses: DataFrame, limit_seconds: int = 20,
              watermark: str = "5 seconds") -> DataFrame:
    """(UUID, rq_ts) x (UUID, rs_ts, prediction) -> (UUID, status, prediction),
    one row per request (UUID, rq_ts), for streams and for batch tables."""
    rq = requests.select(F.col("UUID").alias("rq_uuid"), "rq_ts").withWatermark("rq_ts", watermark)
    rs = (responses.select(F.col("UUID").alias("rs_uuid"), "rs_ts", "prediction")
          .withWatermark("rs_ts", watermark))
    cond = ((F.col("rq_uuid") == F.col("rs_uuid"))
            & (F.col("rs_ts") >= F.col("rq_ts"))
            & (F.col("rs_ts") <= F.col("rq_ts") + F.expr(f"INTERVAL {int(limit_seconds)} SECONDS")))
    inside = rq.join(rs, cond, "leftOuter")
    first = inside.groupBy("rq_uuid", "rq_ts").agg(F.min(F.when(
        F.col("rs_uuid").isNotNull(), F.struct("rs_ts", "prediction"))).alias("_reply"))
    return first.select(F.col("rq_uuid").alias("UUID"),
                        status_column(F.col("_reply").isNotNull(), STATUS_TIMEOUT).alias("status"),
                        F.col("_reply.prediction").alias("prediction"))
