"""Connected components of a graph given as edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Keys with more than this part of all rows are joined by broadcast: there can't be more of
#: them than its inverse.
HOT_PART = 1 / 1000


def join_keys(rows: DataFrame, keys: DataFrame, on: str, n_rows: int) -> DataFrame:
    """Inner join of rows with keys, which has one row a key and the number n of its rows
    among the n_rows of ``rows``. Rows of hot keys stay where they are and get their key's
    values by broadcast (at most 1,000 keys), the others are shuffled."""
    hot = F.broadcast(keys.where(F.col("n") > n_rows * HOT_PART))
    rest = keys.where(F.col("n") <= n_rows * HOT_PART)
    return rows.join(hot, on).unionByName(rows.join(hot.select(on), on, "left_anti").join(rest, on)).drop("n")


def _star(edges: DataFrame, small: bool, n_rows: int) -> DataFrame:
    """Link neighbours to the least neighbour m of each node u: those above u (large
    star), or those below u and u itself (small star)."""
    if small:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    linked = join_keys(both, least, "u", n_rows if small else 2 * n_rows)
    if small:
        new = linked.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        new = linked.filter("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return new.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, component): each node of an edge with the least node it can
    reach. Edges never grow in number: each round writes them once to the shared folder
    and the last is the one that changed no edge. Nodes only ever move to lesser ones, so
    the rounds end by themselves, however long a chain is. Nulls and loops are dropped.
    """
    edges = common.staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def state():
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now, before = state(), None
    while now != before:
        before = now
        edges = common.staged(_star(edges, False, now[0]), "edges")
        edges = common.staged(_star(edges, True, now[0]), "edges")
        now = state()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
