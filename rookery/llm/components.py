"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for each id of ``edges`` (``u, v`` long): the smallest
    id that links reach. No edges give no rows.

    Each round every vertex takes its smallest neighbour, the edges are relabelled
    and those within a label dropped; at least half the vertices that still have
    edges vanish in a round, and a star needs one. Tables between rounds are
    written to the shared checkpoint folder, and joins read both sides from
    there, so that adaptive execution can split a hub's rows."""
    def clean(e: DataFrame) -> DataFrame:
        return e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    labels = None
    e = cut_lineage(clean(edges))
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("m")))
        if labels is None:
            labels = least.withColumnRenamed("m", "component")
        else:
            labels = cut_lineage(labels.join(least.withColumnRenamed("id", "component"), "component", "left")
                                 .select("id", F.coalesce("m", "component").alias("component")))
        a, b = least.select(F.col("id").alias("u"), F.col("m").alias("mu")), least.select(F.col("id").alias("v"), F.col("m").alias("mv"))
        e = cut_lineage(clean(e.join(a, "u").join(b, "v").select(F.col("mu").alias("u"), F.col("mv").alias("v"))))
    if labels is None:
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return labels
