"""Connected components of a link table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Table (id, component) of every id in ``links`` (a, b); a component is named by its smallest id.

    Each round takes the smallest name among neighbours, then follows that name
    to its own name, so the rounds grow with the logarithm of a chain's length.
    Every round is written to the shared folder; a hub's messages are reduced
    before the shuffle. No table reaches the driver, only the count of changes.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.write(edges.distinct(), f"{name}-edges")
    now = scratch.write(
        edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), f"{name}-0"
    )
    turn = 0
    while True:
        near = (
            edges.join(now, edges["a"] == now["id"]).groupBy("b").agg(F.min("component").alias("least"))
        )
        lower = now.join(near, now["id"] == near["b"], "left").select(
            "id", "component", F.least("component", "least").alias("next")
        )
        names = now.select(F.col("id").alias("at"), F.col("component").alias("leads_to"))
        turn += 1
        moved = scratch.write(
            lower.join(names, F.col("next") == F.col("at"), "left").select(
                "id", F.least("next", "leads_to").alias("component"), (F.col("next") != F.col("component")).alias("moved")
            ),
            f"{name}-{turn}",
        )
        changed = moved.where("moved").limit(1).count()
        scratch.drop(f"{name}-{turn - 1}")
        now = moved.select("id", "component")
        if not changed:
            scratch.drop(f"{name}-edges")
            return now
