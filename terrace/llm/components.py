"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` of longs → ``(node, root)`` for every node with an edge to another node.

    ``root`` is the smallest node of the component. Each half step writes the minima before it joins them, so
    that a node with many neighbours is a plain two-sided join which AQE can split. Self loops and repeated
    edges are ignored; an empty input gives an empty result. Nothing but one row of counts reaches the driver.
    """
    e = stage(
        edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(),
        "cc-edges",
    )
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = stage(both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m")), "cc-large")
        large = stage(
            both.filter("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct(),
            "cc-large-edges",
        )
        low = stage(large.groupBy("src").agg(F.min("dst").alias("m")), "cc-small")
        hang = large.join(low, "src").filter("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        e = stage(hang.union(low.select("src", F.col("m").alias("dst"))).distinct(), "cc-small-edges")
        before, state = state, _state(e)
        if before == state:
            break
    return e.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
        e.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    )


def _state(e: DataFrame) -> tuple:
    """Number of edges and an order-free checksum of them."""
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x"), F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.x, r.s
