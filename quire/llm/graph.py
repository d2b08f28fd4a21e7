"""Connected components by contraction, with no vertex or edge on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, narrow


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(v, c)``: each linked vertex and its component's smallest vertex.

    Each round hooks every vertex to its smallest neighbour, jumps pointers to
    the roots, and contracts the links to roots; the number of vertices at
    least halves, so rounds are logarithmic.  Joins stand alone between
    checkpoints, so AQE can split a vertex that holds most links.  No links:
    no rows.
    """
    links = narrow(cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select(F.col("b").alias("v"), F.col("a").alias("u")))
        parent = narrow(cut(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p"))))
        while True:
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = narrow(cut(parent.join(up, "p").select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved"))))
            done = jumped.filter("moved").isEmpty()
            parent = jumped.select("v", "p")
            if done:
                break
        if labels is None:
            labels = parent.select("v", F.col("p").alias("c"))
        else:
            step = parent.select(F.col("v").alias("c"), "p")
            labels = narrow(cut(labels.join(step, "c", "left").select("v", F.coalesce("p", "c").alias("c"))))
        pa, pb = (parent.select(F.col("v").alias(x), F.col("p").alias(f"p{x}")) for x in "ab")
        half = narrow(cut(links.join(pa, "a").select(F.col("pa").alias("a"), "b")))
        links = narrow(cut(half.join(pb, "b").select(F.least("a", "pb").alias("a"), F.greatest("a", "pb").alias("b")).filter("a <> b").distinct()))
    return labels if labels is not None else links.select(F.col("a").alias("v"), F.col("b").alias("c"))
