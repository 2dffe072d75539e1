"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One round of the alternating star algorithm (Kiveris et al., 2014).

    ``links`` has distinct rows (u, v) with u > v. A large star hangs a node's
    larger neighbours on the smallest neighbour, a small star the smaller ones.
    """
    if larger:
        around = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("m", "u").alias("m"))
    hung = around.join(least, "u")
    moved = hung.filter("v > u") if larger else hung.filter("v < u")
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionAll(own).filter("u > v").distinct()


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) for every node that ``links`` (a, b) names.

    ``component`` is the smallest node that can be reached. Each round is two
    map-side combined groupings and two joins on the nodes, written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain.
    """
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = scratch.put(links.filter("u > v").distinct(), f"{label}-0")
    state, turn = None, 0
    while True:
        turn += 1
        links = scratch.put(_star(_star(links, True), False), f"{label}-{turn}")
        scratch.drop(f"{label}-{turn - 1}")
        now = links.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
        if now == state:
            break
        state = now
    own = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        own.select("node", F.col("node").alias("component"))
    )
