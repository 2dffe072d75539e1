"""Fixity of replicated archive files by hash trees over records and offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.running import running_totals
from .tables import Scratch

# Bytes of a file that one node of the first level covers; each further level
# covers so many times as much.
SPAN = 1 << 16
FAN_OUT = 16


def warc_record(key: Column, url: Column, body: Column) -> Column:
    """A resource record, header and body, as text. A null url or body is left empty."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(key.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def laid_out(records: DataFrame, order: list[str], label: str) -> DataFrame:
    """Add ``start``, the offset in the file, to records (file, length, ...).

    ``order`` must end in a unique row number. Files may be of any size: running
    totals are taken over even slices of the ordered records.
    """
    total = running_totals(records, ["file"], order, {"bytes": F.col("length")}, label)
    return total.withColumn("start", F.col("bytes_running") - F.col("length")).drop(
        "slice", "bytes_running", "bytes_before"
    )


class HashTree:
    """A replica's tree. Level 0 has the records (file, node = offset, hash); a node of
    level n covers SPAN * FAN_OUT^(n-1) bytes of offsets; the last level has one node
    per file, its root."""

    def __init__(self, manifest: DataFrame, levels: int, scratch: Scratch, name: str):
        hashed = F.sha2(F.concat_ws(" ", "start", "length", "digest"), 256)
        # Records that claim the same offset of a file are one leaf together.
        leaf = manifest.select("file", F.col("start").alias("node"), hashed.alias("hash"))
        self.levels = [scratch.put(self._joined(leaf), f"{name}-0")]
        for level in range(1, levels + 1):
            below = self.levels[-1].select(
                "file", parent(level).alias("node"), F.col("node").alias("child"), "hash"
            )
            self.levels.append(scratch.put(self._joined(below), f"{name}-{level}"))

    @staticmethod
    def _joined(nodes: DataFrame) -> DataFrame:
        """One hash per node over its children's, in their order. A node has
        ``FAN_OUT`` children, or on the first level the records of one span."""
        child = "child" if "child" in nodes.columns else "hash"
        listed = F.array_sort(F.collect_list(F.struct(F.col(child).alias("at"), "hash")))
        joined = F.array_join(F.transform(listed, lambda x: x["hash"]), " ")
        return nodes.groupBy("file", "node").agg(F.sha2(joined, 256).alias("hash"))


def parent(level: int) -> Column:
    """Number of the node of ``level`` above a node of the level below."""
    return F.floor(F.col("node") / (SPAN if level == 1 else FAN_OUT)).cast("bigint")


def levels_for(longest: int) -> int:
    """Levels until one node covers a file of that many bytes."""
    level, covered = 1, SPAN
    while covered < longest:
        level, covered = level + 1, covered * FAN_OUT
    return level


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """Nodes (file, node) that one side lacks or whose hashes differ."""
    a = one.select("file", "node", F.col("hash").alias("a"))
    b = other.select("file", "node", F.col("hash").alias("b"))
    return a.join(b, ["file", "node"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))


def audit(master: DataFrame, replica: DataFrame) -> DataFrame:
    """Where two replicas differ.

    Both are manifests (file, start, length, digest), with any further columns. The
    roots of all files are compared; from a level only the children of differing
    nodes are fetched, down to the records. Columns: ``file``, ``start``, then for
    the master and, as ``replica_...``, for the replica ``length`` and ``digest``,
    and ``state``: changed, missing (in the replica) or extra. Records that share
    an offset are matched by digest, repeats by their number. Equal replicas, or
    two empty ones, give no rows.
    """
    spark = master.sparkSession
    scratch = Scratch(spark, "fixity")
    kept = ["file", "start", "length", "digest"]
    master = scratch.put(master.select(*kept), "master")
    replica = scratch.put(replica.select(*kept), "replica")
    end = F.max(F.col("start") + F.col("length"))
    longest = max(x.agg(end).first()[0] or 1 for x in (master, replica))
    levels = levels_for(longest)
    one = HashTree(master, levels, scratch, "a").levels
    other = HashTree(replica, levels, scratch, "b").levels
    found = scratch.put(_differing(one[levels], other[levels]).select("file", "node"), "top")
    for level in range(levels, 0, -1):
        above = found.select("file", F.col("node").alias("above"))
        sides = [
            x[level - 1].withColumn("above", parent(level)).join(above, ["file", "above"], "semi")
            for x in (one, other)
        ]
        found = scratch.put(_differing(*sides).select("file", "node"), f"differing-{level}")
    spots = found.select("file", F.col("node").alias("start"))
    numbered = [
        x.join(spots, ["file", "start"], "semi")
        .groupBy(*kept)
        .agg(F.count("*").alias("times"))
        .join(y.groupBy(*kept).agg(F.count("*").alias("there")), kept, "left")
        .withColumn("more", F.col("times") - F.coalesce("there", F.lit(0)))
        .filter("more > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("more").cast("int"))))
        for x, y in ((master, replica), (replica, master))
    ]
    a, b = (_numbered(x) for x in numbered)
    b = b.select(
        "file", "start", "copy", F.col("length").alias("replica_length"),
        F.col("digest").alias("replica_digest"),
    )
    state = (
        F.when(F.col("replica_digest").isNull(), "missing")
        .when(F.col("digest").isNull(), "extra")
        .otherwise("changed")
    )
    return a.join(b, ["file", "start", "copy"], "full").select(
        "file", "start", "length", "digest", "replica_length", "replica_digest",
        state.alias("state"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Differing records of one side, numbered within their offset."""
    order = W.partitionBy("file", "start").orderBy("digest", "length", "copy")
    return rows.withColumn("copy", F.row_number().over(order)).select(
        "file", "start", "copy", "length", "digest"
    )
