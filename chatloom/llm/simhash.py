"""Near copies by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import Scratch, free_name, text_rows

SHINGLE_WORDS = 3
MAX_BITS = 3

# Fingerprints are looked up by halves. Of two that differ in three bits or
# fewer, one half differs in at most one bit.
HALF = 32
HALF_MASK = (1 << HALF) - 1
# Two counters of 32 bits lie in one sum: those of a bit and of the one HALF above it.
LANES = (1 << HALF) + 1


def _words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def fingerprints(rows: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(row, doc_id, print) for rows (row, doc_id, text), by JVM expressions alone.

    A bit is 1 if it is set in over half of the hashes of all shingles, repeats
    included; Spark's xxhash64 is XXH64 with seed 42. A text of fewer words than a
    shingle is one shingle; without words the print is 0. The hashes of a row are
    counted where it is read, so a row of any length is a few numbers in the shuffle.
    """
    # The words stand in a column of their own, so that no lambda splits again.
    split = rows.select("row", "doc_id", F.explode(F.array(_words(F.col("text")))).alias("words"))
    many = F.size("words")
    shingle = F.transform(
        F.slice("words", F.lit(1), F.greatest(many - (size - 1), F.lit(1))),
        lambda w, i: F.xxhash64(
            F.concat_ws(" ", w, *(F.get("words", i + place) for place in range(1, size)))
        ),
    )
    hashes = split.select("row", "doc_id", F.explode_outer(F.when(many > 0, shingle)).alias("hash"))
    counted = hashes.groupBy("row", "doc_id").agg(
        F.count("hash").alias("shingles"),
        *(
            F.sum(F.shiftright("hash", bit).bitwiseAND(F.lit(LANES))).alias(f"ones{bit}")
            for bit in range(HALF)
        ),
    )

    def bits(lane: int) -> Column:
        found = F.lit(0).cast("bigint")
        for bit in range(HALF):
            ones = F.col(f"ones{bit}")
            ones = F.shiftrightunsigned(ones, HALF) if lane else ones.bitwiseAND(F.lit(HALF_MASK))
            place = 1 << (bit + HALF * lane)
            signed = place - (1 << 64) if place >> 63 else place
            value = F.when(2 * ones > F.col("shingles"), F.lit(signed).cast("bigint"))
            found = found.bitwiseOR(F.coalesce(value, F.lit(0).cast("bigint")))
        return found

    return counted.select("row", "doc_id", bits(0).bitwiseOR(bits(1)).alias("print"))


def _half(value: Column, which: int) -> Column:
    upper = F.shiftrightunsigned(value, HALF)
    return upper if which else value.bitwiseAND(F.lit(HALF_MASK).cast("bigint"))


def _within_two(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join all prints within two bits.

    Every print stands at itself and its 64 neighbours. Prints at the same place
    differ in two bits at most, and there are 65 of them at most, so each place
    hangs its prints on the smallest: no place, however crowded, gives pairs.
    """
    masks = [0, *(1 << i for i in range(63)), -(1 << 63)]
    ball = F.array(*[F.col("print").bitwiseXOR(F.lit(m).cast("bigint")) for m in masks])
    places = prints.select("print", F.explode(ball).alias("place"))
    shared = places.groupBy("place").agg(F.collect_list("print").alias("here"))
    shared = shared.filter(F.size("here") > 1).select(F.array_sort("here").alias("here"))
    return shared.select(
        F.explode(F.slice("here", 2, 64)).alias("a"), F.element_at("here", 1).alias("b")
    )


def _merged(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join whose sides grow with the prints: neither is ever sent to the driver."""
    return left.join(right.hint("merge"), keys, how)


def _at_most_three(prints: DataFrame) -> DataFrame:
    """Links (a, b) between prints of different classes within three bits.

    ``prints`` has columns print and class. Each half of every print is listed
    in the table under its value; it is looked up there under its own value and
    under the values with one 0 bit set to 1 (of two halves that differ in one
    bit, one finds the other). Classes meet first: only where two classes share
    a table entry are their prints fetched and compared in full.
    """
    tables, probes = [], []
    for which in (0, 1):
        half = _half(F.col("print"), which)
        tables.append(prints.select("print", "class", F.lit(which).alias("half"), half.alias("at")))
        ball = F.array(
            half,
            *[
                F.when(half.bitwiseAND(F.lit(1 << i).cast("bigint")) == 0, half + (1 << i))
                for i in range(HALF)
            ],
        )
        probes.append(
            prints.select(
                "print",
                "class",
                F.lit(which).alias("half"),
                F.explode(F.array_compact(ball)).alias("at"),
            )
        )
    table, probe = tables[0].unionAll(tables[1]), probes[0].unionAll(probes[1])
    listed = table.select("half", "at", F.col("class").alias("one")).distinct()
    asked = probe.select("half", "at", F.col("class").alias("other")).distinct()
    meeting = _merged(listed, asked, ["half", "at"]).filter("one <> other")
    a = table.select("half", "at", F.col("class").alias("one"), F.col("print").alias("a"))
    b = probe.select("half", "at", F.col("class").alias("other"), F.col("print").alias("b"))
    fetched = _merged(_merged(meeting, a, ["half", "at", "one"]), b, ["half", "at", "other"])
    return fetched.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select(
        "a", "b"
    )


def _linked(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(print, class) for distinct prints; linked prints have the same class."""
    near = components(_within_two(prints), scratch, "near")
    near = near.withColumnRenamed("node", "print")
    classed = _merged(prints, near, ["print"], "left").select(
        "print", F.coalesce("component", "print").alias("class")
    )
    classed = scratch.put(classed, "classed")
    links = scratch.put(_at_most_three(classed), "links")
    of = classed.select(F.col("print").alias("a"), F.col("class").alias("ca"))
    to = classed.select(F.col("print").alias("b"), F.col("class").alias("cb"))
    between = _merged(_merged(links, of, ["a"]), to, ["b"])
    between = between.select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(between, scratch, "far").withColumnRenamed("node", "class")
    return classed.join(joined, "class", "left").select(
        "print", F.coalesce("component", "class").alias("class")
    )


def simhash_components(numbered: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, doc_id, print, component_id, keeper) for rows (row, doc_id, text).

    Texts are fingerprinted once each; everything after that works on distinct
    prints, so that copies never meet as pairs. ``component_id`` is the smallest
    key of the component; ``keeper`` the one row that stands for it.
    """
    printed = scratch.put(fingerprints(numbered), "printed")
    # The smallest key comes first; a row without a key only stands for its like.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    per_print = scratch.put(printed.groupBy("print").agg(first.alias("first")), "prints")
    classes = _linked(per_print.select("print"), scratch)
    classed = scratch.put(classes.join(per_print, "print"), "classes")
    best = classed.groupBy("class").agg(F.min("first").alias("best"))
    known = classed.select("print", "class").join(best, "class")
    known = known.select(
        "print", F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("keeper")
    )
    return printed.join(known, "print")


def simhash_classes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprint and component of every row.

    Columns: key, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest
    key among the rows that links reach, itself included). A null text counts as
    empty; all texts without words have fingerprint 0 and form one component with
    whatever is within the distance. Null keys take the component's smallest key,
    or null if it has none. Repeated rows each give a row.
    """
    scratch = Scratch(df.sparkSession, "simhash")
    rows = text_rows(df, text, key).withColumn("row", F.monotonically_increasing_id())
    found = simhash_components(rows, scratch)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_copies(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with one row of every component: that of the smallest key."""
    scratch = Scratch(df.sparkSession, "dedup")
    row = free_name(df, "row")
    numbered = scratch.put(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(
        F.col(row).alias("row"),
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kept = simhash_components(rows, scratch).filter("row = keeper").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*df.columns)
