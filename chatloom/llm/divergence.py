"""How the sources of a language differ in their words, in whole numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .pieces import blocks_of
from .tables import Scratch, workers_find_package

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000
# Text bytes whose terms are counted together.
BLOCK_BYTES = 8 << 20
# Rows of groups and terms that a task sums before it passes them on.
HELD_ROWS = 400_000
# Occurrences whose product with SCALE a bigint holds.
BIGINT_TIMES = 9_000_000_000
# Steps of a value's natural logarithm.
STEPS = 64
# A group's terms are dealt over so many slices before they meet in one task.
SLICES = 32
GROUP = ["lang", "source"]
TERM = ["digest", "split"]

# ASCII letters become small ones and all other ASCII characters spaces; the bytes
# of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)
# Counts have no term; a row without a digest names a group, one without a group spells
# a digest.
_PARTS = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("digest", pa.int64()),
        ("term", pa.string()),
        ("times", pa.int64()),
        ("docs", pa.int64()),
    ]
)
_PARTS_DDL = "lang string, source string, digest bigint, term string, times bigint, docs bigint"


def term_digest(term: bytes) -> int:
    """XXH64 of a term's UTF-8 bytes as a signed number."""
    value = xxhash.xxh64_intdigest(term, 42)
    return value - (1 << 64) if value >> 63 else value


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The terms of all texts in a row, and the text that each stands in."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    folded = pa.py_buffer((data.to_pybytes() if data else b"").translate(_FOLD))
    folded = pa.LargeStringArray.from_buffers(len(texts), offsets, folded)
    parts = pc.ascii_split_whitespace(folded)
    many = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts)), many)
    words = parts.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    return doc[full.to_numpy(zero_copy_only=False)], words.filter(full).dictionary_encode()


def _numbered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The group (lang, source) of every row, and a row of every group."""
    codes = [batch.column(n).dictionary_encode() for n in GROUP]
    wide = max(len(codes[1].dictionary), 1)
    both = codes[0].indices.to_numpy().astype(np.int64) * wide + codes[1].indices.to_numpy()
    _, first, group = np.unique(both, return_index=True, return_inverse=True)
    return group, first


def _counted(
    part: pa.RecordBatch, digest: Callable[[bytes], int], spell: bool
) -> tuple[pa.Table, pa.Table]:
    """Counts per group and term, with a row that names each group; and the spelling of
    the terms. Counts have the term itself if ``spell``."""
    group, first = _numbered(part)
    doc, coded = _terms(part.column("text"))
    words = coded.dictionary.cast(pa.string())
    digests = np.fromiter(
        map(digest, coded.dictionary.cast(pa.large_binary()).to_pylist()), np.int64, len(words)
    )
    wide = max(len(words), 1)
    here = np.sort(doc * wide + coded.indices.to_numpy())
    head = np.flatnonzero(np.diff(here, prepend=-1))
    times = np.diff(head, append=len(here))
    in_group = group[here[head] // wide] * wide + here[head] % wide
    order = np.argsort(in_group, kind="stable")
    in_group, times = in_group[order], times[order]
    head = np.flatnonzero(np.diff(in_group, prepend=-1))
    row, code = first[in_group[head] // wide], in_group[head] % wide
    docs = np.diff(head, append=len(in_group))
    times = np.add.reduceat(times, head) if len(head) else times
    everyone = pa.array(np.concatenate([row, first]))
    none = len(first)
    counts = pa.Table.from_arrays(
        [
            *(part.column(n).take(everyone) for n in GROUP),
            pa.concat_arrays([pa.array(digests[code], pa.int64()), pa.nulls(none, pa.int64())]),
            pa.concat_arrays([words.take(pa.array(code)), pa.nulls(none, pa.string())])
            if spell
            else pa.nulls(len(everyone), pa.string()),
            pa.array(np.concatenate([times, np.zeros(none, dtype=np.int64)])),
            pa.array(np.concatenate([docs, np.zeros(none, dtype=np.int64)])),
        ],
        schema=_PARTS,
    )
    return counts, pa.table({"digest": digests, "term": words})


class _Held:
    """Rows of a task, summed or made distinct while ``HELD_ROWS`` are enough."""

    def __init__(self, keys: list[str], sums: list[str]):
        self.keys, self.sums = keys, sums
        self.tables: list[pa.Table] = []
        self.added = 0

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.tables.append(table.select([*self.keys, *self.sums]))
        self.added += table.num_rows
        if self.added > HELD_ROWS:
            self._merge()
            if self.tables[0].num_rows > HELD_ROWS:
                yield from self.rows()

    def _merge(self) -> None:
        whole = pa.concat_tables(self.tables).group_by(self.keys)
        whole = whole.aggregate([(name, "sum") for name in self.sums])
        names = [*self.keys, *(f"{name}_sum" for name in self.sums)]
        whole = whole.select(names).rename_columns([*self.keys, *self.sums])
        self.tables, self.added = [whole], 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.tables:
            self._merge()
            whole = self.tables.pop()
            columns = [
                whole.column(f.name) if f.name in whole.column_names
                else pa.nulls(whole.num_rows, f.type)
                for f in _PARTS
            ]
            yield from pa.Table.from_arrays(columns, schema=_PARTS).to_batches()


def _counting(digest: Callable[[bytes], int], spell: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [*GROUP, "digest", *(["term"] if spell else [])]
        counts, spelled = _Held(keys, ["times", "docs"]), _Held(["digest", "term"], [])
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for own in blocks_of(sizes, BLOCK_BYTES):
                found, words = _counted(batch.take(pa.array(own)), digest, spell)
                yield from counts.add(found)
                if not spell:
                    yield from spelled.add(words)
        yield from counts.rows()
        yield from spelled.rows()

    return count


def _share(times: str, total: str, kinds: str) -> Column:
    """1 + floor(SCALE * (times + 1) / (total + kinds)); null without kept terms.
    Whole numbers beyond a bigint are taken only for counts that need them."""
    whole = f"nullif({total} + {kinds}, 0L)"
    return F.expr(
        f"1L + CASE WHEN {times} < {BIGINT_TIMES}L THEN ({SCALE}L * ({times} + 1L)) div {whole}"
        f" ELSE (cast({SCALE} as decimal(10,0)) * (cast({times} as decimal(20,0)) + 1)) div {whole}"
        " END"
    )


def _excess(p: str, q: str) -> Column:
    """floor((p - q)^2 / q): shares stay near SCALE, so the square fits a bigint."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _spread(df: DataFrame) -> DataFrame:
    """A copy of every row for each slice."""
    return df.withColumn("slice", F.explode(F.array(*map(F.lit, range(SLICES)))))


def _sliced(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("slice", F.pmod(F.hash(*by), F.lit(SLICES)))


def _summed(counted: DataFrame, least_documents: int) -> DataFrame:
    """Sums per group and term, of the terms that their language keeps; with the
    language's sum, and one row of every term and language marked by ``leads``. Rows
    without ``lang`` or ``split`` are no counts and stay.

    All rows of a term and language are dealt to one task and stay there. A task sums
    what it counts before it is dealt, so it isn't summed again on the way.
    """
    sums = (
        counted.repartition("lang", "digest")
        .groupBy(*GROUP, *TERM)
        .agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    )
    same = W.partitionBy("digest", "lang", "split")
    sums = sums.select(
        *GROUP,
        *TERM,
        "times",
        F.sum("times").over(same).alias("lang_times"),
        F.sum("docs").over(same).alias("docs"),
        (F.min("source").over(same) == F.col("source")).alias("leads"),
    )
    kept = F.col("lang").isNull() | F.col("split").isNull() | (F.col("docs") >= least_documents)
    return sums.filter(kept).drop("docs")


def _kept(
    rows: DataFrame, least_documents: int, digest: Callable[[bytes], int], scratch: Scratch
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts per group and kept term, all groups, and the spelling of every digest.

    The parts are shuffled once: counts by digest alone (``split`` empty), spellings
    (``split``) without a group, and groups without ``split``, dealt by their own hash.
    A digest with several spellings stands for several terms; the texts' terms of such
    digests, as a rule none, are counted again with the term itself as ``split``.
    """
    parts = rows.mapInArrow(_counting(digest, False), _PARTS_DDL)
    split = F.when(F.col("lang").isNull(), F.col("term")).when(F.col("digest").isNotNull(), "")
    dealt = F.coalesce(F.col("digest"), F.xxhash64(*GROUP))
    parts = parts.select(
        *GROUP, dealt.alias("digest"), split.alias("split"), "times", "docs"
    )
    summed = scratch.put(_summed(parts, least_documents), "summed")
    spelled = summed.filter("lang is null").select("digest", F.col("split").alias("term"))
    groups = summed.filter("lang is not null and split is null").select(*GROUP)
    kept = summed.filter("lang is not null and split is not null")
    mixed = spelled.groupBy("digest").agg(F.count("*").alias("many")).filter("many > 1")
    mixed = scratch.put(mixed.select("digest"), "mixed")
    if not mixed.isEmpty():
        terms = rows.mapInArrow(_counting(digest, True), _PARTS_DDL).filter("times > 0")
        terms = terms.join(mixed, "digest", "left_semi").withColumnRenamed("term", "split")
        again = _summed(terms, least_documents)
        kept = kept.join(mixed, "digest", "left_anti").unionByName(again)
        kept = scratch.put(kept, "kept")
    return kept, groups, spelled


def _numbered_groups(groups: DataFrame, kept: DataFrame, scratch: Scratch) -> DataFrame:
    """Every group with its number ``own``, its sums and those of its language."""
    totals = kept.groupBy(*GROUP).agg(
        F.sum("times").alias("total"),
        F.count("*").alias("present"),
        F.count_if("leads").alias("leads"),
    )
    groups = groups.join(totals, GROUP, "left").na.fill(0)
    groups = groups.withColumn("own", F.monotonically_increasing_id())
    groups = scratch.put(groups, "numbered")
    langs = groups.groupBy("lang").agg(
        F.sum("leads").alias("kinds"), F.sum("total").alias("lang_total")
    )
    groups = groups.drop("leads").join(langs, "lang")
    return scratch.put(groups.withColumn("none", _share("0L", "total", "kinds")), "groups")


def _pairs(groups: DataFrame, weighed: DataFrame) -> DataFrame:
    """Value of every group for every other source of its language.

    A term that only one of two sources has depends on its count there and on the
    other source's share of terms without occurrence; one that both lack on two
    such shares. So sources meet by their distinct counts; only terms that both
    have are matched one by one, once for both directions, and their sums combine
    map-side. There is a row per two sources of a language, as that is the result.

    Shares of a group sum to SCALE and their number, so that all sums over its terms
    stay below some SCALE * SCALE: a bigint holds them.
    """
    sides = groups.select("lang", "own", "kinds", "present", "none")
    other = _spread(
        sides.select(
            "lang", F.col("own").alias("other"), F.col("none").alias("other_none"),
            F.col("present").alias("other_present"),
        )
    )
    two = _sliced(sides, "own").join(other, ["lang", "slice"]).filter("own <> other")
    lacking = two.select(
        "own",
        "other",
        F.expr("kinds - present - other_present").alias("both"),
        F.coalesce(_excess("none", "other_none"), F.lit(0)).alias("nones"),
        F.lit(0).cast("bigint").alias("value"),
    )
    counted = weighed.groupBy("lang", "own", "p", "none").agg(F.count("*").alias("many"))
    met = _sliced(counted, "own", "p").join(other, ["lang", "slice"]).filter("own <> other")
    met = met.groupBy("own", "other").agg(
        F.sum(F.col("many") * _excess("p", "other_none")).alias("there"),
        F.sum(F.col("many") * _excess("other_none", "p")).alias("back"),
        F.lit(0).cast("bigint").alias("both"),
    )
    # Both sides have the same columns in the same order, so that one shuffle serves both.
    one = weighed.select("digest", "split", "lang", "own", "p", "none")
    partner = one.toDF("digest", "split", "lang", "other", "q", "other_none")
    shared = one.join(partner, ["digest", "split", "lang"]).filter("own < other")
    shared = shared.groupBy("own", "other").agg(
        F.sum(_excess("p", "q") - _excess("p", "other_none") - _excess("none", "q")).alias("there"),
        F.sum(_excess("q", "p") - _excess("q", "none") - _excess("other_none", "p")).alias("back"),
        F.count("*").alias("both"),
    )
    ways = [
        F.struct(a.alias("own"), b.alias("other"), F.col(value).alias("value"))
        for a, b, value in (
            (F.col("own"), F.col("other"), "there"), (F.col("other"), F.col("own"), "back")
        )
    ]
    sums = met.unionByName(shared).select("both", F.explode(F.array(*ways)).alias("way"))
    sums = sums.select("way.*", "both", F.lit(0).cast("bigint").alias("nones"))
    values = lacking.unionByName(sums).groupBy("own", "other")
    wide = "decimal(38,0)"
    values = values.agg(
        (
            F.sum(F.col("value").cast(wide))
            + F.sum("both").cast("decimal(19,0)") * F.max("nones").cast("decimal(19,0)")
        ).cast("bigint").alias("value")
    )
    named = groups.select("own", *GROUP)
    items = groups.select(F.col("own").alias("other"), F.col("source").alias("item"))
    values = values.join(named, "own").join(items, "other")
    order = W.partitionBy("own").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order))


def _first_ranks(rows: DataFrame, order: list[Column], many: int) -> DataFrame:
    """The first ``many`` rows of every group with their ``rank``: first within each
    slice, so that a group of any size is a bounded number of rows in its last task."""
    within = W.partitionBy("own", "slice").orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= many)
    over = W.partitionBy("own").orderBy(*order)
    return first.withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= many)


def _top_terms(
    groups: DataFrame, weighed: DataFrame, spelled: DataFrame, ranks: int, scratch: Scratch
) -> DataFrame:
    """The terms of every group above its language, only the first ``ranks``.

    The rows of a group are counted by steps of their value's logarithm; the step that
    holds the last rank, and all above it, are sorted. Texts are joined to these
    rows alone, ties included, and decide among them.
    """
    above = weighed.filter("p > q").select("own", *TERM, _excess("p", "q").alias("value"))
    step = F.floor(F.log(F.col("value") + 1) * STEPS).cast("int")
    above = above.withColumn("step", step)
    higher = W.partitionBy("own").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, -1)
    bar = above.groupBy("own", "step").agg(F.count("*").alias("many"))
    bar = bar.withColumn("higher", F.coalesce(F.sum("many").over(higher), F.lit(0)))
    bar = bar.filter(F.col("higher") < ranks).groupBy("own").agg(F.min("step").alias("least"))
    reached = _sliced(above, *TERM).join(_spread(bar), ["own", "slice"]).filter("step >= least")
    reached = scratch.put(reached.drop("step", "least"), "reached")
    whole = reached.filter("split = ''").join(spelled, "digest")
    apart = reached.filter("split <> ''").withColumn("term", F.col("split"))
    named = whole.unionByName(apart).withColumnRenamed("term", "item")
    first = _first_ranks(named, [F.desc("value"), F.col("item")], ranks)
    return first.join(groups.select("own", *GROUP), "own")


def source_divergence(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    ranks: int = TERM_RANKS,
    digest: Callable[[bytes], int] = term_digest,
) -> DataFrame:
    """How every (lang, source) group differs from the language's other sources and
    from the language, by smoothed shares of the terms that the language keeps.

    Columns: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part
    "pair" has every other source with the divergence summed over all kept terms;
    part "term" the terms more frequent than in the language, the first ``ranks`` by
    their share of the divergence. Terms are runs of ASCII letters (large ones made
    small) and characters beyond ASCII; a language keeps those in at least
    ``least_documents`` of its rows. Null texts, languages and sources count as
    empty ones. A group without terms has pairs (value 0 if the language keeps no
    term) and no terms. Repeated rows each count; ties go by the item's UTF-8; an
    empty input gives an empty result; other columns play no part.

    Groups of any share of the rows are dealt over tasks by their terms' digests.
    """
    spark = df.sparkSession
    workers_find_package(spark)
    scratch = Scratch(spark, "divergence")
    rows = df.select(
        *(
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
            for c, n in ((lang, "lang"), (source, "source"), (text, "text"))
        )
    )
    kept, groups, spelled = _kept(rows, least_documents, digest, scratch)
    groups = _numbered_groups(groups, kept, scratch)
    scratch.drop("mixed", "numbered")
    sides = _spread(groups.drop("present"))
    weighed = _sliced(kept, *TERM).join(sides, [*GROUP, "slice"]).select(
        "lang",
        "own",
        *TERM,
        _share("times", "total", "kinds").alias("p"),
        "none",
        _share("lang_times", "lang_total", "kinds").alias("q"),
    )
    weighed = scratch.put(weighed, "weighed")
    scratch.drop("kept")
    pairs = _pairs(groups, weighed)
    terms = _top_terms(groups, weighed, spelled, ranks, scratch)
    found = [
        rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", "rank")
        for part, rows in (("pair", pairs), ("term", terms))
    ]
    return found[0].unionByName(found[1])
