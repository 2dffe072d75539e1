"""Exact nearest vectors by inner product from a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import Scratch

SCALE = 256
# One cell number of a component takes one byte.
CELLS = 256
# Query vectors that are held against the whole file in one pass, and their bytes.
QUERY_BLOCK = 8192
QUERY_BYTES = 64 << 20
# The candidates of a query are dealt over so many slices.
SLICES = 16
# Scores beyond a bigint become its ends.
LARGEST = 2**63 - 1
# Cells of a score matrix that are computed at once.
MATRIX = 1 << 22


def scaled(values: pa.Array) -> list[np.ndarray | None]:
    """floor(SCALE * x) of every vector, or None for one that takes no part."""
    out: list[np.ndarray | None] = []
    for value in values:
        items = value.as_py()
        if items is None or any(x is None for x in items):
            out.append(None)
            continue
        vector = np.floor(SCALE * np.array(items, dtype=np.float64))
        out.append(vector + 0.0 if np.isfinite(vector).all() else None)
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = scaled(batch.column("embedding"))
        kept = [i for i, v in enumerate(vectors) if v is not None]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(pa.array(kept, pa.int64())),
                batch.column("vec_id").take(pa.array(kept, pa.int64())),
                pa.array([len(vectors[i]) for i in kept], pa.int32()),
                pa.array([vectors[i].astype("<f8").tobytes() for i in kept], pa.binary()),
            ],
            names=["row", "vec_id", "size", "vector"],
        )


def _matrices(batch: pa.RecordBatch):
    """(size, rows of that size, matrix) for the vectors of a batch."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        part = batch.take(pa.array(own))
        raw = b"".join(part.column("vector").to_pylist())
        yield int(size), part, np.frombuffer(raw, dtype="<f8").reshape(len(own), int(size))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low: dict[int, np.ndarray] = {}
    high: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, _, matrix in _matrices(batch):
            low[size] = np.minimum(low.get(size, np.inf), matrix.min(axis=0))
            high[size] = np.maximum(high.get(size, -np.inf), matrix.max(axis=0))
    rows = [(s, d, float(low[s][d]), float(high[s][d])) for s in low for d in range(s)]
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["size", "place", "low", "high"]
    )


def grid(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every vector size the lower end and the cell width of each component.

    The driver receives one row per size and component, however many vectors.
    """
    found = (
        vectors.mapInArrow(_ranges, "size int, place int, low double, high double")
        .groupBy("size", "place")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("size", "place")
        .collect()
    )
    out = {0: (np.zeros(0), np.zeros(0))}  # empty vectors meet only their like
    for size in {r.size for r in found}:
        low = np.array([r.low for r in found if r.size == size])
        high = np.array([r.high for r in found if r.size == size])
        out[size] = (low, (high - low) / CELLS)
    return out


def approximated(vectors: DataFrame, cells: dict) -> DataFrame:
    """(entry, size, cells): the approximation file, one byte per component."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part, matrix in _matrices(batch):
                low, width = cells[size]
                safe = np.where(width > 0, width, 1.0)
                number = np.clip((matrix - low) / safe, 0, CELLS - 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("entry"),
                        part.column("size"),
                        pa.array([row.tobytes() for row in number], pa.binary()),
                    ],
                    names=["entry", "size", "cells"],
                )

    return vectors.select("entry", "size", "vector").mapInArrow(
        quantise, "entry bigint, size int, cells binary"
    )


class _Best:
    """The entries that may be among the best of some queries of one size."""

    def __init__(self, numbers: np.ndarray, queries: np.ndarray, low, width, wanted: int):
        self.numbers, self.queries, self.wanted = numbers, queries, wanted
        self.low, self.width = low, width
        # Every vector lies within half a cell of its cell's middle, so its score
        # lies within this distance of the middle's. The small addend covers rounding.
        reach = np.abs(queries) @ (width / 2)
        top = np.maximum(np.abs(low), np.abs(low + CELLS * width))
        self.reach = reach + 1e-12 * (1 + np.abs(queries) @ top) * (1 + len(low))
        self.best = np.full((0, len(queries)), -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, entries: np.ndarray, cells: np.ndarray) -> None:
        middles = self.low + (cells + 0.5) * self.width
        scores = middles @ self.queries.T
        both = np.concatenate([self.best, scores])
        if len(both) > self.wanted:
            both = np.partition(both, len(both) - self.wanted, axis=0)[-self.wanted :]
        self.best = both
        row, query = np.nonzero(scores >= self._least())
        self.held.append((query, entries[row], scores[row, query]))
        if sum(len(q) for q, _, _ in self.held) > MATRIX:
            self._sift()

    def _least(self) -> np.ndarray:
        if len(self.best) < self.wanted:
            return np.full(len(self.queries), -np.inf)
        return self.best.min(axis=0) - 2 * self.reach

    def _sift(self) -> None:
        query, entry, score = (np.concatenate(x) for x in zip(*self.held))
        keep = score >= self._least()[query]
        self.held = [(query[keep], entry[keep], score[keep])]

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._sift()
            query, entry, score = self.held[0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.numbers[query]),
                    pa.array(entry),
                    pa.array(score - self.reach[query]),
                    pa.array(score + self.reach[query]),
                ],
                names=["query", "entry", "least", "most"],
            )


def _bounded(file: DataFrame, block: list[tuple], cells: dict, wanted: int) -> DataFrame:
    """(query, entry, least, most): bounds of the scores that may be among the best.

    Each task reads its part of the file once, for all queries of the block.
    """
    shared = file.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = []
        by_size: dict[int, list] = {}
        for number, size, raw in shared.value:
            by_size.setdefault(size, []).append((number, np.frombuffer(raw, dtype="<f8")))
        for size, own in by_size.items():
            for at in range(0, len(own), 1024):
                part = own[at : at + 1024]
                numbers = np.array([n for n, _ in part], dtype=np.int64)
                matrix = np.stack([v for _, v in part])
                best.append((size, _Best(numbers, matrix, *cells[size], wanted)))
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                step = max(1, MATRIX // 1024)
                for at in range(0, len(rows), step):
                    part = batch.take(pa.array(rows[at : at + step]))
                    raw = b"".join(part.column("cells").to_pylist())
                    matrix = np.frombuffer(raw, np.uint8).reshape(part.num_rows, int(size))
                    entries = part.column("entry").to_numpy()
                    for of, one in best:
                        if of == size:
                            one.add(entries, matrix)
        for _, one in best:
            yield from one.rows()

    return file.mapInArrow(scan, "query bigint, entry bigint, least double, most double")


def _dot(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, dtype="<f8"), np.frombuffer(b, dtype="<f8")
    if float(np.abs(x) @ np.abs(y)) < 2.0**53:
        return int(x @ y)
    return sum(int(p) * int(q) for p, q in zip(x, y))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [
            _dot(a, b)
            for a, b in zip(batch.column("asked").to_pylist(), batch.column("vector").to_pylist())
        ]
        within = [min(max(s, -LARGEST - 1), LARGEST) for s in scores]
        # Zero unless the score is beyond a bigint: these rank by their double.
        beyond = [float(s) if s != w else 0.0 for s, w in zip(scores, within)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("query"),
                batch.column("entry"),
                pa.array(within, pa.int64()),
                pa.array(beyond, pa.float64()),
            ],
            names=["query", "entry", "score", "beyond"],
        )


def _scored(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    vectors = entries.select("entry", "vector")
    asked = vectors.select(F.col("entry").alias("query"), F.col("vector").alias("asked"))
    return (
        pairs.select("query", "entry")
        .join(asked, "query")
        .join(vectors, "entry")
        .mapInArrow(_exact, "query bigint, entry bigint, score bigint, beyond double")
    )


def _blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """The queries in blocks of bounded number and size; the driver holds one."""
    block, held = [], 0
    for row in queries.select("entry", "size", "vector").toLocalIterator():
        if block and (len(block) == QUERY_BLOCK or held + len(row.vector) > QUERY_BYTES):
            yield block
            block, held = [], 0
        block.append((row.entry, row.size, bytes(row.vector)))
        held += len(row.vector)
    if block:
        yield block


def _best(rows: DataFrame, many: int, *order: Column) -> DataFrame:
    """The first ``many`` rows of every query, with their ``place``. Spark cuts each
    task's rows before the shuffle, so a query of many candidates brings few."""
    over = W.partitionBy("query").orderBy(*order)
    return rows.withColumn("place", F.row_number().over(over)).filter(F.col("place") <= many)


def _with_bar(rows: DataFrame, bars: DataFrame) -> DataFrame:
    """Rows (query, entry) with their query's bar, null without one; a query of many
    rows is dealt over slices."""
    sliced = rows.withColumn("slice", F.pmod("entry", F.lit(SLICES)))
    every = bars.withColumn("slice", F.explode(F.array(*map(F.lit, range(SLICES)))))
    return sliced.join(every, ["query", "slice"], "left").drop("slice")


def nearest(
    df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of the highest integer inner product for every query row.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. A component x
    counts as floor(256 x). Ties go to the smaller key, null keys last. A query row
    never finds itself, but does find its copies. Fewer rows give fewer results. A
    vector that is null or holds a null or non-finite component takes no part;
    vectors of different lengths don't meet. ``is_query`` is a condition on the key.

    Equal vectors are one entry of the file. It names the k + 1 first of them by
    key, as no query can need more; copies, however many, don't meet as pairs. A
    score beyond a bigint is given as the bigint's end; such scores rank by their
    double among themselves. The
    file is scanned once per block of queries for bounds; exact vectors are then
    read in the order of their bounds, first the best few, then the rest that the
    kth exact score doesn't rule out.
    """
    wanted = k + 1
    scratch = Scratch(df.sparkSession, "vafile")
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("embedding"),
    )
    vectors = scratch.put(
        rows.mapInArrow(_vectors, "row bigint, vec_id bigint, size int, vector binary"), "vectors"
    )
    first = W.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    entries = scratch.put(
        vectors.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= wanted)
        .groupBy("vector", "size")
        .agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "row"))).alias("members"))
        .withColumn("entry", F.monotonically_increasing_id()),
        "entries",
    )
    asking = scratch.put(
        vectors.filter(is_query)
        .select("row", "vec_id", "vector")
        .join(entries.select("entry", "vector"), "vector")
        .select("row", "vec_id", F.col("entry").alias("query")),
        "asking",
    )
    cells = grid(entries.select("size", "vector"))
    file = scratch.put(approximated(entries, cells), "file")
    asked = entries.join(asking.select(F.col("query").alias("entry")).distinct(), "entry", "semi")
    schema = "query bigint, entry bigint, least double, most double"
    for place, block in enumerate(_blocks(asked)):
        scratch.put(_bounded(file, block, cells, wanted), f"bounds/block={place}")
    bounds = scratch.written("bounds", schema)
    # The lower bounds of the best few rule out whatever lies below them for sure.
    sure = _best(bounds, wanted, F.col("least").desc()).filter(F.col("place") == wanted)
    sure = sure.select("query", F.col("least").alias("sure"))
    able = _with_bar(bounds, sure).filter("sure is null or most >= sure").drop("sure")
    able = scratch.put(able, "able")
    first_few = _best(able, 2 * wanted, F.col("most").desc(), F.col("entry"))
    early = scratch.put(_scored(first_few, entries), "early")
    reached = _best(early, wanted, F.col("score").desc()).filter(F.col("place") == wanted)
    reached = reached.select("query", F.col("score").alias("reached"))
    rest = _with_bar(able, reached).filter("reached is not null and most >= reached")
    rest = rest.join(early.select("query", "entry"), ["query", "entry"], "left_anti")
    late = _scored(rest, entries)
    found = (
        early.union(late)
        .join(entries.select("entry", F.explode("members").alias("member")), "entry")
        .select("query", "score", "beyond", "member.vec_id", F.col("member.row").alias("other"))
    )
    order = [
        F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id").asc_nulls_last(), F.col("other"),
    ]
    few = _best(found, wanted, *order).drop("place")
    own = asking.select("query", F.col("row").alias("own"), F.col("vec_id").alias("query_id"))
    each = W.partitionBy("own").orderBy(*order)
    return (
        own.join(few, "query")
        .filter("own <> other")
        .withColumn("rank", F.row_number().over(each))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
