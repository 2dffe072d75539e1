"""Best-fit packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, gapless_ranks, text_rows
from .tokens import encoder

CAPACITY = 2048
END_ID = 0


def pieces_of(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    if count <= capacity:
        return [(0, count)]
    rest = count % capacity
    cuts = [0, *range(rest or capacity, count + 1, capacity)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def token_pieces(
    rows: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of every row (row, doc_id, text): its ids, then the end id, cut at
    ``capacity``. With their ids as an array if ``with_ids``, else only the
    checksum of these as little-endian 32-bit numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_encoder = encoder(tokenizer)
        for batch in batches:
            out: dict[str, list] = defaultdict(list)
            texts = own_encoder.encode(batch.column("text"))
            for row, doc, ids in zip(
                batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts
            ):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for place, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    own = ids[start : start + length]
                    values = [row, doc, place, start, length, zlib.crc32(own.tobytes())]
                    if with_ids:
                        values.append(own)
                    for name, value in zip(schema.names, values):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in schema], schema=schema
            )
        # The worker may serve other stages next; they need the memory.
        own_encoder.forget()

    fields = [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
    ddl = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)
    return rows.select("row", "doc_id", "text").mapInArrow(cut, ddl)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of every length go, longest first.

    Pieces and gaps are sorted by length, and so many equal ones lie side by side
    that their run lengths say everything: at most ``capacity`` runs of pieces,
    whatever the input. In each step the run of pieces at hand sweeps to its
    successor, the smallest gap that holds one. Pieces and gaps of the two runs
    are matched by rank, one each; the gaps shrink; the pieces left over sweep on.
    Pieces without a successor open new sequences.

    Gives (length, first rank, pieces, first sequence, offset): the piece of rank
    first rank + i stands in sequence first sequence + i.
    """
    moves: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened = 0

    def add(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first, many = capacity, opened, left
            # A gap that holds several of them is filled before the next one.
            layers = min(gap // length, left)
            taken = min(many, left // layers)
            for layer in range(layers):
                moves.append((length, rank, taken, first, capacity - gap + layer * length))
                rank += taken
            left -= layers * taken
            add(gap - layers * length, first, taken)
            if first == opened:
                opened += taken
            else:
                add(gap, first + taken, many - taken)
    return moves


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every row with its place in a sequence.

    Columns: key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` (and ``ids``). A null or empty text is one piece that holds the end
    id alone. Repeated rows are packed each on its own; null keys stay null. An
    empty input gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "packing")
    rows = text_rows(df, text, key).withColumn("row", F.monotonically_increasing_id())
    pieces = scratch.put(token_pieces(rows, tokenizer, capacity, with_ids), "pieces")
    # One count per length: at most ``capacity`` rows.
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    moves = df.sparkSession.createDataFrame(
        best_fit(counts, capacity),
        "length bigint, first_rank bigint, many bigint, first_sequence bigint, offset bigint",
    )
    light = [c for c in pieces.columns if c != "ids"]
    ranked = gapless_ranks(pieces.select(light), ["length"], ["row", "piece"], "packing")
    # The runs are bounded by the capacity, so the table of moves is too.
    held = (F.col("rank") >= F.col("first_rank")) & (
        F.col("rank") < F.col("first_rank") + F.col("many")
    )
    placed = (
        ranked.join(F.broadcast(moves), "length")
        .filter(held)
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
    )
    if with_ids:
        placed = placed.join(pieces.select("row", "piece", "ids"), ["row", "piece"])
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
        *(["ids"] if with_ids else []),
    )
