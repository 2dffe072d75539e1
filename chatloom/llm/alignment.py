"""Alignment of the tokens of two published tokenizers over a corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceEncoder, blocks_of, piece_encoder
from .tables import Scratch, packed_batch, unpacked_batch, workers_find_package
from .tokens import Encoder, encoder

# Text bytes whose pairs share one dictionary.
BLOCK_BYTES = 16 << 20
# Documents of a block, however short.
BLOCK_DOCS = 1 << 16
# A pair as one number: the A id above, the B id below.
_SHIFT = 20
_B_MASK = (1 << _SHIFT) - 1
# A document of a block and a pair as one number.
_DOC_SHIFT = 42

_DOCS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("codes", pa.large_list(pa.int32())),
        ("times", pa.large_list(pa.int32())),
    ]
)
# kind 0: the documents of a block; 1: an irregular pair of a block, with its place in
# the block's dictionary; 2: how often a task linked an A id with its own B id.
_PARTS = pa.schema(
    [
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("docs", pa.binary()),
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("place", pa.int32()),
        ("times", pa.int64()),
    ]
)
_PARTS_DDL = "kind int, block bigint, docs binary, a int, b int, place int, times bigint"


class Aligner:
    """Groups and links of texts under a byte-level tokenizer A and a model B."""

    def __init__(self, a_path: str, b_path: str):
        self.a: Encoder = encoder(a_path, special=False)
        self.b: PieceEncoder = piece_encoder(b_path)
        self.a_bytes = self.a.surfaces()
        self.b_bytes = self.b.surfaces
        self.a_widths = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_widths = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.identity = self._identity()
        self.a_inner, self.a_last = _named(len(self.a_bytes), ","), _named(len(self.a_bytes), "|")
        self.b_inner, self.b_last = _named(len(self.b_bytes), ","), _named(len(self.b_bytes), ";")

    def _identity(self) -> np.ndarray:
        """The B id with the same bytes for every A id, or -1.

        Where a byte and a piece have the same bytes the piece counts, as the model
        falls back to bytes only for characters without a piece. Pairs with the
        other one are irregular and are counted like all such.
        """
        own: dict[bytes, int] = {}
        for number in np.argsort(~self.b.is_byte, kind="stable").tolist():
            if self.b_bytes[number] and not self.b.is_control[number] and number != self.b.unknown:
                own[self.b_bytes[number]] = number
        return np.array([own.get(t, -1) for t in self.a_bytes], dtype=np.int64)

    def forget(self) -> None:
        self.a.forget()
        self.b.forget()

    def tokens(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A and B ids of every text; none where the text is empty or where the
        tokens' bytes don't spell a space and the text."""
        texts = texts.cast(pa.large_string())
        none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.binary_join_element_wise(none, texts, space)
        of_a = self.a.encode(spaced)
        flat, bounds = self.b.flat(texts)
        of_b = [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
        for i, text in enumerate(spaced.cast(pa.large_binary()).to_pylist()):
            whole = (
                len(text) > 1
                and b"".join(map(self.a_bytes.__getitem__, of_a[i].tolist())) == text
                and b"".join(map(self.b_bytes.__getitem__, of_b[i].tolist())) == text
            )
            if not whole:
                of_a[i] = of_b[i] = flat[:0]
        return of_a, of_b

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | list]:
        """Counts and group digests per text, and all links: their text and ids.

        ``simple`` marks the links of groups of one token each with the same bytes.
        """
        of_a, of_b = self.tokens(texts)
        n_a = np.array(list(map(len, of_a)), dtype=np.int64)
        n_b = np.array(list(map(len, of_b)), dtype=np.int64)
        a = np.concatenate([np.zeros(0, np.int64), *of_a]).astype(np.int64)
        b = np.concatenate([np.zeros(0, np.int64), *of_b]).astype(np.int64)
        # Both sides of a text have the same bytes, so offsets into all texts agree.
        ends_a, ends_b = np.cumsum(self.a_widths[a]), np.cumsum(self.b_widths[b])
        at_b = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[np.minimum(at_b, len(b) - 1)] == ends_a) if len(b) else at_b
        last_b = at_b[last_a]
        doc = np.repeat(np.arange(len(texts)), n_a)[last_a]
        alone = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        link_a, link_b = a[last_a], b[last_b]
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(doc, minlength=len(texts)),
            "groups_sha256": self._digests(a, b, n_a, n_b, last_a, last_b),
            "doc": doc,
            "a": link_a,
            "b": link_b,
            "simple": alone & (self.identity[link_a] == link_b),
        }

    def _digests(self, a, b, n_a, n_b, last_a, last_b) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; empty without tokens."""
        words = np.empty(len(a) + len(b), dtype=object)
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        # The A tokens of a group stand behind the B tokens of the groups before.
        at_a = np.arange(len(a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)
        at_b = np.arange(len(b)) + np.repeat(np.cumsum(sizes_a), sizes_b)
        words[at_a] = self.a_inner[a]
        words[at_b] = self.b_inner[b]
        words[at_a[last_a]] = self.a_last[a[last_a]]
        words[at_b[last_b]] = self.b_last[b[last_b]]
        ends = np.cumsum(n_a + n_b).tolist()
        return [
            hashlib.sha256("".join(words[x:y])[:-1].encode()).hexdigest() if y > x else ""
            for x, y in zip([0, *ends[:-1]], ends)
        ]


def _named(count: int, mark: str) -> np.ndarray:
    return np.array([f"{i}{mark}" for i in range(count)], dtype=object)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per pair of files and Python worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.diff(first, append=len(values))


class _Block:
    """Documents gathered until their texts reach ``BLOCK_BYTES``."""

    def __init__(self, own: Aligner):
        self.own = own
        self.size = 0
        self.docs: list[dict] = []
        self.links: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.many = 0

    def add(self, keys: pa.Array, texts: pa.Array, size: int) -> np.ndarray:
        """Take texts in; gives the A ids of their simple links."""
        got = self.own.align(texts)
        # An A id, or an irregular pair beyond all A ids.
        pair = np.where(got["simple"], got["a"], ((got["a"] + 1) << _SHIFT) | got["b"])
        value, times = _counted(((got["doc"] + self.many) << _DOC_SHIFT) | pair)
        self.links.append(value)
        self.counts.append(times)
        self.docs.append({name: got[name] for name in ("n_a", "n_b", "n_groups", "groups_sha256")})
        self.docs[-1]["doc_id"] = keys
        self.many += len(texts)
        self.size += size
        return got["a"][got["simple"]]

    def parts(self, number: int) -> Iterator[pa.RecordBatch]:
        value, times = np.concatenate(self.links), np.concatenate(self.counts)
        pair = value & ((1 << _DOC_SHIFT) - 1)
        # Ids stay below 2^20, so a pair is an A id alone only below that.
        strange = pair > _B_MASK
        known, code = np.unique(pair[strange], return_inverse=True)
        seen = np.bincount(code, times[strange], minlength=len(known)).astype(np.int64)
        base = len(self.own.a_bytes)
        pair[strange] = base + code
        ends = np.searchsorted(value >> _DOC_SHIFT, np.arange(self.many + 1))

        def listed(values: np.ndarray) -> pa.Array:
            return pa.LargeListArray.from_arrays(
                pa.array(ends, pa.int64()), pa.array(values.astype(np.int32))
            )

        def joined(name: str) -> pa.Array:
            return pa.concat_arrays(
                [pa.array(d[name], _DOCS.field(name).type) for d in self.docs]
            )

        names = ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
        docs = pa.RecordBatch.from_arrays(
            [*map(joined, names), listed(pair), listed(times)], schema=_DOCS
        )
        yield _rows(0, number, docs=[packed_batch(docs)])
        yield _rows(
            1, number, a=(known >> _SHIFT) - 1, b=known & _B_MASK, place=np.arange(len(known)), times=seen
        )


def _rows(kind: int, block: int, **columns) -> pa.RecordBatch:
    many = len(next(iter(columns.values())))
    columns = {"kind": [kind] * many, "block": [block] * many, **columns}
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(many, f.type)
            for f in _PARTS
        ],
        schema=_PARTS,
    )


def _in_parts(a_path: str, b_path: str):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        same = np.zeros(len(own.a_bytes), dtype=np.int64)
        block = _Block(own)
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for at in blocks_of(sizes):
                part = batch.take(pa.array(at))
                size = int(sizes[at].sum(dtype=np.int64))
                full = block.size + size > BLOCK_BYTES or block.many + len(at) > BLOCK_DOCS
                if block.many and full:
                    yield from block.parts(number)
                    block, number = _Block(own), number + 1
                simple = block.add(part.column("doc_id"), part.column("text"), size)
                same += np.bincount(simple, minlength=len(same))
        if block.many:
            yield from block.parts(number)
        linked = np.flatnonzero(same)
        yield _rows(2, -1, a=linked, times=same[linked])
        # The worker may serve other stages next; they need the memory.
        own.forget()

    return parts


def _vector(size: int, rows: list, name: str) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    for row in rows:
        out[row[0]] = row[name]
    return out


def align_tokens(
    df: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Alignment of every text's A and B tokens, weighed by counts over all texts.

    A encodes a space and the text, B the text (its model adds the space). Common
    token ends cut both into groups; a link joins the A and the B token that end
    together. Columns: ``doc_id`` (the key), ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose count over all texts is the highest of their
    B id), ``count_sum`` and ``groups_sha256``.

    Texts that are null or empty, or whose bytes the tokens don't give back, have
    zeros and an empty digest, and count nowhere. Repeated rows each count and give
    a row; null keys stay null; an empty input gives an empty result. Other columns
    play no part.

    A group of one token each with the same bytes is known by its A id alone, as
    its B id is a fixed array's entry. These are counted in a vector per task, and
    the driver sums at most one row per A id. Only other pairs are shuffled, once
    per block of ``BLOCK_BYTES`` of texts; the counts over all texts come back per
    block, where documents wait as codes into the block's dictionary.
    """
    spark = df.sparkSession
    workers_find_package(spark)
    scratch = Scratch(spark, "alignment")
    rows = df.select(
        F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    parts = scratch.put(rows.mapInArrow(_in_parts(a_path, b_path), _PARTS_DDL), "parts")
    strange = parts.filter("kind = 1").select("block", "a", "b", "place", "times")
    pairs = scratch.put(strange.groupBy("a", "b").agg(F.sum("times").alias("count")), "pairs")

    # Vectors of a vocabulary's length: bounded, however large the input is.
    own = aligner(a_path, b_path)
    same = parts.filter("kind = 2").groupBy("a").agg(F.sum("times").alias("count")).collect()
    same = _vector(len(own.a_bytes), same, "count")
    best = pairs.groupBy("b").agg(F.max("count").alias("best")).collect()
    best = _vector(len(own.b_bytes), best, "best")
    fixed = own.identity >= 0
    np.maximum.at(best, own.identity[fixed], same[fixed])
    same_best = fixed & (same == best[np.where(fixed, own.identity, 0)])
    shared = spark.sparkContext.broadcast((same, same_best, best))

    def weigh(docs: pa.Table, entries: pa.Table) -> pa.Table:
        same, same_best, best = shared.value
        counts = np.zeros(len(same) + entries.num_rows, dtype=np.int64)
        tops = np.zeros(len(counts), dtype=bool)
        counts[: len(same)], tops[: len(same)] = same, same_best
        at = len(same) + entries.column("place").to_numpy()
        counts[at] = entries.column("count").to_numpy()
        tops[at] = counts[at] == best[entries.column("b").to_numpy()]
        out = []
        for packed in docs.column("docs"):
            part = unpacked_batch(packed.as_py())
            codes = part.column("codes")
            doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(codes).to_numpy())
            code = codes.flatten().to_numpy()
            times = part.column("times").flatten().to_numpy().astype(np.int64)
            sums = np.zeros((3, part.num_rows), dtype=np.int64)
            np.add.at(sums[0], doc, times)
            np.add.at(sums[1], doc, times * tops[code])
            np.add.at(sums[2], doc, times * counts[code])
            out.append(
                pa.table(
                    [
                        *(part.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups")),
                        *map(pa.array, sums),
                        part.column("groups_sha256"),
                    ],
                    names=_RESULT,
                )
            )
        return pa.concat_tables(out) if out else _EMPTY

    waiting = parts.filter("kind = 0").select(F.col("block").alias("own"), "docs")
    known = strange.join(pairs, ["a", "b"]).select("block", "place", "b", "count")
    return waiting.groupBy("own").cogroup(known.groupBy("block")).applyInArrow(weigh, _RESULT_DDL)


_RESULT = [
    "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
]
_RESULT_DDL = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'bigint'}" for n in _RESULT)
_EMPTY = pa.table(
    {n: pa.array([], pa.string() if n == "groups_sha256" else pa.int64()) for n in _RESULT}
)
