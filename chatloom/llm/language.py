"""Language-model scores of texts by the lattice of a published subword vocabulary."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lattice import Lattice, vocabulary
from .tables import Scratch, packed_batch, text_rows

# One text in so many is held out from learning.
FOLDS = 10
SMOOTHING = 0.1
# Pseudo-counts that the vocabulary's own weights have against the corpus.
PRIOR = 1000.0
# Text bytes whose words share one dictionary.
BLOCK_BYTES = 16 << 20
# Words that are segmented together.
WORDS_AT_ONCE = 20_000


def held_out(key: Column) -> Column:
    """Rows that the model may not learn from; a null key counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


_DOCS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("words", pa.large_list(pa.int32())),
        ("counts", pa.large_list(pa.int32())),
    ]
)
_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("docs", pa.binary()),
        ("word", pa.string()),
        ("place", pa.int32()),
        ("seen", pa.int64()),
    ]
)
_BLOCK_DDL = "block bigint, docs binary, word string, place int, seen bigint"


def _block(number: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One row (place -1) with the word numbers of all texts, and one per distinct word."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(part.column("text").cast(pa.large_string())))
    texts = len(lists)
    doc = np.repeat(
        np.arange(texts, dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    )
    values = lists.flatten()
    del lists
    full = pc.greater(pc.binary_length(values), 0)
    doc = doc[full.to_numpy(zero_copy_only=False)]
    coded = values.filter(full).dictionary_encode()
    del values
    words, size = coded.dictionary, max(len(coded.dictionary), 1)
    key, count = np.unique(doc.astype(np.int64) * size + coded.indices, return_counts=True)
    del coded
    doc, code = key // size, key % size
    held = part.column("held_out").to_numpy(zero_copy_only=False)
    seen = np.bincount(code, np.where(held[doc], 0, count), minlength=len(words))
    ends = np.searchsorted(doc, np.arange(texts + 1))

    def listed(values: np.ndarray) -> pa.Array:
        return pa.LargeListArray.from_arrays(
            pa.array(ends, pa.int64()), pa.array(values.astype(np.int32))
        )

    docs = pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("held_out"), listed(code), listed(count)], schema=_DOCS
    )
    texts = {"block": number, "docs": packed_batch(docs), "word": "", "place": -1, "seen": 0}
    yield pa.RecordBatch.from_pylist([texts], schema=_BLOCK)
    n = len(words)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, number), pa.int64()),
            pa.array([b""] * n, pa.binary()),
            words.cast(pa.string()),
            pa.array(np.arange(n), pa.int32()),
            pa.array(seen[:n].astype(np.int64), pa.int64()),
        ],
        schema=_BLOCK,
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts: batches are gathered up to ``BLOCK_BYTES``."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        turn = (size + np.cumsum(sizes, dtype=np.int64)) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(turn, prepend=0))), batch.num_rows]
        for place, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if place and held:
                yield from _block(number, _joined(held))
                held, size, number = [], 0, number + 1
                pa.default_memory_pool().release_unused()
            if b > a:
                # Copied, since kernels don't heed the offset of a slice everywhere.
                held.append(batch.take(pa.array(np.arange(a, b))))
                size += int(sizes[a:b].sum(dtype=np.int64))
    if held:
        yield from _block(number, _joined(held))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of many words each, as a call for few words costs as much."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= WORDS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def refitted(prior: dict[str, float], counts: dict[str, float]) -> dict[str, float]:
    """Weights of pieces by their expected counts, the prior's as pseudo-counts."""
    total = sum(counts.values()) + PRIOR
    return {p: (counts.get(p, 0.0) + PRIOR * w) / total for p, w in prior.items()}


def _learned(words: DataFrame, prior: dict[str, float]) -> dict[str, float]:
    """The weights of pieces that the training words tell: one step of expectation and
    maximisation. A word counts once however often it occurs, as the pieces have to
    spell the new words. The driver receives one row per piece of the vocabulary.
    """
    shared = words.sparkSession.sparkContext.broadcast({p: math.log(w) for p, w in prior.items()})

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value)
        counts = np.zeros(len(lattice.pieces))
        for table in _gathered(batches):
            counts += lattice.expected(table.column("word").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lattice.pieces, pa.string()), pa.array(counts)], names=["piece", "times"]
        )

    pieces = words.filter("seen > 0").select("word").mapInArrow(expected, "piece string, times double")
    found = pieces.groupBy("piece").agg(F.sum("times").alias("times")).collect()
    return refitted(prior, {row.piece: row.times for row in found})


def mixed(new: float, share: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log10 of (1 - new) * share + new * 10 ** other, also where the power is below a double."""
    with np.errstate(divide="ignore"):
        own = np.log((1 - new) * np.asarray(share, dtype=float))
    return np.logaddexp(own, math.log(new) + np.asarray(other) * math.log(10)) / math.log(10)


def _weighed(words: DataFrame, logs: dict[str, float]) -> DataFrame:
    """(word, seen, weight): log10 of the sum over all segmentations of the word."""
    shared = words.sparkSession.sparkContext.broadcast(logs)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value)
        for table in _gathered(batches):
            words = table.column("word").combine_chunks()
            weights = lattice.marginals(words.to_pylist()) / math.log(10)
            yield from pa.table(
                [words, table.column("seen"), pa.array(weights)], names=["word", "seen", "weight"]
            ).to_batches()

    return words.select("word", "seen").mapInArrow(weigh, "word string, seen bigint, weight double")


def language_scores(
    df: DataFrame,
    vocabulary_path: str,
    text: str = "text",
    key: str = "doc_id",
    learned: bool = False,
) -> DataFrame:
    """Log10 probabilities of whole texts.

    Columns: key, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (of
    these seen in training texts), ``train_tokens``, ``base_score`` (single words,
    smoothed by 0.1) and ``score`` (lattice). Null and empty texts are the end
    alone. Repeated rows each count and each give a row; null keys are held out.
    Without training texts every token has base probability 1, and an end, which has
    the share of ends among the training tokens, probability 1/2.

    The vocabulary's own weights weigh the segmentations of a word; they are not
    fitted to the corpus. What is learned is how often a text ends. With ``learned`` the
    weights are those that the training words tell, and a token's probability is
    (1 - new) times its share of the training tokens plus ``new`` times that of the
    lattice; ``new`` is kinds / (tokens + kinds) of the training texts (Witten and Bell).

    Words don't cross white space, so the sum over the segmentations of a text is
    the product of those of its words. Every distinct word is weighed once. Texts
    are handled in blocks with a dictionary each; only dictionaries are joined
    with the counts of the corpus, and each block gets its own entries back.
    """
    scratch = Scratch(df.sparkSession, "language")
    rows = text_rows(df, text, key).withColumn("held_out", held_out(F.col("doc_id")))
    blocks = scratch.put(rows.mapInArrow(_blocks, _BLOCK_DDL), "blocks")
    entries = blocks.filter("place >= 0").select("block", "word", "place", "seen")
    words = scratch.put(entries.groupBy("word").agg(F.sum("seen").alias("seen")), "words")
    told = words.agg(F.sum("seen"), F.count_if(F.col("seen") > 0)).first()
    ends = rows.filter(~F.col("held_out")).count()
    total, kinds = (told[0] or 0) + ends, told[1] + (ends > 0)
    share = (ends + SMOOTHING) / (total + 2 * SMOOTHING)
    end, onward = math.log10(share), math.log10(1 - share)
    weights = vocabulary(vocabulary_path)
    if learned:
        weights = _learned(words, weights)
    new = kinds / (total + kinds) if learned and total else 1.0
    logs = {piece: math.log(weight) for piece, weight in weights.items()}
    weighed = scratch.put(_weighed(words, logs), "weighed")
    last = float(mixed(new, ends / max(total, 1), end))
    scale = total + SMOOTHING * (kinds + 1)
    known = entries.drop("seen").join(weighed, "word").select("block", "place", "seen", "weight")

    def score(docs: pa.Table, own: pa.Table) -> pa.Table:
        size = own.num_rows
        place = own.column("place").to_numpy()
        seen, weight = np.zeros(size), np.zeros(size)
        seen[place] = own.column("seen").to_numpy()
        weight[place] = own.column("weight").to_numpy() + onward
        weight = mixed(new, seen / max(total, 1), weight)
        base = np.log10((seen + SMOOTHING) / scale)
        parts = []
        for packed in docs.column("docs"):
            part = pa.ipc.open_stream(packed.as_py()).read_all().combine_chunks()
            n = part.num_rows
            lengths = pc.list_value_length(part.column("words")).to_numpy()
            doc = np.repeat(np.arange(n), lengths)
            code = part.column("words").combine_chunks().flatten().to_numpy()
            count = part.column("counts").combine_chunks().flatten().to_numpy()

            def summed(values: np.ndarray, doc=doc, count=count, n=n) -> np.ndarray:
                return np.bincount(doc, values * count, minlength=n)

            tokens = summed(np.ones(len(code))) + 1
            parts.append(
                pa.table(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(tokens.astype(np.int64)),
                        pa.array((summed(seen[code] > 0) + (ends > 0)).astype(np.int64)),
                        pa.array(np.full(n, total), pa.int64()),
                        pa.array(summed(base[code]) + math.log10((ends + SMOOTHING) / scale)),
                        pa.array(summed(weight[code]) + last),
                    ],
                    names=names,
                )
            )
        return pa.concat_tables(parts)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds_of = ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    ddl = ", ".join(f"{n} {k}" for n, k in zip(names, kinds_of))
    packed = blocks.filter("place < 0").select(F.col("block").alias("own"), "docs")
    return packed.groupBy("own").cogroup(known.groupBy("block")).applyInArrow(score, ddl)
