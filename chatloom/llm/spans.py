"""Benchmark passages in documents: q-gram lemma filter and banded alignment."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import free_name, text_rows, workers_find_package

Q = 8
# Edits (inserted, deleted or changed characters) allowed per character of an item, as
# far as the lemma leaves a quarter of its q-grams: 1 for 18 characters, 4 for 50, 8 for
# 100, 93 for 1,000, none for 17 or fewer.
EDIT_RATE = 0.1
# Characters of items that are searched for in one pass over the documents.
BLOCK_CHARS = 1 << 20
# Characters of documents that are searched at once.
BATCH_CHARS = 1 << 21
# Cells of alignment matrices that are computed at once.
CELLS = 1 << 21

_SEPARATOR = 0x110000  # beyond every character
_NEVER = np.int32(1 << 29)  # edits of what is no alignment
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # any odd number mixes
_BITS = 22


def _lower_table() -> np.ndarray:
    """Lower case of every character that has one of one character; white space
    becomes the space. No character changes its place."""
    table = np.arange(_SEPARATOR + 1, dtype=np.uint32)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        low = char.lower()
        if char.isspace():
            table[code] = 32
        elif len(low) == 1:
            table[code] = ord(low)
    return table


_tables: list[np.ndarray] = []


def codes_of(text: str) -> np.ndarray:
    """Character codes of a text in lower case, white space as spaces."""
    if not _tables:
        _tables.append(_lower_table())
    return _tables[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]


def searched_text(text: str) -> str:
    """An item's text as it is searched for: lower case, words parted by one space."""
    return "".join(map(chr, codes_of(" ".join(text.split()))))


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A number for every run of ``q`` codes, by doubling: 1, 2, 4, ... codes."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    out, done = None, 0
    power, width = codes.astype(np.uint64), 1
    factor = _MULTIPLIER
    while width <= q:
        if q & width:
            if out is None:
                out = power
            else:
                # ``out`` covers ``done`` codes, ``power`` the ``width`` codes after it.
                n = len(codes) - done - width + 1
                out = out[:n] * factor + power[done : done + n]
            done += width
        n = len(power) - width
        power = power[:n] * factor + power[width:] if n > 0 else power[:0]
        factor, width = np.uint64((int(factor) ** 2 + 2) % (1 << 64)), 2 * width
    return out[: len(codes) - q + 1]


def _sums(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, dtype=np.int32, out=out[1:])
    return out


@dataclass
class Item:
    number: int
    codes: np.ndarray
    edits: int
    least: int  # q-grams that a match within ``edits`` shares with the item


def item_of(number: int, text: str) -> Item | None:
    """The item with its edit budget, or None if its text is empty.

    q-gram lemma: m characters have m - q + 1 q-grams, and an edit destroys q of
    them at most. The budget is lowered until a quarter of them must remain; an
    item shorter than q has budget 0 and is searched for as it is.
    """
    codes = codes_of(" ".join(text.split()))
    m = len(codes)
    if not m:
        return None
    grams = max(m - Q + 1, 0)
    edits = min(int(EDIT_RATE * m), (grams - (grams + 3) // 4) // Q)
    return Item(number, codes, max(edits, 0), max(grams - Q * max(edits, 0), 0))


class Index:
    """q-grams of one block of items, with a bit table in front."""

    def __init__(self, items: list[Item]):
        self.items = [i for i in items if len(i.codes) >= Q]
        self.short = [i for i in items if len(i.codes) < Q]
        hashes = [gram_hashes(i.codes) for i in self.items]
        all_ = np.concatenate([np.zeros(0, np.uint64), *hashes])
        owner = np.repeat(np.arange(len(self.items)), [len(h) for h in hashes])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(h)) for h in hashes)])
        order = np.argsort(all_, kind="stable")
        self.hashes, self.first, self.count = np.unique(
            all_[order], return_index=True, return_counts=True
        )
        self.owner, self.place = owner[order].astype(np.int64), place[order].astype(np.int64)
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self._slot(self.hashes)] = True
        self.edits = np.array([i.edits for i in self.items], dtype=np.int64)
        self.least = np.array([i.least for i in self.items], dtype=np.int64)
        self.lengths = np.array([len(i.codes) for i in self.items], dtype=np.int64)
        # Bands start at every multiple of the step and overlap by the budget, so
        # the diagonals of a match, at most the budget apart, share a band.
        self.steps = np.maximum(8, self.edits + 1)
        # Item lengths fall into classes; a class has one window for the first sieve.
        self.windows = []
        if len(self.items):
            sorts = np.floor(np.log(self.lengths) / np.log(1.25)).astype(int)
            for sort in np.unique(sorts):
                own = sorts == sort
                wide = int((self.lengths + self.edits)[own].max())
                self.windows.append((wide, int(self.least[own].min())))

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MULTIPLIER) >> np.uint64(64 - _BITS)).astype(np.int64)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``codes`` whose q-gram an item has, if enough others stand
        near it for some length class; with the hash there."""
        hashes = gram_hashes(codes)
        if not len(hashes) or not self.windows:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        there = self.seen[self._slot(hashes)]
        total = _sums(there)
        near = np.zeros(len(hashes), dtype=bool)
        for wide, least in self.windows:
            wide = min(wide, len(hashes))
            full = total[wide:] - total[:-wide] >= min(least, wide)
            if full.any():
                # A place is near if one of the windows that hold it is full.
                passed = np.pad(_sums(full)[1:], (wide, wide - 1), mode="edge")
                passed[:wide] = 0
                near |= passed[wide:] > passed[:-wide]
        at = np.flatnonzero(near & there)
        return at, hashes[at]

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, first diagonal) of every band with as many q-grams of one
        document as the lemma asks. Separators end the documents of ``codes``."""
        at, hashes = self.hits(codes)
        found = np.searchsorted(self.hashes, hashes)
        found = np.minimum(found, len(self.hashes) - 1)
        real = self.hashes[found] == hashes if len(at) else np.zeros(0, bool)
        at, found = at[real], found[real]
        many = self.count[found]
        posting = np.repeat(self.first[found] - (np.cumsum(many) - many), many)
        posting = posting + np.arange(len(posting))
        item = self.owner[posting]
        diagonal = np.repeat(at, many) - self.place[posting]
        _, ends = borders(codes)
        document = np.repeat(np.searchsorted(ends, at), many)
        step = self.steps[item]
        band = diagonal // step
        also = diagonal - band * step < self.edits[item]
        item = np.concatenate([item, item[also]])
        document = np.concatenate([document, document[also]])
        band = np.concatenate([band, band[also] - 1])
        # Diagonals may start before the text by an item's length: shifted to be positive.
        shift = int(self.lengths.max(initial=0)) + 16
        size = len(codes) + 2 * shift
        key = (item * len(ends) + document) * size + band + shift
        key, n = np.unique(key, return_counts=True)
        band = key % size - shift
        item, document = np.divmod(key // size, len(ends))
        enough = n >= np.maximum(self.least[item], 1)
        item, document, band = item[enough], document[enough], band[enough]
        return item, document, band * self.steps[item]


def borders(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the documents begin and end that separators part."""
    ends = np.append(np.flatnonzero(codes == _SEPARATOR), len(codes))
    return np.concatenate([[0], ends[:-1] + 1]), ends


def align(
    patterns: list[np.ndarray],
    text: np.ndarray,
    starts: np.ndarray,
    widths: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    fixed: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern against ``text`` on its band, and where they end.

    A band holds the diagonals starts[i] to starts[i] + widths[i] - 1 and no others;
    all bands are computed together, a row of the matrix at a time. A pattern may
    begin and end on any of its diagonals, but reads only text[low[i]:high[i]]; if
    ``fixed`` it begins at low[i].
    """
    sizes = np.array([len(p) for p in patterns])
    rows = np.full((len(patterns), sizes.max(initial=0)), _SEPARATOR + 1, dtype=np.uint32)
    for row, pattern in zip(rows, patterns):
        row[: len(pattern)] = pattern
    padded = np.append(text, np.uint32(_SEPARATOR))
    steps = np.arange(widths.max(initial=1), dtype=np.int32)
    wall = np.where(steps >= widths[:, None], _NEVER, np.int32(0))
    walled = bool(wall.any())
    at = starts[:, None] + steps
    # Places in the text never go back: what begins inside and ends inside has read
    # nothing else, so only beginnings and ends need to be held within the limits.
    barred = at != low[:, None] if fixed else at < low[:, None]
    cost = np.where(barred, _NEVER, wall)
    last = np.zeros_like(cost)
    for i in range(rows.shape[1]):
        read = padded[np.where((at >= 0) & (at < len(text)), at, len(text))]
        step = cost + (read != rows[:, i, None])
        # Leaving out the pattern's character reads no text: one diagonal less.
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        # An extra character of the text goes one diagonal on, at one edit each.
        cost = np.minimum.accumulate(step - steps, axis=1) + steps
        if walled:
            np.maximum(cost, wall, out=cost)
        at = at + 1
        ended = sizes == i + 1
        if ended.any():
            last[ended] = np.where(at[ended] > high[ended, None], _NEVER, cost[ended])
    best = last.argmin(axis=1)
    return last[np.arange(len(patterns)), best], starts + sizes + best


def verified(index: Index, codes: np.ndarray) -> Iterator[tuple[Item, int, int]]:
    """(item, end, edits) of the bands that hold an alignment within the budget."""
    owner, document, diagonal = index.bands(codes)
    # Bands of like lengths go together, so that none waits long for another.
    order = np.argsort(index.lengths[owner], kind="stable")
    owner, document, diagonal = owner[order], document[order], diagonal[order]
    begins, limits = borders(codes)
    widths = (index.steps + index.edits)[owner]
    many = max(1, CELLS // (16 * int(widths.max(initial=1))))
    for at in range(0, len(owner), many):
        own, inside = owner[at : at + many], document[at : at + many]
        edits, ends = align(
            [index.items[o].codes for o in own],
            codes,
            diagonal[at : at + many],
            widths[at : at + many],
            begins[inside],
            limits[inside],
        )
        for o, e, end in zip(own, edits, ends):
            if e <= index.items[o].edits:
                yield index.items[o], int(end), int(e)


def matches(index: Index, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item number, start, end, edits) of every verified band."""
    found = list(dict.fromkeys((i.number, end, e) for i, end, e in verified(index, codes)))
    by_number = {i.number: i for i in index.items}
    begins, limits = borders(codes)
    # The same alignments from their ends backwards tell where the matches start.
    spans = []
    for at in range(0, len(found), 256):
        part = found[at : at + 256]
        reach = np.array([e for *_, e in part], dtype=np.int64)
        ends = np.array([end for _, end, _ in part], dtype=np.int64)
        left = len(codes) - ends
        _, back = align(
            [by_number[n].codes[::-1] for n, _, _ in part],
            codes[::-1],
            left - reach,
            2 * reach + 1,
            left,
            len(codes) - begins[np.searchsorted(limits, ends)],
            fixed=True,
        )
        spans += [(n, len(codes) - int(b), end, e) for (n, end, e), b in zip(part, back)]
    for item in index.short:
        size = len(item.codes)
        if len(codes) >= size:
            windows = np.lib.stride_tricks.sliding_window_view(codes, size)
            same = (windows == item.codes).all(axis=1)
            spans += [(item.number, int(i), int(i) + size, 0) for i in np.flatnonzero(same)]
    return spans


def _one_per_place(spans: list[tuple]) -> list[tuple]:
    """Of overlapping matches of an item in a document the one with fewest edits."""
    kept: dict[int, list[tuple]] = {}
    for span in sorted(spans, key=lambda s: (s[0], s[3], s[1], s[2])):
        # Kept matches of an item don't overlap, so only its neighbours can meet it.
        own = kept.setdefault(span[0], [])
        at = bisect.bisect_left(own, span[1:3])
        before, after = own[at - 1 : at] if at else [], own[at : at + 1]
        if all(k[1] <= span[1] for k in before) and all(k[0] >= span[2] for k in after):
            own.insert(at, (*span[1:3], span))
    return [span for own in kept.values() for *_, span in own]


def document_spans(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """Matches in each of several whole texts, all searched in one array."""
    gap = np.full(1, _SEPARATOR, np.uint32)
    codes = np.concatenate([part for t in texts for part in (codes_of(t), gap)])
    begins, limits = borders(codes)
    found: list[list[tuple]] = [[] for _ in texts]
    for number, start, end, edits in matches(index, codes):
        # No match goes beyond its document's separator.
        doc = int(np.searchsorted(limits, end))
        low = int(begins[doc])
        found[doc].append((number, start - low, end - low, edits))
    return [_one_per_place(f) for f in found]


def _batched(texts: list[str]) -> Iterator[range]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BATCH_CHARS:
            yield range(start, i)
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield range(start, len(texts))


def search_texts(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    return [s for own in _batched(texts) for s in document_spans(index, [texts[i] for i in own])]


def item_blocks(items: DataFrame, text: str = "text", key: str = "item_id") -> Iterator[list[tuple]]:
    """The items in blocks of ``BLOCK_CHARS`` characters at most, or of one item.

    The driver holds one block at a time. An item is a key, which may be null, and
    a text as it is searched for: texts of one key that differ are items of their
    own, others are one. Only items without text are left out.
    """
    searched = F.udf(searched_text, "string")
    rows = items.filter(F.col(text).isNotNull()).select(
        F.col(key).cast("bigint").alias("k"), searched(F.col(text)).alias("t")
    )
    rows = rows.filter("t != ''").distinct().orderBy("k", "t")
    block: list[tuple] = []
    held = 0
    for row in rows.toLocalIterator():
        if block and held + len(row.t) > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((row.k, row.t))
        held += len(row.t)
    if block:
        yield block


_indexes: dict[tuple, Index] = {}


def _index(block: list[tuple]) -> Index:
    key = tuple(block)
    if key not in _indexes:
        _indexes.clear()
        # Numbered by their places in the block, as keys may be null or repeated.
        _indexes[key] = Index([i for i in (item_of(n, t) for n, (_, t) in enumerate(block)) if i])
    return _indexes[key]


def contaminated_spans(
    df: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Every place where a document holds an item within its edit budget.

    The budget is a tenth of the item's characters, or less where that would leave
    under a quarter of its q-grams (``EDIT_RATE``); items of under 18 characters are
    found only as they are.

    Columns: key, ``item_id``, ``span_start`` and ``span_end`` (characters of the
    text), ``edits``. Case and kinds of white space don't count as edits. Null and
    empty texts hold nothing; repeated rows each report their own; a null key stays
    null, an item's too. Different texts of one ``item_id`` are searched for each on
    its own, items without text not at all. Without items the result is empty.
    """
    spark = df.sparkSession
    workers_find_package(spark)
    rows = text_rows(df, text, key)
    ddl = "doc_id bigint, item_id bigint, span_start bigint, span_end bigint, edits int"
    out = spark.createDataFrame([], ddl)
    for block in item_blocks(items):
        # A block is bounded, so every task may hold it.
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            index = _index(shared.value)
            for batch in batches:
                docs = batch.column("doc_id").to_pylist()
                spans = search_texts(index, batch.column("text").to_pylist())
                flat = [
                    (doc, shared.value[n][0], *s)
                    for doc, own in zip(docs, spans)
                    for n, *s in own
                ]
                columns = list(zip(*flat)) or [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "span_start", "span_end", "edits"],
                )

        out = out.unionByName(rows.mapInArrow(search, ddl))
    return out


def without_contaminated(
    df: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``df`` without the rows that hold an item. Each block of items is one filter.

    Items are told by their texts; an ``item_id`` that is null or repeated doesn't
    matter. Items without text are no items.
    """
    spark: SparkSession = df.sparkSession
    workers_find_package(spark)
    out = df
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)

        @F.pandas_udf("boolean")
        def holds(texts, shared=shared):
            index = _index(shared.value)
            return texts.__class__([bool(s) for s in search_texts(index, [t or "" for t in texts])])

        flag = free_name(out, "holds")
        out = out.withColumn(flag, holds(F.col(text))).filter(~F.col(flag)).select(*df.columns)
    return out
