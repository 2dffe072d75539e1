"""Quality scores by boosted trees over statistics of whole texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, workers_find_package
from .trees import Trees, fit

# Rows that a model learns from at most: those with the smallest key hashes.
SAMPLE_ROWS = 20_000
# One row in so many is held out from learning.
FOLDS = 5
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "lower", "digit", "space",
    "stop_mark", "symbol", "other_mark", "beyond_ascii", "distinct_words", "top_word",
    "words_in_marks", "lines", "repeated_lines", "repeated_line_bytes", "line_length",
    "shouted_words", "repeated_pairs", "short_words",
)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\x0b\x0c\r"
_STOP = b".,;:?'\"-()"
_SYMBOL = b"!#$%&*"
_BEYOND = bytes(range(128, 256))
_MARKS = tuple("!#$%&*+<>=@[]^_{|}~/\\")


def statistics(text: str) -> list[float]:
    """The numbers of ``STATISTICS`` for a whole text; all 0 for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode()
    size = len(raw)

    def share(kind: bytes) -> float:
        return (size - len(raw.translate(None, kind))) / size

    shares = [share(k) for k in (_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _SYMBOL, _BEYOND)]
    words = text.split()
    n = len(words)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    line_counts = Counter(lines)
    # Of a line's copies all but the first are repeats.
    again = sum((c - 1) * len(x) for x, c in line_counts.items())
    pairs = len(set(zip(words, words[1:])))
    upper, lower, digit, space, stop, symbol, beyond = shares
    return [
        math.log1p(size),
        math.log1p(n),
        (len(text) / n) if n else 0.0,
        float(max(map(len, counts), default=0)),
        upper,
        lower,
        digit,
        space,
        stop,
        symbol,
        max(0.0, 1.0 - sum(shares)),
        beyond,
        len(counts) / n if n else 0.0,
        max(counts.values(), default=0) / n if n else 0.0,
        sum(c for w, c in counts.items() if w.endswith(_MARKS)) / n if n else 0.0,
        math.log1p(len(lines)),
        1.0 - len(line_counts) / len(lines) if lines else 0.0,
        again / len(text),
        math.log1p(len(text) / len(lines)) if lines else 0.0,
        sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n if n else 0.0,
        1.0 - pairs / (n - 1) if n > 1 else 0.0,
        sum(c for w, c in counts.items() if len(w) < 3) / n if n else 0.0,
    ]


def held_out(key: Column) -> Column:
    """Rows that no model may learn from; a null key counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py() or "") for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("spread"),
                batch.column("quality"),
                pa.array(rows, pa.list_(pa.float64())),
            ],
            names=["spread", "quality", "measured"],
        )


def learn(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Trees:
    """Trees from labelled rows of ``df`` that aren't held out.

    At most ``SAMPLE_ROWS`` keys and rows are used, those with the smallest hashes.
    A key with several labels takes the largest; null labels don't count.
    """
    workers_find_package(df.sparkSession)
    marked = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    marked = marked.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    chosen = (
        marked.groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # The chosen labels are bounded by SAMPLE_ROWS, so they may be broadcast.
    known = rows.join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id", "text").alias("spread"), "quality", "text"
    )
    sample = (
        known.mapInArrow(_measured, "spread bigint, quality int, measured array<double>")
        .orderBy("spread", "quality")
        .limit(SAMPLE_ROWS)
        .toArrow()
    )
    measured = np.array(sample.column("measured").to_pylist(), dtype=float)
    measured = measured.reshape(sample.num_rows, len(STATISTICS))
    return fit(measured, sample.column("quality").to_numpy().astype(float))


def with_scores(df: DataFrame, model: Trees, text: str, score: str) -> DataFrame:
    """``df`` with the column ``score``; a null text is scored as an empty one."""

    @F.pandas_udf("double")
    def scored(texts):
        rows = np.array([statistics(t or "") for t in texts], dtype=float)
        return pd.Series(model.score(rows.reshape(len(texts), len(STATISTICS))))

    return df.withColumn(score, scored(F.col(text)))


def quality_scores(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Key, ``held_out``, ``score`` (0 to 1, label 1 likelier) and ``predicted``.

    The score depends on the text alone, so copies score alike. Empty and null
    texts are scored too; null keys are held out. Without labels every score is
    a half. Repeated rows each give a row; other columns are ignored.
    """
    model = learn(df, labels, text, key)
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return with_scores(rows, model, "text", "score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_rejects(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``df`` without the rows that score below the threshold."""
    model = learn(df, labels, text, key)
    score = free_name(df, "score")
    scored = with_scores(df, model, text, score)
    return scored.filter(F.col(score) >= THRESHOLD).select(*df.columns)
