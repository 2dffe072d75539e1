"""SentencePiece ids of whole texts, and the texts that the ids give back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .pieces import blocks_of, piece_encoder
from .tables import text_rows, workers_find_package

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_ENCODED_DDL = "doc_id bigint, ids array<int>, decoded string"


def encode_texts(
    df: DataFrame, model_path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Ids of every row's whole text, and what they decode to.

    Columns: ``doc_id`` (the key), ``ids`` (array of int) and ``decoded``. The ids
    are those of the sentencepiece library for the model, without begin and end.
    A null or empty text has no ids and decodes to the empty text. Repeated rows
    each give a row; null keys stay null; an empty input gives an empty result.
    Other columns of the input play no part. Rows are handled where they are read,
    without a shuffle; texts are merged ``pieces.BLOCK_BYTES`` at a time.
    """
    workers_find_package(df.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for own in blocks_of(sizes):
                part = batch.take(pa.array(own))
                ids, bounds = encoder.flat(part.column("text"))
                decoded = [encoder.decode(ids[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32())
                        ),
                        pa.array(decoded, pa.binary()).cast(pa.string()),
                    ],
                    schema=_ENCODED,
                )
        # The worker may serve other stages next; they need the memory.
        encoder.forget()

    return text_rows(df, text, key).mapInArrow(encode, _ENCODED_DDL)
