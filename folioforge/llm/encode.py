"""Encoding of a text column with a public byte-level vocabulary: a narrow pass, without a shuffle."""

from __future__ import annotations

from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.bpe import encoder, vocabulary_path

#: Texts that a worker holds as lists of ids at a time.
SLICE = 500


def _encode(batches, path: str):
    enc = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            ids = enc.encode_batch(part.column(1).to_pylist())
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "ids"])


def _decode(batches, path: str):
    enc = encoder(path)
    for batch in batches:
        texts = [None if ids is None else enc.decode(ids) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])


def encode_column(df: DataFrame, id_col: str, text_col: str, vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(`id_col`, ids array<int>) for every row, without special tokens. Null and empty texts give an empty list.

    Strings of special tokens inside a text are ordinary text. Rows with the same id each give a row; other columns are
    ignored. Whole texts are encoded, however long. `folder` holds the vocabulary files on every executor.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, path=vocabulary_path(vocabulary, folder)), "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode_column(df: DataFrame, id_col: str, ids_col: str, vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(`id_col`, text): the inverse of `encode_column`; a null list gives null, an empty one an empty text."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(partial(_decode, path=vocabulary_path(vocabulary, folder)), "id long, text string").withColumnRenamed("id", id_col)
