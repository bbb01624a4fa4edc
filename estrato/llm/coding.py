"""BPE encoding and decoding of a table of texts (operator 2, tree concatenation: see ``bpe``)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm import bpe
from estrato.llm.common import slices


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column ``ids`` of token ids.

    A null or empty text has no ids.  Rows stay where they are: no shuffle, any number of repeated rows.
    A column that is already called ``ids`` is replaced.
    """
    rest = [c for c in docs.columns if c != ids]
    packed = docs.select(F.struct(*rest).alias("row"), F.col(text).alias("text"))
    schema = packed.select("row", F.lit(None).cast("array<int>").alias("ids")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.loaded(path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [coder.encode(t or "") for t in part.column("text").to_pylist()]
                places = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = np.concatenate([*found, np.zeros(0, np.uint32)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.ListArray.from_arrays(places, values)], ["row", "ids"])

    return packed.mapInArrow(work, schema).select("row.*", F.col("ids").alias(ids))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with a column ``text`` of the texts that the ids stand for; null ids give an empty text."""
    rest = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(*rest).alias("row"), F.col(ids).cast("array<int>").alias("ids"))
    schema = packed.select("row", F.lit("").alias("text")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.loaded(path)
        for batch in batches:
            found = [coder.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], ["row", "text"])

    return packed.mapInArrow(work, schema).select("row.*", F.col("text").alias(text))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of the text decoded from them, for each row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.loaded(path)
        for batch in batches:
            for part in slices(batch, "text"):
                counts, of_ids, of_text = [], [], []
                for text in part.column("text").to_pylist():
                    ids = coder.encode(text or "")
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([coder.decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                    of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
