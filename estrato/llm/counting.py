"""Token counts of a table of texts (operator 12, batch encoding that returns lengths only).

The library encodes batches of pieces with about the same number of bytes.  A long text is cut into pieces before
blanks at which its tokens are cut anyway: no piece of the vocabulary goes on behind another character with a blank,
so no merge crosses that place, and the blank that a piece begins with is the one the library puts before each text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from estrato.llm.common import slices, text_buffers

#: Characters from which a text is cut into pieces, and bytes that the library encodes at once.
PIECE, BATCH_BYTES = 1 << 15, 1 << 18
#: What the vocabulary writes for a blank.
_BLANK = "▁"


def safe_to_cut(model: sentencepiece_model_pb2.ModelProto) -> bool:
    """Whether texts may be cut before a blank that another character stands before.

    So if texts are encoded as they are, but for a blank put before them, and no piece has a blank behind another
    character.  Otherwise every text is encoded as a whole.
    """
    rules = model.normalizer_spec
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    behind = any(a != _BLANK and b in (_BLANK, " ") for p in model.pieces for a, b in zip(p.piece, p.piece[1:]))
    bpe = model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
    return bool(bpe and plain and not behind and not model.trainer_spec.treat_whitespace_as_suffix)


@functools.lru_cache(maxsize=4)
def loaded(path: str) -> tuple[sentencepiece.SentencePieceProcessor, bool]:
    """The library's model of a file and whether long texts may be cut; one per Python worker."""
    processor, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(processor.serialized_model_proto())
    return processor, safe_to_cut(model)


def pieces(text: str, size: int = PIECE) -> list[str]:
    """``text`` cut before safe blanks, which go, into pieces of about ``size`` characters.

    A stretch without a safe blank stays whole, however long.
    """
    out, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at >= 0 and text[at - 1] in (" ", _BLANK):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 >= len(text):
            break
        out.append(text[start:at])
        start = at + 1
    out.append(text[start:])
    return out


def balanced(sizes: np.ndarray, limit: int) -> np.ndarray:
    """Where to cut a row of pieces into the fewest batches of about ``limit`` bytes, all about as large."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    count = max(1, -(-int(total[-1]) // limit))
    inner = np.searchsorted(total, np.arange(1, count) * (total[-1] / count))
    return np.unique(np.concatenate([[0], inner, [len(sizes)]]))


def lengths(texts: list[str], path: str) -> np.ndarray:
    """The number of tokens of each text."""
    processor, cut = loaded(path)
    parts = [pieces(t) if cut else [t] for t in texts]
    flat = [p for part in parts for p in part]
    places = balanced(np.array([len(p) for p in flat], np.int64), BATCH_BYTES)
    counts = [len(ids) for a, b in zip(places, places[1:]) for ids in processor.encode(flat[a:b], num_threads=1)]
    heads = np.cumsum([0, *map(len, parts)])[:-1]
    return np.add.reduceat(np.array(counts, np.int64), heads) if flat else np.zeros(0, np.int64)


def token_counts(docs: DataFrame, path: str, keep: list[str] | None = None, limit: int = 4096, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    A null or empty text has no bytes and no tokens.  Repeated rows are counted alike.  Columns of ``keep`` with a new
    column's name are replaced.  Only lengths come back from the workers; rows stay where they are: no shuffle, and a
    task holds a slice of texts, or one longer text.
    """
    new = ["n_bytes", "n_tokens", "over_limit"]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in new]
    packed = docs.select(F.struct(*[F.col(c) for c in rest]).alias("row"), F.col(text).alias("text"))
    schema = packed.select("row", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                sizes = np.diff(text_buffers(texts)[1])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(sizes), pa.array(lengths([t or "" for t in texts.to_pylist()], path))], ["row", "n_bytes", "n_tokens"])

    return packed.mapInArrow(work, schema).select("row.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
