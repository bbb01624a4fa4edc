"""Fill-in-the-middle documents (operator 13, wavelet matrix over character classes).

A text is a row of units: runs of ASCII letters, and single code points of any other kind.  All texts of a slice
lie end to end as bytes, every byte has a class, and a wavelet matrix over the classes answers how many bytes of
classes below a bound stand before any place.  Two such ranks give the number of units and of code points before
a place; both cuts of all texts of a slice are found together, by bisection on these ranks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import slices, text_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Out of 100 documents: how many keep their form, and how many of the others put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20

# Classes of bytes.  The first two begin no unit; the first begins no code point either.
_TRAIL, _LETTER, _RUN, _DIGIT, _BLANK, _SPACE, _ASCII, _LEAD = range(8)
_BITS = 3


def _class_table() -> np.ndarray:
    out = np.full(256, _ASCII, np.uint8)
    out[9:14] = _SPACE
    out[32] = _BLANK
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = _RUN
    out[128:192] = _TRAIL
    out[192:] = _LEAD
    return out


_CLASSES = _class_table()


def classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of every byte of some texts end to end."""
    out = _CLASSES[data]
    letters = out == _RUN
    further = letters.copy()
    further[:1] = False
    further[1:] &= letters[:-1]
    further[offsets[(offsets > 0) & (offsets < len(data))]] = False
    out[further] = _LETTER
    return out


class Bits:
    """A row of bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        low = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """A row of numbers below ``2**bits``: one plane per bit, the highest first, each ordered by the bits above it."""

    def __init__(self, values: np.ndarray, bits: int):
        self.planes = []
        for bit in reversed(range(bits)):
            one = (values >> bit & 1).astype(bool)
            self.planes.append(Bits(one))
            values = np.concatenate([values[~one], values[one]])

    def below(self, places: np.ndarray, bound: int) -> np.ndarray:
        """How many of the first ``places`` numbers are less than ``bound``."""
        start, end, out = np.zeros(1, np.int64), places, np.zeros(len(places), np.int64)
        for bit, plane in zip(reversed(range(len(self.planes))), self.planes):
            ones_start, ones_end = plane.ones(start), plane.ones(end)
            if bound >> bit & 1:
                out += (end - ones_end) - (start - ones_start)
                start, end = plane.zeros + ones_start, plane.zeros + ones_end
            else:
                start, end = start - ones_start, end - ones_end
        return out


class Units:
    """Units and code points of texts that lie end to end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.matrix = WaveletMatrix(classes(data, offsets), _BITS)
        self.starts, self.ends = offsets[:-1], offsets[1:]
        self.base = self._begun(self.starts)
        self.count = self._begun(self.ends) - self.base

    def _begun(self, places: np.ndarray) -> np.ndarray:
        return places - self.matrix.below(places, _RUN)

    def chars(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code points between bytes."""
        return (ends - self.matrix.below(ends, _LETTER)) - (starts - self.matrix.below(starts, _LETTER))

    def cuts(self, units: np.ndarray) -> np.ndarray:
        """The byte behind the first ``units`` units of each text: the last place that has no more of them before it."""
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self._begun(middle) - self.base <= units
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers per document: the first groups of 8 digits of the SHA-256 of ``seed:doc_id``; a null id is empty."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").astype(np.int64).reshape(-1, 4)


def transform(docs: DataFrame, keep: list[str] | None = None, seed: int = 1, output: str = "output") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) with n, form, prefix_chars, middle_chars and ``output``.

    The prefix of a text of n units ends behind the smaller of two draws from 0 to n, the middle behind the larger,
    and the suffix is the rest.  Form ``psm`` is PREFIX prefix SUFFIX suffix MIDDLE middle, ``spm`` is SUFFIX suffix
    PREFIX prefix MIDDLE middle; a text that is empty, holds one of the three marks or is drawn so stays ``plain``,
    with null lengths.  Draws depend on doc_id alone, so repeated rows are treated alike, wherever they are.  A null
    text counts as empty; a null doc_id has draws of its own.  Columns of ``keep`` with a new column's name are
    replaced.  Rows stay where they are: no shuffle, and a task holds a slice of texts, or one longer text.
    """
    new = ["n", "form", "prefix_chars", "middle_chars", output]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in new]
    packed = docs.select(F.struct(*[F.col(c) for c in rest]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    schema = packed.select("row", *[F.lit(None).cast(t).alias(c) for c, t in zip(new, ("long", "string", "long", "long", "string"))]).schema
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_buffers(part.column("text"))
                raw, units = data.tobytes(), Units(data, offsets)
                draw = draws(part.column("id").to_pylist(), seed)
                ends = np.sort(draw[:, :2] % (units.count + 1)[:, None], axis=1)
                first, second = units.cuts(ends[:, 0]), units.cuts(ends[:, 1])
                forms, out = [], []
                for a, p, q, b, plain, suffix in zip(offsets[:-1].tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(), draw[:, 2] % 100 >= 100 - PLAIN, draw[:, 3] % 100 < SUFFIX_FIRST):
                    if plain or a == b or any(raw.find(m, a, b) >= 0 for m in marks):
                        forms.append("plain")
                        out.append(raw[a:b])
                    elif suffix:
                        forms.append("spm")
                        out.append(b"".join((marks[1], raw[q:b], marks[0], raw[a:p], marks[2], raw[p:q])))
                    else:
                        forms.append("psm")
                        out.append(b"".join((marks[0], raw[a:p], marks[1], raw[q:b], marks[2], raw[p:q])))
                form = np.array(forms)
                lengths = [pa.array(n, pa.int64(), mask=form == "plain") for n in (units.chars(offsets[:-1], first), units.chars(first, second))]
                texts = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(units.count), pa.array(forms, pa.string()), *lengths, texts], ["row", *new])

    return packed.mapInArrow(work, schema).select("row.*", *new)


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed one was made of.

    No mark can arise where parts meet, as each begins with ``<`` and has no other, so each occurs once.
    """
    head = F.substr(output, F.lit(len(PREFIX) + 1))  # without the mark it begins with
    tail = F.substring_index(output, MIDDLE, -1)
    body = F.substring_index(head, MIDDLE, 1)
    psm = F.concat(F.substring_index(body, SUFFIX, 1), tail, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), tail, F.substring_index(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
