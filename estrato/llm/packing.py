"""Packing of tokenized documents into windows (operator 9, sum-of-squares online packing).

Each task packs the documents that it reads, in their order: a document's full windows are cut off, and its
rest goes to the fill level whose choice makes the sum over all levels of (number of partially filled windows
at that level) squared smallest.  A level array holds the open windows of each level.  When a task ends, what
is in its open windows is cut to fill windows without a gap; the last one is cut into powers of two, which
need no padding.  Packing needs no shuffle, and a task run again gives the same sequences again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from estrato.llm import bpe
from estrato.llm.common import slices

COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequence ids of one task: more than a task can fill.
IDS_OF_TASK = 1 << 36


class Packer:
    """Sum-of-squares packing of one stream of documents into windows of ``size`` ids."""

    def __init__(self, size: int, first_id: int = 0):
        self.size, self.next_id = size, first_id
        self.levels: list[list[tuple[int, list]]] = [[] for _ in range(size)]  # open windows, by ids held
        self.counts = np.zeros(size + 1, np.int64)  # windows open at each level; none count at 0 and at size

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        full = total - total % self.size
        for start in range(0, full, self.size):
            yield self._row((doc, start, ids[start : start + self.size], total), self._new(), 0)
        if full < total:
            yield from self._place((doc, full, ids[full:], total))

    def _place(self, piece: tuple) -> Iterator[tuple]:
        need = len(piece[2])
        level = self._level(need)
        window, held = self.levels[level].pop() if level else (self._new(), [])
        self.counts[level] -= level > 0
        held.append(piece)
        if level + need == self.size:
            at = 0
            for p in held:
                yield self._row(p, window, at)
                at += len(p[2])
        else:
            self.levels[level + need].append((window, held))
            self.counts[level + need] += 1

    def _level(self, need: int) -> int:
        """The level to fill up from: an open window moves from level h to h + need, or a new one opens (0).

        The sum of squares changes by -2 N(h) + 1 at h and by 2 N(h + need) + 1 at h + need; nothing is
        counted at 0 and at the full size.  Ties go to the fullest window.
        """
        room = self.size - need
        change = 2 * self.counts[need:] + 1  # where the window arrives
        change[room] = 0  # it is full
        change[1:] += 1 - 2 * self.counts[1 : room + 1]  # what it leaves
        change[1:][self.counts[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return int(room - np.argmin(change[::-1]))

    def end(self) -> Iterator[tuple]:
        """Cut what the open windows hold so that it fills windows, and the last one into powers of two."""
        left = sum(level * len(windows) for level, windows in enumerate(self.levels))
        sizes = [self.size] * (left // self.size) + [1 << k for k in reversed(range(self.size.bit_length())) if (left % self.size) >> k & 1]
        room, window, at = 0, 0, 0
        for piece in [p for windows in reversed(self.levels) for _, held in windows for p in held]:
            doc, start, ids, total = piece
            while len(ids):
                if not room:
                    room, window, at = sizes.pop(0), self._new(), 0
                cut = min(room, len(ids))
                yield self._row((doc, start, ids[:cut], total), window, at)
                start, ids, at, room = start + cut, ids[cut:], at + cut, room - cut

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    @staticmethod
    def _row(piece: tuple, window: int, at: int) -> tuple:
        doc, start, ids, total = piece
        return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, window, at


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece of a document: which of its ids stand where in which sequence.

    Every document of ``docs`` (doc_id, text) is encoded by the tokenizer file at ``path`` and closed by
    ``end_id``; a null or empty text is that id alone.  Repeated rows are documents of their own, a null
    doc_id stays null, other columns are not read.  An empty table gives no pieces.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.loaded(path)
        packer = Packer(size, TaskContext.get().partitionId() * IDS_OF_TASK)
        rows: list[tuple] = []
        for batch in batches:
            for part in slices(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    rows += packer.add(doc, np.append(coder.encode(text or ""), np.uint32(end_id)))
                yield _table(rows)
                rows = []
        yield _table(list(packer.end()))

    return docs.select("doc_id", "text").mapInArrow(work, COLUMNS)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
