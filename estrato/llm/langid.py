"""Language identification (operator 6, cross-parsing entropy).

A suffix automaton of each language's sample knows all its substrings.  A text is parsed into phrases: each
is the longest match that starts where the last one ended.  The language that needs the fewest phrases, each
weighted by the bits of a place in its sample, wins.  Texts are folded to lower-case letters and single gaps
and parsed whole, in blocks of ``BLOCK`` letters, which lets numpy step through thousands of blocks at once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import slices, text_buffers

#: Letters of a block, and bytes of text parsed side by side: many blocks make numpy's steps pay.
BLOCK, SIDE_BY_SIDE = 1024, 4 << 20
#: Bounds of the sample: documents of a language, letters of a document, and letters of a language in its automaton.
DOCUMENTS, PASSAGE, LETTERS = 64, 1500, 30_000


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    samples: tuple[str, ...]


def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 != 1


def fit(labelled: DataFrame, documents: int = DOCUMENTS, passage: int = PASSAGE, letters: int = LETTERS) -> Model:
    """Learn from rows (text, lang) with both.

    The sample is bounded: of each language the ``documents`` different texts with the smallest hashes, of each of them a
    passage of ``passage`` characters at a place drawn by the hash, and ``letters`` folded letters in all.
    """
    place = F.pmod(F.xxhash64(F.reverse("text")), F.greatest(F.length("text") - passage, F.lit(1))) + 1
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.xxhash64("text").alias("draw"), "text", place.cast("int").alias("place"))
    # Hashes first: passages of the few texts that are chosen are all that is read of texts and moved.
    drawn = rows.select("lang", "draw", F.pmod("draw", F.lit(64)).alias("part")).distinct()
    # The first of each part, then of all: no task sees more than these, however many tasks report theirs.
    for key in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("draw"))
        drawn = drawn.withColumn("rank", rank).filter(F.col("rank") <= documents)
    chosen = {(r.lang, r.draw): r["rank"] for r in drawn.collect()}  # a bounded number for each language
    some = rows.filter(F.col("draw").isin(sorted({d for _, d in chosen}))) if chosen else rows.limit(0)
    some = some.groupBy("lang", "draw").agg(F.min(F.substring(F.col("text"), F.col("place"), F.lit(passage))).alias("passage"))  # exact copies are one text
    found = sorted((lang, chosen[lang, d], text) for lang, d, text in some.collect() if (lang, d) in chosen)
    rows = [(lang, text) for lang, _, text in found]
    samples: dict[str, str] = {}
    for lang, text in rows:
        samples[lang] = (samples.get(lang, "") + " " + _folded(text))[:letters]
    known = {k: v for k, v in sorted(samples.items()) if v.strip()}
    return Model(tuple(known), tuple(known.values()))


@functools.lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Lower-case code point of each letter, 0 of anything else."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _folded(text: str) -> str:
    codes = _fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return " ".join("".join(chr(c) if c else " " for c in codes).split())


class _Automata:
    """Suffix automata of all languages as one table: ``table[state * symbols + symbol]`` is the next state.

    Where the automaton has no such step, it is the complement of the state after a new phrase has begun.  An
    additional state, before every text and after a letter that the sample has not, begins one with any symbol.
    """

    def __init__(self, model: Model):
        alphabet = sorted(set("".join(model.samples)) | {" "})
        self.symbols = len(alphabet) + 1  # the last one: a letter that no sample has
        self.of_code = np.full(0x110000, self.symbols - 1, np.uint16)
        fold = _fold_table()
        known = np.full(0x110000, self.symbols - 1, np.uint16)
        for i, c in enumerate(alphabet):
            known[ord(c)] = i
        self.gap = alphabet.index(" ")
        self.of_code = np.where(fold == 0, np.uint16(self.gap), known[fold])
        number = {c: i for i, c in enumerate(alphabet)}
        tables, self.starts = [], []
        for sample in model.samples:
            tables.append(self._dense([number[c] for c in sample], sum(len(t) for t in tables)))
            self.starts.append(sum(len(t) for t in tables) - 1)
        self.table = np.concatenate(tables).ravel()
        self.bits = np.log2([max(2, len(s)) for s in model.samples])

    def _dense(self, sample: list[int], base: int) -> np.ndarray:
        steps: list[dict[int, int]] = [{}]
        link, size, last = [-1], [0], 0
        for c in sample:
            new = len(steps)
            steps.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = new
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                if size[q] == size[p] + 1:
                    link[new] = q
                else:
                    copy = len(steps)
                    steps.append(dict(steps[q]))
                    size.append(size[p] + 1)
                    link.append(link[q])
                    link[q] = link[new] = copy
                    while p >= 0 and steps[p].get(c) == q:
                        steps[p][c] = copy
                        p = link[p]
            last = new
        first = np.full(self.symbols, base + len(steps), np.int32)
        for c, s in steps[0].items():
            first[c] = base + s
        table = np.tile(~first, (len(steps) + 1, 1))
        at = np.repeat(np.arange(len(steps)), [len(s) for s in steps])
        table[at, np.array([c for s in steps for c in s], np.int64)] = base + np.array([t for s in steps for t in s.values()], np.int32)
        return table

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each block for each language (languages x blocks)."""
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = starts[order], lengths[order]
        count = np.zeros((len(self.starts), len(order)), np.int32)
        state = np.repeat(np.array(self.starts, np.int32)[:, None], len(order), axis=1)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for t, n in enumerate(alive.tolist()):
            step = self.table[state[:, :n].astype(np.int64) * self.symbols + symbols[starts[:n] + t]]
            fresh = step >> 31  # -1 where a phrase begins
            count[:, :n] -= fresh
            state[:, :n] = step ^ fresh
        out = np.empty_like(count)
        out[:, order] = count
        return out


@functools.lru_cache(maxsize=2)
def _automata(model: Model) -> _Automata:
    """Built once per Python worker: what travels is the sample."""
    return _Automata(model)


def _classify(part: pa.RecordBatch, model: Model) -> tuple[list, list]:
    data, offsets = text_buffers(part.column("text"))
    auto = _automata(model)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    symbols, lettered = auto.of_code[codes], _fold_table()[codes] != 0
    has = np.diff(np.concatenate([[0], np.cumsum(lettered)])[chars]) > 0
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] != auto.gap) | (symbols[:-1] != auto.gap)
    places = np.concatenate([[0], np.cumsum(kept)])[chars]
    symbols = symbols[kept]
    sizes = np.diff(places)
    blocks = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), blocks)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = places[:-1][doc] + number * BLOCK
    found = auto.phrases(symbols, starts, np.minimum(sizes[doc] - number * BLOCK, BLOCK))
    bits = np.stack([np.bincount(doc, row, len(sizes)) for row in found]) * auto.bits[:, None] / np.maximum(sizes, 1)
    best = np.argmin(bits, axis=0)
    low = np.sort(bits, axis=0)
    score = low[1] / np.maximum(low[0] + low[1], 1e-12) if len(low) > 1 else np.ones(len(sizes))
    return [model.languages[b] if h else "und" for b, h in zip(best, has)], [float(s) if h else 0.0 for s, h in zip(score, has)]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs`` (doc_id, text).

    ``und`` with score 0 for a null text or one without a letter, or if nothing was learned.  The score is the
    runner-up's share of the bits that the best two need, from 0.5; ties go to the first language by name.
    Nothing but the text is read for a prediction; repeated rows get the same answer.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SIDE_BY_SIDE):
                langs, scores = _classify(part, model) if model.languages else (["und"] * part.num_rows, [0.0] * part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double")
