"""Bags of word shingles and their BagMinHash signatures.

Each shingle of a text is the source of Poisson points in time, one process for each discretised interval of
weight: (0, 1], (1, 2], (2, 4], (4, 8] and so on, with the interval's width as its rate.  A point bears a
weight level of its interval and counts for texts that hold the shingle at least so often; it belongs to one
component of the signature.  A component is the first point that counts.  Two texts agree in a component with
the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from estrato.llm.common import WORD_BASES, mix, run_hashes, text_buffers, word_hashes, word_spans

_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and number of every distinct shingle, by document, then hash.

    Shingles are runs of ``words`` words; a text with fewer words, but at least one, is one shingle.
    """
    data, offsets = text_buffers(texts)
    starts, ends, before = word_spans(data, offsets)
    counts = np.diff(before)
    shingles = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    doc = np.repeat(np.arange(len(counts)), shingles)
    at = before[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    hashes = run_hashes(word_hashes(data, starts, ends), at, at + np.minimum(counts[doc], words), WORD_BASES[0])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    places = np.flatnonzero(first)
    return doc[places], hashes[places], np.diff(np.append(places, len(doc)))


def elements(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A bag as a set: the n-th copy of a shingle is an element of its own."""
    copy = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
    with np.errstate(over="ignore"):
        return np.sort(mix(np.repeat(hashes, weights) + copy.astype(np.uint64) * _STEP))


def _processes(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray):
    """One process per shingle and interval that its weight reaches: document, seed, from, width, weight."""
    out, level, low, width = [], 0, 0, 1
    while True:
        here = weights > low
        if not here.any():
            return [np.concatenate(x) for x in zip(*out)] if out else [doc, hashes, weights, weights, weights]
        seed = mix(hashes[here] + np.uint64(level))
        out.append((doc[here], seed, np.full(len(seed), low), np.full(len(seed), width), weights[here]))
        level, low, width = level + 1, low + width, low + width


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, count: int, size: int) -> np.ndarray:
    """``size`` components for each of ``count`` documents; those of a document without shingles are 0."""
    out = np.zeros((count, size), np.uint64)
    total = np.bincount(doc, weights, count)
    limit = np.log(size) + 6.0
    todo = total > 0
    with np.errstate(over="ignore"):
        while todo.any():
            mine = todo[doc]
            found, filled = _first_points(doc[mine], hashes[mine], weights[mine], count, size, np.where(todo, limit * size / np.maximum(total, 1), 0))
            done = todo & filled
            out[done] = found[done]
            todo &= ~filled
            limit *= 2
    return out


def _first_points(doc, hashes, weights, count, size, until):
    doc, seed, low, width, weight = _processes(doc, hashes, weights)
    soonest, out = np.full(count * size, np.inf), np.zeros(count * size, np.uint64)
    time, k = np.zeros(len(doc)), 0
    while len(doc):
        k += 1
        point = mix(seed + np.uint64(k) * _STEP)
        time = time - np.log1p(-(point >> np.uint64(11)).astype(np.float64) * 2.0**-53) / width
        on = time <= until[doc]
        doc, seed, low, width, weight, time, point = (x[on] for x in (doc, seed, low, width, weight, time, point))
        mark = mix(point + _STEP)
        counts = low + 1 + (mark >> np.uint64(40)).astype(np.int64) % width <= weight
        place = doc * size + ((mark & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)
        place, when, name = place[counts], time[counts], point[counts]
        np.minimum.at(soonest, place, when)
        first = when == soonest[place]
        out[place[first]] = name[first]
    return out.reshape(count, size), np.isfinite(soonest).reshape(count, size).all(axis=1)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band, other for other bands."""
    rows = signature.reshape(len(signature), bands, -1)
    with np.errstate(over="ignore"):
        place = np.arange(rows.shape[1] * rows.shape[2], dtype=np.uint64).reshape(rows.shape[1:])
        return mix(mix(rows + place * _STEP).sum(axis=2, dtype=np.uint64))
