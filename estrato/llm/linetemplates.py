"""Removal of recurring lines (operator 5, log-template tree).

A line's path in a tree of fixed depth is its number of tokens and its first ``depth`` tokens; a token with a
digit is a variable field and counts as one wildcard.  At a leaf, a token that fewer than ``texts`` lines have at its
place is variable too, so the leaf's lines are few different shapes.  They are parsed by agreement, the most frequent
shape first: a shape joins the template with which it shares most tokens behind the path, if they are enough, and the
template keeps the shared ones; otherwise it begins a template.  In the end a line is of the template that it agrees
with at all constant places, the one with most of them.  So a leaf holds any number of templates, and a field that
several of them share does not tear them apart.  Lines of ``short`` tokens or fewer are never generalised.  Lines of
a template that recurs in many texts go, except from the text where it comes first; so do lines that recur word for
word, long ones from the second text on.

Spark counts the texts of leaves, the different masked lines, and their tokens; one task parses the shapes of a leaf,
and of a crowded leaf those that share a longer path.  Only lines of leaves that recur, and long lines that are met
twice, can go; they are few: a bitmap of bounded size tells the second reading which lines to report at all, and
joins and counts which are right.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import WORD_BASES, drop_written, in_sieve, mix, run_hashes, saved, sieve, slices, text_buffers, word_hashes, word_spans
from estrato.llm.vectors import matrix


@dataclass(frozen=True)
class Rule:
    """When a line recurs.

    ``depth`` leading tokens are the path.  A template goes that is in ``texts`` different texts; at ``constant`` of its
    places behind the path a token is fixed, and at least ``least`` of them have no digit.  Lines of ``short`` tokens or
    fewer go only if they are equal word for word in so many texts, lines of ``long`` tokens or more if they are so in
    ``copies``.  A task parses at most ``shapes`` different shapes at once, of at most ``tokens`` tokens if they are more
    than 16; a leaf that has more gets longer paths.
    """

    depth: int = 3
    texts: int = 20
    constant: float = 0.6
    short: int = 5
    least: int = 2
    long: int = 20
    copies: int = 2
    shapes: int = 4096
    tokens: int = 1 << 21


#: A token with a digit, and a place that no template's constant token can be at.
WILD, VARIABLE = 0x5EED << 32, 0


class _Lines:
    """The lines with at least one token of consecutive texts."""

    def __init__(self, batch: pa.RecordBatch, depth: int):
        data, offsets = text_buffers(batch.column("text"))
        starts, ends, before = word_spans(data, offsets)
        tokens = word_hashes(data, starts, ends)
        tokens[tokens == VARIABLE] = 1
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        whole = tokens.copy()
        tokens[digits[ends] > digits[starts]] = WILD
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        doc = np.repeat(np.arange(len(before) - 1), np.diff(before))
        number = breaks[starts] - breaks[offsets[:-1]][doc]
        first = np.ones(len(starts), bool)
        first[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        self.heads = np.flatnonzero(first)
        self.counts = np.diff(np.append(self.heads, len(starts)))
        self.doc, self.number, self.tokens = doc[self.heads], number[self.heads], tokens
        leaf = mix(self.counts.astype(np.uint64))
        for d in range(depth):
            there = self.counts > d
            leaf[there] = mix(leaf[there] ^ tokens[self.heads[there] + d])
        self.leaf = leaf.view(np.int64)
        self.exact = run_hashes(whole, self.heads, self.heads + self.counts, WORD_BASES[1]).view(np.int64)
        self.masked = run_hashes(tokens, self.heads, self.heads + self.counts, WORD_BASES[0]).view(np.int64)

    def token_lists(self, lines: np.ndarray, there: np.ndarray) -> pa.Array:
        """The masked tokens of some lines, nothing of those that are not ``there``."""
        counts = np.where(there, self.counts[lines], 0)
        places = np.repeat(self.heads[lines] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, self.tokens[places].view(np.int64))


def _keys(rule: Rule):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = _Lines(part, rule.depth)
                long = np.flatnonzero(lines.counts >= rule.long)
                doc = np.concatenate([lines.doc, lines.doc[long]])
                least = np.repeat(np.array([rule.texts, min(rule.texts, rule.copies)], np.int32), [len(lines.doc), len(long)])
                key = np.concatenate([lines.leaf, lines.exact[long]])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(least), pa.array(part.column("hash").to_numpy()[doc])], ["leaf", "least", "hash"])

    return work


def _lines(rule: Rule, bits: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = _Lines(part, rule.depth)
                leaf, long = in_sieve(bits, lines.leaf), lines.counts >= rule.long
                some = np.flatnonzero(leaf | long & in_sieve(bits, lines.exact))
                doc = pa.array(lines.doc[some])
                least = np.where(long[some], min(rule.texts, rule.copies), rule.texts).astype(np.int32)
                tokens = lines.token_lists(some, leaf[some] & (lines.counts[some] > max(rule.short, rule.depth)))
                columns = {"doc_id": part.column("doc_id").take(doc), "node": part.column("node").take(doc), "line": pa.array(lines.number[some].astype(np.int32)), "least": pa.array(least), "tokens": tokens}
                columns |= {name: pa.array(getattr(lines, name)[some]) for name in ("leaf", "exact", "masked")}
                yield pa.RecordBatch.from_pydict(columns)

    return work


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("text").isNotNull()).select("doc_id", "text", F.unhex(F.md5("text")).alias("node"), F.xxhash64("text").alias("hash"))


def _recurring(lines: DataFrame, key: str, least: Column) -> DataFrame:
    """(key, first) of the values of ``key`` in ``least`` texts or more, and the text where each comes first."""
    counted = lines.groupBy(key, "node").agg(F.min("doc_id").alias("doc_id"), F.first(least).alias("least")).groupBy(key)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    many = counted.agg(F.count("*").alias("texts"), F.min(order).alias("first"), F.min("least").alias("least")).filter("texts >= least")
    # Written, so that Spark may split a key with many lines when it joins them.
    return saved(many.select(key, F.col("first.node").alias("first")))


def templates(shapes: np.ndarray, counts: np.ndarray, rule: Rule) -> np.ndarray:
    """The template of each of some different shapes of one leaf: a row of tokens, ``VARIABLE`` where any token fits."""
    behind = shapes.copy()
    behind[:, : rule.depth] = VARIABLE
    need = max(rule.constant * (shapes.shape[1] - rule.depth), rule.least)
    order = np.lexsort((*shapes.T[::-1], -counts))
    found, size = np.empty_like(shapes), 0
    for line in behind[order]:
        shared = (found[:size] == line) & (line != VARIABLE)
        share = shared.sum(axis=1)
        share[(shared & (line != WILD)).sum(axis=1) < rule.least] = 0
        best = int(np.argmax(share)) if size else 0
        if size and share[best] >= need:
            found[best][~shared[best]] = VARIABLE
        else:
            found[size] = line
            size += 1
    found = found[:size]
    out, fixed = np.empty_like(shapes), (found != VARIABLE).sum(axis=1)
    for i, line in enumerate(behind):
        agrees = ((found == line) | (found == VARIABLE)).all(axis=1)
        out[i] = found[np.argmax(np.where(agrees, fixed, -1))]
    return out


def _parsed(rule: Rule):
    def work(items: pa.Table) -> pa.Table:
        shapes = matrix(items.column("shape"), len(items.column("shape")[0]))
        key = mix(items.column("part").to_numpy().view(np.uint64))
        for token in templates(shapes, items.column("n").to_numpy(), rule).T:
            key = mix(key ^ token.view(np.uint64))
        return pa.table([items.column("id"), pa.array(key.view(np.int64))], names=["id", "template"])

    return work


def _deeper(shapes: DataFrame, rule: Rule) -> DataFrame:
    """``shapes`` with the part of its leaf that each is parsed in: the shortest path that few enough shapes share."""
    limit = F.greatest(F.least(F.lit(rule.shapes), F.lit(rule.tokens) / F.first(F.size("shape"))), F.lit(16))
    crowded = shapes.groupBy("leaf").agg(F.count("*").alias("all"), limit.alias("limit")).filter("all > limit")
    deep = shapes.join(crowded, "leaf").select("id", "shape", F.explode(F.sequence(F.lit(rule.depth + 1), F.size("shape"))).alias("depth"), "leaf", "limit")
    paths = deep.select("id", "depth", F.xxhash64("leaf", F.slice("shape", 1, F.col("depth"))).alias("part"), "limit")
    few = paths.groupBy("part").agg(F.count("*").alias("all"), F.first("limit").alias("limit")).filter("all <= limit").drop("limit")
    parts = paths.join(few, "part").groupBy("id").agg(F.min_by("part", "depth").alias("part"))
    return shapes.join(parts, "id", "left").withColumn("part", F.coalesce("part", "leaf"))


def _masked(rule: Rule):
    """(masked, leaf, n, shape) of the lines with enough tokens at ``places``; other tokens are variable in the shape."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, places = batch.column("tokens"), batch.column("places")
            values, starts = tokens.flatten().to_numpy().copy(), np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy())])
            line, held = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy()), np.zeros(len(values), bool)
            held[starts[line] + places.flatten().to_numpy()] = True
            values[~held] = VARIABLE
            line = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            behind = held & (np.arange(len(values)) - starts[line] >= rule.depth)
            fixed, words = (np.bincount(line[some], minlength=batch.num_rows) for some in (behind, behind & (values != WILD)))
            able = (fixed >= rule.constant * (np.diff(starts) - rule.depth)) & (words >= rule.least)
            shape = pa.ListArray.from_arrays(starts.astype(np.int32), values)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("masked", "leaf", "n")], shape], ["masked", "leaf", "n", "shape"]).filter(pa.array(able))

    return work


def _shapes(lines: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(masked, id) of the masked lines that can be of a template, and (id, leaf, shape, n) of their shapes."""
    different = saved(lines.groupBy("masked").agg(F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"), F.count("*").alias("n")))
    each = different.select("leaf", "masked", "n", F.posexplode("tokens").alias("place", "token"))
    each = each.select("masked", "n", "place", F.xxhash64("leaf", "place", "token").alias("key"))
    often = saved(each.groupBy("key").agg(F.sum("n").alias("all")).filter(F.col("all") >= rule.texts).select("key"))
    held = each.drop("n").join(often, "key").groupBy("masked").agg(F.collect_list("place").alias("places"))
    shaped = different.join(held, "masked").select("masked", "leaf", "n", "tokens", "places").mapInArrow(_masked(rule), "masked long, leaf long, n long, shape array<long>")
    shaped = saved(shaped.withColumn("id", F.xxhash64("leaf", "shape")))
    for done in (different, often):
        drop_written(done)
    return shaped, shaped.groupBy("id").agg(F.first("leaf").alias("leaf"), F.first("shape").alias("shape"), F.sum("n").alias("n"))


def _of_templates(lines: DataFrame, rule: Rule) -> DataFrame:
    """(masked, template) of the lines that are of a template."""
    shaped, shapes = _shapes(lines, rule)
    shapes = saved(shapes)
    found = _deeper(shapes, rule).select("part", "id", "shape", "n").groupBy("part").applyInArrow(_parsed(rule), "id long, template long")
    out = saved(shaped.select("masked", "id").join(found, "id").select("masked", "template"))
    for done in (shaped, shapes):
        drop_written(done)
    return out


def recurring_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(node, lines): for each text, by its MD5 digest, the numbers of its lines that go, from 0."""
    whole = _texts(docs)
    met = whole.mapInArrow(_keys(rule), "leaf long, least int, hash long").distinct()
    leaves = saved(met.groupBy("leaf", "least").agg(F.count("*").alias("texts")).filter("texts >= least").select("leaf"))
    found = whole.mapInArrow(_lines(rule, sieve(leaves, "leaf")), "doc_id long, node binary, line int, least int, tokens array<long>, leaf long, exact long, masked long")
    once = found.groupBy("node", "line").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("leaf", "exact", "masked", "least", "tokens")])
    every = saved(once)

    equal = _recurring(every, "exact", F.col("least"))
    spent, gone = [leaves, every, equal], [every.join(equal, "exact").filter("node <> first").select("node", "line")]
    lines = every.filter(F.size("tokens") > 0)
    if not lines.isEmpty():
        parsed = _of_templates(lines, rule)
        told = saved(lines.select("node", "doc_id", "line", "masked").join(parsed, "masked").drop("masked"))
        many = _recurring(told, "template", F.lit(rule.texts))
        gone.append(told.join(many, "template").filter("node <> first").select("node", "line"))
        spent += [parsed, told, many]
    out = saved(functools.reduce(DataFrame.union, gone).groupBy("node").agg(F.collect_set("line").alias("lines")))
    for done in spent:
        drop_written(done)
    return out


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of lines as an array with a flag for each line up to the last of them."""
    for batch in batches:
        lines = batch.column("lines")
        numbers, counts = lines.flatten().to_numpy(), lines.value_lengths().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), counts)
        sizes = np.zeros(batch.num_rows, np.int64)
        np.maximum.at(sizes, row, numbers + 1)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flags = np.zeros(starts[-1], bool)
        flags[starts[row] + numbers] = True
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(counts), pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(flags))], ["node", "lines", "gone"])


def kept_lines(text: Column, gone: Column) -> Column:
    """A text without the lines whose flags are set."""
    kept = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.coalesce(F.get(gone, i), F.lit(False)))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept, "\n"))


def drop_recurring(docs: DataFrame, rule: Rule = Rule(), dropped: str | None = None) -> DataFrame:
    """``docs``, all columns and rows, without the recurring lines in ``text``; ``dropped`` names a column for their number.

    Lines end at a line feed, tokens at ASCII white space.  Lines without a token stay and are never counted.
    A template goes that is in ``rule.texts`` different texts or more, and a line of ``rule.long`` tokens or more that is
    word for word the same in ``rule.copies``: exact copies count once and are treated
    alike, so repeated rows stay equal.  It stays in the text with the smallest doc_id (nulls last), and by
    digest of equal ones.  A null or empty text stays as it is.
    """
    gone = recurring_lines(docs, rule).mapInArrow(_flags, "node binary, lines int, gone array<boolean>")
    packed = docs.select(F.struct("*").alias("row"), F.unhex(F.md5("text")).alias("digest"))
    joined = packed.join(gone.withColumnRenamed("node", "digest"), "digest", "left")
    columns = [kept_lines(F.col("row.text"), F.col("gone")).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    if dropped:
        columns.append(F.coalesce("lines", F.lit(0)).cast("long").alias(dropped))
    return joined.select(*columns)
