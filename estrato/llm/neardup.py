"""Near-duplicate classes of texts (operator 7, BagMinHash).

1. Every text gets a BagMinHash signature of its bag of word shingles.  Equal texts are one node from here on.
2. Signatures are cut into bands.  Texts that agree in a band are compared by their signatures; those whose
   estimate is not clearly below the threshold are suspects.
3. In each component of suspects the bags themselves are compared: texts are linked if their multiset
   Jaccard similarity reaches the threshold.  Components of links are the classes.

A task never gets an unbounded group: a bucket or a component is dealt into blocks.  Its least text goes to every
block and is compared with all others, which is linear; texts linked with it need no link among themselves.  The
rest is compared with all texts, every pair of blocks being a task's group, so no link is lost.  What a group returns
is a spanning forest of its links, never all pairs; texts that a chain of links joins already need no further link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm import bagminhash
from estrato.llm.common import drop_written, in_sieve, partitions, sieve, slices, written
from estrato.llm.components import components

WORDS, SIMILARITY = 5, 0.8
#: Bands and components in each: texts with a similarity of 0.8 meet in a band with probability 0.9993.
BANDS, ROWS = 24, 6
#: Standard deviations that an estimate may lie below the threshold.
SLACK = 3.5
#: Texts and shingles of a block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 19
#: Words of 64 bits up to which bags are compared as bit sets; beyond, the same counts come from lists.
BITS = 1 << 23


def text_node(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def _sign(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, hashes, weights = bagminhash.bags(part.column("text"), words)
                found = bagminhash.signatures(doc, hashes, weights, part.num_rows, BANDS * ROWS)
                size = np.bincount(doc, weights, part.num_rows).astype(np.int64)
                keys = bagminhash.band_keys(found, BANDS).view(np.int64)
                short = found.astype(np.uint16)  # 16 bits a component are enough for an estimate
                bands = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * BANDS, keys.ravel())
                out = pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.array(size), pa.array([r.tobytes() for r in short], pa.binary()), bands], ["doc_id", "node", "size", "signature", "bands"])
                yield out.filter(pa.array(size > 0))

    return work


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows of one (key, low, high) in one partition, one after the other, by their nodes."""
    keys = ["key", "low", "high"]
    return rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "node")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, int]]:
    """Runs of equal (key, low, high) in sorted batches; a run that goes on in the next batch is held back."""
    held: list[pa.Table] = []

    def cut(table: pa.Table, last: bool):
        if not table.num_rows:
            return
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for name in ("key", "low", "high"):
            codes = table.column(name).combine_chunks().dictionary_encode()
            codes = codes.indices if isinstance(codes, pa.DictionaryArray) else pa.concat_arrays([c.indices for c in codes.unify_dictionaries().chunks])
            codes = codes.to_numpy()
            change[1:] |= codes[1:] != codes[:-1]
        heads = [*np.flatnonzero(change).tolist(), table.num_rows]
        if not last:
            held.append(table.slice(heads[-2]))
            heads.pop()
        yield from ((table, a, b) for a, b in zip(heads, heads[1:]))

    for batch in batches:
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
        held.clear()
        yield from cut(table, False)
    if held:
        yield from cut(held.pop(), True)


def forest(count: int, like: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest; ``like(i, others)`` tells which of ``others`` are linked with ``i``."""
    unseen, edges = np.arange(1, count), []
    stack = [0] if count else []
    while stack:
        i = stack.pop()
        linked = like(i, unseen) if len(unseen) else np.zeros(0, bool)
        edges += [(i, int(j)) for j in unseen[linked]]
        stack += unseen[linked].tolist()
        unseen = unseen[~linked]
        if not stack and len(unseen):
            stack, unseen = [int(unseen[0])], unseen[1:]
    return edges


def _first(alike: Callable[[pa.Table], Callable]):
    """A forest of the groups of keys with one block; in others, whether each node is linked with the least one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, low, high in _groups(batches):
            part = table.slice(low, high - low).combine_chunks()
            like, blocks = alike(part), part.column("blocks")[0].as_py()
            if blocks == 1:
                edges = np.array(forest(part.num_rows, like), np.int64).reshape(-1, 2)
                ends, linked = (edges[:, 1], edges[:, 0]), np.ones(len(edges), bool)
            else:
                others = np.arange(1, part.num_rows)
                ends, linked = (others, np.zeros_like(others)), like(0, others) if len(others) else np.zeros(0, bool)
            if len(linked):
                a, b = (part.column("node").take(pa.array(end)) for end in ends)
                keys = part.column("key").take(pa.array(ends[0]))
                yield from pa.table([keys, a, b, pa.array(linked), pa.array(np.full(len(linked), blocks))], ["key", "a", "b", "linked", "blocks"]).combine_chunks().to_batches()

    return work


def _second(alike: Callable[[pa.Table], Callable]):
    """A forest of each group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, low, high in _groups(batches):
            part = table.slice(low, high - low).combine_chunks()
            edges = np.array(forest(part.num_rows, alike(part)), np.int64).reshape(-1, 2)
            if len(edges):
                yield from pa.table([part.column("node").take(pa.array(end)) for end in edges.T], ["a", "b"]).combine_chunks().to_batches()

    return work


def _joined(members: DataFrame, values: DataFrame, alike: Callable[[pa.Table], Callable]) -> DataFrame:
    """(node, component): components of the links among the nodes of each key.

    ``members`` (key, node, least, blocks) tells the least node of each key and in how many blocks its nodes are dealt,
    ``values`` (node, value) what ``alike`` compares.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    places = F.when(F.col("node") == F.col("least"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = members.join(values, "node").withColumn("low", F.explode(places)).withColumn("high", F.col("low"))
    kind = members.schema["key"].dataType.simpleString()
    first = written(_grouped(dealt.drop("least")).mapInArrow(_first(alike), f"key {kind}, a binary, b binary, linked boolean, blocks long"))
    edges = first.filter("linked").select("a", "b")

    dealt = first.filter("blocks > 1")
    counts = dealt.groupBy("key").agg(F.count_if(~F.col("linked")).alias("rest"), F.count("*").alias("texts")).filter("rest > 0")
    if not counts.isEmpty():
        rest = F.ceil(F.col("blocks") * F.col("rest") / F.col("texts"))
        linked = F.ceil(F.col("blocks") * (F.col("texts") - F.col("rest")) / F.col("texts"))
        placed = dealt.join(counts.hint("rebalance"), "key").select("key", F.col("a").alias("node"), "linked", rest.alias("r"), linked.alias("l"))
        # The rest meets all blocks, its own r ones and those of the l of linked nodes; linked nodes meet the rest alone.
        own = F.when(F.col("linked"), F.col("r") + F.pmod(F.xxhash64("node"), F.greatest("l", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), "r"))
        last = F.when(F.col("linked"), F.col("r")).otherwise(F.col("r") + F.col("l")) - 1
        placed = placed.join(values, "node").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        pairs = placed.select("key", "node", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        edges = edges.union(_grouped(pairs).mapInArrow(_second(alike), "a binary, b binary"))
    found = components(edges)
    drop_written(first)
    return found


def _suspects(least: float):
    def alike(part: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
        signature = np.frombuffer(b"".join(part.column("value").to_pylist()), np.uint16).reshape(part.num_rows, -1)
        return lambda i, others: (signature[others] == signature[i]).mean(axis=1) >= least

    return alike


def _bag(words: int, bits: np.ndarray):
    """The bags of the texts whose bits are set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            able = batch.filter(pa.array(in_sieve(bits, batch.column("hash").to_numpy())))
            for part in slices(able, "text"):
                doc, hashes, weights = bagminhash.bags(part.column("text"), words)
                cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
                bags = [bagminhash.elements(hashes[a:b], weights[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])

    return work


def overlap(bags: list[np.ndarray]) -> Callable[[int, np.ndarray], np.ndarray]:
    """A function of one bag and others: how many elements it shares with each of these others."""
    sizes = np.array([len(b) for b in bags])
    values, number, often = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1  # elements of one bag alone are in no intersection
    kept = often[number] > 1
    owner, column = np.repeat(np.arange(len(bags)), sizes)[kept], shared[number[kept]]
    width = -(-int((often > 1).sum()) // 64)
    if len(bags) * width <= BITS:
        bits = np.zeros((len(bags), max(1, width)), np.uint64)
        np.bitwise_or.at(bits, (owner, column // 64), np.uint64(1) << (column % 64).astype(np.uint64))
        return lambda i, others: np.bitwise_count(bits[others] & bits[i]).sum(axis=1, dtype=np.int64)
    cuts = np.searchsorted(owner, np.arange(len(bags) + 1))

    def count(i: int, others: np.ndarray) -> np.ndarray:
        mark = np.zeros(width * 64, bool)
        mark[column[cuts[i] : cuts[i + 1]]] = True
        sums = np.concatenate([[0], np.cumsum(mark[column])])
        return (sums[cuts[1:]] - sums[cuts[:-1]])[others]

    return count


def _links(similarity: float):
    def alike(part: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
        bags = [np.frombuffer(b, np.uint64) for b in part.column("value").to_pylist()]
        sizes = np.array([len(b) for b in bags])
        common = overlap(bags)

        def like(i: int, others: np.ndarray) -> np.ndarray:
            both = common(i, others)
            return both >= similarity * (sizes[i] + sizes[others] - both) - 1e-9

        return like

    return alike


def classes(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, class_id, class_node, first_id) of each row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the class.  Texts are in one class if a chain of links joins them: equal
    texts, or texts whose bags of ``words``-word shingles have a multiset Jaccard similarity of ``similarity`` or
    more.  Words are runs of characters other than ASCII white space; a shorter text is one shingle.  A null text, or one
    without words, is a class of its own with its own doc_id, and its node is null.  Null doc_ids count as the
    largest; a class of them alone has a null class_id.  ``node`` stands for the text, ``class_node`` and ``first_id``
    name the text and the row that represent the class.  Other columns are not read.
    """
    known = docs.select("doc_id", "text", text_node(F.col("text")).alias("node"))
    signed = known.filter("text IS NOT NULL").mapInArrow(_sign(words), "doc_id long, node binary, size long, signature binary, bands array<long>")
    rows = written(signed)
    nodes = written(rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("size").alias("size"), F.first("signature").alias("signature"), F.first("bands").alias("bands")))

    met = nodes.select("node", F.explode("bands").alias("key"))
    counted = met.groupBy("key").agg(F.count("*").alias("texts"), F.min("node").alias("least")).filter("texts > 1")
    members = met.join(counted.select("key", "least", F.ceil(F.col("texts") / BLOCK).alias("blocks")).hint("rebalance"), "key")
    deviation = (similarity * (1 - similarity) / (BANDS * ROWS)) ** 0.5
    suspects = _joined(members, nodes.select("node", F.col("signature").alias("value")), _suspects(similarity - SLACK * deviation))

    some = written(suspects.join(nodes.select("node", "first_id", "size"), "node"))
    bits = sieve(some.select(F.xxhash64("node").alias("hash")), "hash")
    able = known.filter("text IS NOT NULL").select("doc_id", "text", "node", F.xxhash64("node").alias("hash")).mapInArrow(_bag(words, bits), "doc_id long, n binary, bag binary")
    wanted = able.join(some.select("node", "component", "first_id"), (F.col("n") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    bags = written(wanted.select("node", "component", F.col("bag").alias("value")).dropDuplicates(["node"]))
    sizes = some.groupBy("component").agg(F.count("*").alias("texts"), F.sum("size").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("texts") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    # A component of suspects is named by its least text.
    members = bags.select("component", "node").join(sizes.select("component", blocks.alias("blocks")).hint("rebalance"), "component")
    members = members.select(F.col("component").alias("key"), "node", F.col("component").alias("least"), "blocks")
    linked = _joined(members, bags.select("node", "value"), _links(similarity))
    drop_written(bags)

    placed = nodes.select("node", "first_id").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = placed.groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node")).alias("least"))
    named = placed.join(first.hint("rebalance"), "component").select("node", F.col("least.first_id").alias("class_id"), F.col("least.node").alias("class_node"), "first_id")
    out = known.select("doc_id", F.when(F.col("text").isNotNull(), F.col("node")).alias("node")).join(named, "node", "left")
    alone = F.col("class_node").isNull()
    return out.select("doc_id", F.when(~alone, F.col("node")).alias("node"), F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "class_node", "first_id")


def one_of_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that represent their class: the one with the smallest doc_id.

    Rows without words are classes of their own and stay.  Of repeated rows of the representative one stays.
    """
    found = classes(docs, words, similarity).filter("class_node = node AND doc_id <=> first_id").select(F.col("node").alias("n"), F.col("doc_id").alias("d")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), text_node(F.col("text")).alias("n"), (F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("bare"))
    kept = packed.filter(~F.col("bare")).withColumnRenamed("d", "e").withColumnRenamed("n", "m").join(found, (F.col("m") == F.col("n")) & F.col("e").eqNullSafe(F.col("d")))
    once = F.row_number().over(Window.partitionBy("n", "d").orderBy(F.lit(0)))
    kept = kept.select("row", "n", "d").withColumn("once", once).filter("once = 1").select("row")
    return kept.union(packed.filter("bare").select("row")).select("row.*")
