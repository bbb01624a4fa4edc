"""Table changes: from the old state of a table to its new state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.operators.dedup import unique_on
from estrato.operators.shape import conform


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows, matched by name and converted to the table's types."""
    return table.unionByName(_as_table(rows, table))


def update_where(table: DataFrame, condition: str, values: dict[str, Column | str]) -> DataFrame:
    """Set columns (SQL text or Column, over the old row) where the condition is true."""
    hit = F.expr(condition)
    types = dict(table.dtypes)

    def new(c: str) -> Column:
        value = values[c]
        value = F.expr(value) if isinstance(value, str) else value
        return F.when(hit, value.cast(types[c])).otherwise(F.col(c))

    return table.select(*[new(c).alias(c) if c in values else F.col(c) for c in table.columns])


def delete_where(table: DataFrame, condition: str) -> DataFrame:
    """Drop the rows for which the condition is true; NULL keeps a row."""
    return table.filter(~F.coalesce(F.expr(condition), F.lit(False)))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], bulk: bool = False) -> DataFrame:
    """Replace the rows whose key is in ``rows``, add the rows whose key is new.

    A source row wins as a whole, NULLs included.  The query fails if a source
    key repeats.  Rows without a key match nothing and are added.

    The table is joined on the left with the changes on the right, so that the
    usual few changes are broadcast (by size, Spark's decision) and the table is
    not shuffled; new keys are found against the matched keys, not the table.
    ``bulk`` is for changes of a size with the table: one full outer join, which
    shuffles both sides once.  Both read ``rows`` more than once, so store it
    first if it is dear to compute.
    """
    rows = _as_table(rows, table)
    values = [c for c in table.columns if c not in keys]
    keyed = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    changes = unique_on(rows.filter(keyed), keys)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c) for c in values], F.lit(True).alias("_here")).alias(name))

    if bulk:
        both = packed(table, "_old").join(packed(changes, "_new"), list(keys), "full_outer")
        out = both.select(*[F.col(c) if c in keys else _newer(c, F.col(f"_old.`{c}`")) for c in table.columns])
    else:
        both = table.join(packed(changes, "_new"), list(keys), "left")
        out = both.select(*[F.col(c) if c in keys else _newer(c, F.col(c)) for c in table.columns])
        matched = table.select(*keys).join(changes.select(*keys), list(keys), "left_semi").distinct()
        out = out.unionByName(changes.join(matched, list(keys), "left_anti").select(*table.columns))
    return out.unionByName(rows.filter(f"NOT ({keyed})"))


def _newer(column: str, old: Column) -> Column:
    return F.when(F.col("_new").isNotNull(), F.col(f"_new.`{column}`")).otherwise(old).alias(column)


def as_of(
    log: DataFrame, keys: Sequence[str], at, version: str = "version", deleted: str = "deleted"
) -> DataFrame:
    """State of a table at a version or time, from its log of row changes.

    ``log`` holds one row per change with the whole new row, an orderable
    ``version`` column and a ``deleted`` flag, which counts as not set if NULL.  Per key the last change up to
    ``at`` counts, as an aggregate that combines before the shuffle.
    """
    values = [c for c in log.columns if c not in (*keys, version, deleted)]
    at = at if isinstance(at, Column) else F.lit(at)
    last = (
        log.filter(F.col(version) <= at)
        .groupBy(*keys)
        .agg(F.max(F.struct(version, deleted, *values)).alias("_last"))
    )
    return last.filter(~F.coalesce(F.col(f"_last.`{deleted}`"), F.lit(False))).select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in values])


def intervals(
    log: DataFrame, keys: Sequence[str], block: Column, version: str = "version", deleted: str = "deleted"
) -> DataFrame:
    """The log of row changes as rows with the time they are valid: from ``valid_from`` until before ``valid_to``.

    ``log`` is as in ``as_of``.  The last state of a key has no ``valid_to``; a deletion ends the state before it.
    ``block`` is a coarse version (a month of a time, a thousand of numbers) that grows with the version.  The next
    change of a row is looked for within the key's block, and only for the last row of a block in the blocks behind
    it, so that a hot key is no more rows in one task than a block holds of it, and one row per block.

    Partitioned by ``with_ends``, the table is read as of a version by ``valid_at``, which skips the folders of all
    states that had ended before.
    """
    values = [c for c in log.columns if c not in (*keys, version, deleted)]
    state = F.max(F.struct(F.coalesce(F.col(deleted), F.lit(False)).alias("gone"), deleted, *values)).alias("_state")
    changes = log.groupBy(*keys, block.alias("_block"), version).agg(state)
    firsts = changes.groupBy(*keys, "_block").agg(F.min(version).alias("_first"))
    behind = Window.partitionBy(*keys).orderBy("_block")
    later = firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"), F.lead("_first").over(behind).alias("_later"))
    within = Window.partitionBy(*keys, "_block").orderBy(version)
    nexts = changes.withColumn("_next", F.lead(version).over(within))
    same = F.col("_b").eqNullSafe(F.col("_block"))
    for i, k in enumerate(keys):
        same &= F.col(f"_k{i}").eqNullSafe(F.col(k))
    joined = nexts.join(later, same, "left").withColumn("valid_to", F.coalesce("_next", "_later"))
    kept = [F.col(f"_state.`{c}`").alias(c) for c in values]
    return joined.filter("NOT _state.gone").select(*keys, *kept, F.col(version).alias("valid_from"), "valid_to")


def with_ends(rows: DataFrame, block: Callable[[Column], Column], last) -> DataFrame:
    """Intervals with ``ends``, the block of their end, to partition a table by; ``last`` stands for no end."""
    return rows.withColumn("ends", F.coalesce(block(F.col("valid_to")), F.lit(last)))


def valid_at(rows: DataFrame, at, block: Callable[[Column], Column]) -> DataFrame:
    """Rows of a table of intervals that are valid at a version; only folders that end later are read."""
    at = at if isinstance(at, Column) else F.lit(at)
    valid = rows.filter((F.col("ends") >= block(at)) & (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
    return valid.drop("valid_from", "valid_to", "ends")


def _as_table(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with the table's columns; absent ones are NULL, a column that the table has not raises ``ValueError``."""
    unknown = sorted({c.lower() for c in rows.columns} - {c.lower() for c in table.columns})
    if unknown:
        raise ValueError(f"the table has no such columns: {', '.join(unknown)}")
    return conform(rows, dict(table.dtypes), keep_rest=False, optional=table.columns)
