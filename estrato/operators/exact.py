"""Sums of doubles that are exact over their whole range, in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of a band of exponents, and places of a value inside its band.
_DIGITS, _PLACES = 8, 19
_BASE = 10**_DIGITS
# Positions that the fraction of a band reaches into.
_BELOW = -(-_PLACES // _DIGITS)


# What partial results of an aggregate merge with.
_MERGED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def exact_sums(
    df: DataFrame, by: Sequence[str], measures: dict[str, Column | str], others: dict[str, tuple[str, Column | str]] | None = None
) -> DataFrame:
    """Sum of each ``{alias: measure}`` per group as the double nearest to the exact sum; NULL for no values.

    Every value counts as the shortest decimal that stands for it, like in SQL text.  Values are added as integers and
    decimal fractions per band of eight decimal exponents, which no order of additions can change and no magnitude can
    overflow; the few bands of a group are then added digit by digit.  With a NaN or an infinity the plain sum is the
    answer in any order too.  A hot group is one row per task and band before the shuffle.  A band of a group may hold
    9 * 10**10 values at the upper end of the band, and more below.

    ``others`` are further aggregates of the same groups, ``{alias: (sum, count, min or max, column)}``; sums of those
    are Spark's own, meant for integers.
    """
    # The columns have names of their own in here, whatever the groups are called.
    names, others, keys = list(measures), others or {}, [f"_k{i}" for i in range(len(by))]
    group = [F.col(c).alias(k) for c, k in zip(by, keys)]
    beside = [(c if isinstance(c, Column) else F.col(c)).alias(f"_o{i}") for i, (_, c) in enumerate(others.values())]
    columns = [m if isinstance(m, Column) else F.col(m) for m in measures.values()]
    pairs = F.array(*[F.struct(F.lit(i).alias("_m"), c.cast("double").alias("_x")) for i, c in enumerate(columns)])
    if len(names) == 1:
        rows = df.select(*group, *beside, F.lit(0).alias("_m"), columns[0].cast("double").alias("_x"))
    else:
        rows = df.select(*group, *beside, F.inline(pairs))
    x = F.col("_x")
    finite = ~F.isnan("_x") & (F.abs("_x") < float("inf"))
    # These have no exponent in their text, and need no taking apart.
    plain = ((F.abs("_x") >= 1e-3) & (F.abs("_x") < 1e7)) | (x == 0)
    text = F.when(finite & ~plain, x.cast("string"))
    exponent = F.coalesce(F.substring_index(text, "E", -1).try_cast("int"), F.lit(0))
    rows = rows.withColumns({"_text": text, "_exponent": exponent})
    rows = rows.withColumn("_band", F.when(finite, F.floor(F.col("_exponent") / _DIGITS).cast("int")))
    shifted = F.concat(F.substring_index("_text", "E", 1), F.lit("E"), F.col("_exponent") - _DIGITS * F.col("_band"))
    kind = f"decimal(28,{_PLACES})"
    value = F.when(plain, F.when(plain, x).cast(kind)).otherwise(shifted.cast(kind))
    rows = rows.withColumn("_v", value).withColumn("_whole", F.floor("_v").cast("bigint"))
    part = (F.col("_v") - F.col("_whole").cast("decimal(9,0)")).cast(f"decimal(28,{_PLACES})")
    # Each row is there once for every measure, so the others count with the first.
    own = [getattr(F, f)(F.when(F.col("_m") == 0, F.col(f"_o{i}"))).alias(f"_o{i}") for i, (f, _) in enumerate(others.values())]
    sums = [F.sum("_whole").alias("_whole"), F.sum(part).alias("_part"), F.sum(F.when(~finite, x)).alias("_other")]
    bands = rows.groupBy(*keys, "_m", "_band").agg(*sums, *own)

    sums = F.struct(F.col("_band").alias("band"), F.col("_whole").alias("whole"), F.col("_part").alias("part"))
    out = []
    for i, name in enumerate(names):
        mine = F.col("_m") == i
        found = F.collect_list(F.when(mine & F.col("_band").isNotNull(), sums))
        out.append(F.coalesce(F.sum(F.when(mine, F.col("_other"))), _nearest(found)).alias(name))
    out += [_MERGED[f](f"_o{i}").alias(name) for i, (name, (f, _)) in enumerate(others.items())]
    found = bands.groupBy(*keys).agg(*out)
    return found.withColumnsRenamed(dict(zip(keys, by)))


def _limbs(band: Column) -> Column:
    """A band's sum as a number for its own position and one of eight digits for each position below."""
    text = band["part"].cast("string")  # not negative, always with all places
    places = F.rpad(F.substring_index(text, ".", -1), _DIGITS * _BELOW, "0")
    own = (band["whole"] + F.substring_index(text, ".", 1).cast("bigint")).alias("l0")
    below = [F.substr(places, F.lit(_DIGITS * i + 1), F.lit(_DIGITS)).cast("bigint").alias(f"l{i + 1}") for i in range(_BELOW)]
    return F.struct(band["band"].alias("band"), own, *below)


def _nearest(bands: Column) -> Column:
    """The double nearest to the sum of all bands; NULL if there are none."""
    one = F.get(bands, F.lit(0))
    # Nearly always there is one band, whose sum is one decimal.
    single = (F.size(bands) == 1) & (F.abs(one["whole"]) < 10**18) & (one["part"] < 10**9)
    total = one["whole"].cast("decimal(18,0)") + one["part"].cast(f"decimal(28,{_PLACES})")
    alone = F.concat(total.cast("string"), F.lit("E"), one["band"] * _DIGITS).cast("double")
    several = F.get(F.transform(F.array(F.transform(bands, _limbs)), _of_several), F.lit(0))
    return F.when(F.size(bands) == 0, None).when(single, alone).otherwise(several)


def _of_several(bands: Column) -> Column:
    """The sum of several bands, digit by digit."""
    low = F.array_min(F.transform(bands, lambda b: b["band"])) - _BELOW
    # Carries of 18 digits reach three positions up.
    high = F.array_max(F.transform(bands, lambda b: b["band"])) + 3

    def at(position: Column, sign: int) -> Column:
        def add(total: Column, band: Column) -> Column:
            here = F.lit(0).cast("bigint")
            for i in range(_BELOW + 1):
                here = F.when(band["band"] - i == position, band[f"l{i}"]).otherwise(here)
            return total + here * sign

        return F.aggregate(bands, F.lit(0).cast("bigint"), add)

    def carried(sign: int) -> Column:
        """Digits from the lowest position up, and what is carried out of the highest."""

        def step(state: Column, position: Column) -> Column:
            total = state["carry"] + at(position, sign)
            digit = F.pmod(total, F.lit(_BASE))
            carry = F.call_function("div", total - digit, F.lit(_BASE))
            return F.struct(carry.alias("carry"), F.concat(F.lpad(digit.cast("string"), _DIGITS, "0"), state["digits"]).alias("digits"))

        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("digits"))
        return F.aggregate(F.sequence(low, high), start, step)

    def value(sign: int) -> Column:
        return F.concat(carried(sign)["digits"], F.lit("E"), low * _DIGITS).cast("double")

    return F.when(carried(1)["carry"] < 0, -value(-1)).otherwise(value(1))
