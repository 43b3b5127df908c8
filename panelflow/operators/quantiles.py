"""Exact quantiles of many columns without sorting or gathering whole columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Bits of a value's 64-bit key that each round tells apart.  A round orders at most 2 ** bits counts per
# feature and rank in one task; more rounds would order fewer and read the values more often.
ROUND_BITS = (22, 21, 21)


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value)`` rows without missing values."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    return df.select(F.inline(pairs)).filter("value IS NOT NULL AND NOT isnan(value)")


def with_ordered_key(df: DataFrame, value: str = "value", out: str = "key") -> DataFrame:
    """``df`` with a long that orders as the double ``value`` does: exponent, then mantissa; both zeros are 0.

    The exponent is put right where the logarithm was rounded over a power of two; powers of two
    and quotients by them are exact.  Below the normal doubles the mantissa alone counts.
    """
    size, least = f"abs({value})", 2.0**-1022
    near = F.expr(f"cast(least(floor(log2({size})), 1023) AS int)")
    exponent = F.expr(f"_near - if(pow(2.0D, _near) > {size}, 1, 0) + if(_near < 1023 AND pow(2.0D, _near + 1) <= {size}, 1, 0)")
    key = F.expr(
        f"CASE WHEN {size} = double('Infinity') THEN {2**63 - 1}L WHEN {size} < {least!r}D THEN cast({size} / {2.0**-1074!r}D AS bigint) "
        f"ELSE (_exponent + 1023) * {2**52}L + cast(({size} / pow(2.0D, _exponent) - 1) * {2**52}D AS bigint) END * if({value} < 0, -1L, 1L)"
    )
    return df.withColumn("_near", near).withColumn("_exponent", exponent).withColumn(out, key).drop("_near", "_exponent")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(feature, quantiles ARRAY<DOUBLE>)`` with linear interpolation between ranks.

    Repeated selection on the values' 64-bit keys.  Each round counts the rows by the next
    bits among rows that share the bits of a wanted rank so far (counts per task are
    shuffled), which gives the next bits of every wanted rank; after the last round a single value is
    left per rank.  Values are never ordered or gathered: however many there are, no task orders
    more counts than ``ROUND_BITS`` allow.
    """
    keyed = with_ordered_key(long_values(df, cols))
    digits = [F.shiftright("key", 64 - sum(ROUND_BITS[: r + 1])).alias(f"k{r}") for r in range(len(ROUND_BITS))]
    values = keyed.select("feature", "value", *digits)
    ranks = [
        F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), ((F.col("total") - 1) * F.lit(float(p))).alias("at"))
        for i, p in enumerate(probs)
        for side in (0, 1)
    ]
    for r in range(len(ROUND_BITS)):
        digit = f"k{r}"
        if r == 0:
            shared, inside = ["feature"], values
        else:
            # One row per prefix that holds a wanted rank: at most len(cols) * 2 * len(probs).
            shared = ["feature", f"k{r - 1}", "ranks"]
            inside = values.join(F.broadcast(wanted), shared[:2])
        counts = inside.groupBy(*shared, digit).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))
        places = counts.withColumn("end", F.sum("n").over(Window.partitionBy(*shared).orderBy(digit)))
        if r == 0:
            places = places.withColumn("total", F.sum("n").over(Window.partitionBy("feature")))
            rank = F.when(F.col("side") == 0, F.floor("at")).otherwise(F.ceil("at"))
            rows = places.select("*", F.inline(F.array(*ranks))).withColumn("rank", rank)
        else:
            rows = places.select("*", F.inline("ranks"))
        # From here on ranks count from the first row of the digit they fall into.
        begin = F.col("end") - F.col("n")
        placed = rows.filter((F.col("rank") >= begin) & (F.col("rank") < F.col("end"))).withColumn("rank", F.col("rank") - begin)
        # Grouped by the prefix as well, rows stay where the counts put them.
        found = placed.groupBy(*shared, digit).agg(F.sort_array(F.collect_list(F.struct("i", "side", "at", "rank"))).alias("_ranks"))
        wanted = found.select("feature", digit, F.col("_ranks").alias("ranks"))

    def value_at(side: int) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("value")))

    low, high = value_at(0), value_at(1)
    # Equal neighbours may be infinite.
    quantile = F.when(low == high, low).otherwise(low + (high - low) * F.max(F.col("at") - F.floor("at")))
    return (
        placed.groupBy("feature", "i")
        .agg(quantile.alias("q"))
        .groupBy("feature")
        .agg(F.sort_array(F.collect_list(F.struct("i", "q"))).alias("qs"))
        .select("feature", F.col("qs.q").alias("quantiles"))
    )


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value)``: the most frequent value, the smallest among ties."""
    counts = long_values(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy("feature").agg(best["value"].alias("value"))
