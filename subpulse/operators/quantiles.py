"""Exact interpolated percentiles of whole-number columns, without a group in one task.

The built-in exact ``percentile`` keeps one counter per distinct value of a
group in a single buffer. Here rows are counted per value once, and these counts
are rolled up to histograms of ever wider buckets, 2^16 values of one level to a
bucket of the next. The wanted ranks are then followed down from the top. A
bucket holds at most 65,536 buckets of the level below, and only those meet the
ranks, so no task sees more of a group, however its values are spread.

Building the frame runs no job, and the source is read once: every level comes
out of the same counts, whose shuffle Spark reuses. For that the branches must
scan alike, so they are joined by null-safe equality: from a plain one Spark
would infer filters that differ from branch to branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS, _LEVELS = 16, 4  # four levels of 16 bits are all of a bigint


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      probabilities: dict[str, float]) -> DataFrame:
    """One row per group with a linearly interpolated percentile per name in ``probabilities``.

    ``value`` is a whole-number column; rows with a NULL value or key are left out.
    """
    rows = df.selectExpr(*keys, f"CAST({value} AS BIGINT) AS _bucket").filter(
        " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "_bucket"]))
    levels = [rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))]
    for _ in range(_LEVELS - 1):
        levels.append(levels[-1].groupBy(*keys, F.shiftright("_bucket", _BITS).alias("_bucket")).agg(
            F.sum("_n").alias("_n")))

    # positions are (n - 1) * p, between the values ranked floor and ceiling
    ranks = ", ".join(
        f"struct({p}D AS _p, '{side}' AS _side, (_total - 1) * {p}D - floor((_total - 1) * {p}D) AS _part, "
        f"CAST({edge}((_total - 1) * {p}D) AS BIGINT) AS _rank)"
        for p in sorted(set(probabilities.values())) for side, edge in (("low", "floor"), ("high", "ceil")))
    group = ", ".join(keys)
    falls_here = "_rank >= _upto - _n AND _rank < _upto"
    # the bucket a rank falls in becomes the parent of the next level, the rank relative to it
    inside = [*keys, "_bucket AS _parent", "_p", "_side", "_part", "_rank - (_upto - _n) AS _rank"]
    top = levels.pop().selectExpr("*", f"sum(_n) OVER (PARTITION BY {group} ORDER BY _bucket) AS _upto",
                                  f"sum(_n) OVER (PARTITION BY {group}) AS _total")
    wanted = top.selectExpr("*", f"inline(array({ranks}))").filter(falls_here).selectExpr(*inside)
    while levels:
        below = levels.pop().withColumn("_parent", F.shiftright("_bucket", _BITS))
        above = wanted.withColumnsRenamed({c: f"_its_{c}" for c in (*keys, "_parent")})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_its_{c}")) for c in (*keys, "_parent")])
        wanted = (below.join(above, same)
                  .selectExpr("*", f"sum(_n) OVER (PARTITION BY {group}, _p, _side ORDER BY _bucket) AS _upto")
                  .filter(falls_here).selectExpr(*inside))

    def value_at(p: float, side: str) -> str:
        return f"max(CAST(_parent AS DOUBLE)) FILTER (WHERE _p = {p}D AND _side = '{side}')"

    return wanted.groupBy(*keys).agg(*[
        F.expr(f"{value_at(p, 'low')} + ({value_at(p, 'high')} - {value_at(p, 'low')}) "
               f"* max(_part) FILTER (WHERE _p = {p}D)").alias(name)
        for name, p in probabilities.items()])
