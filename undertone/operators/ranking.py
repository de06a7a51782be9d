"""Ranks and heads of keyed orders without sorting a group in one task.

Rows carry a 60-bit hash ``h``. A group is counted per bucket of the hash's
leading bits; the counts' running sums place whole buckets, and only the rows
of one bucket are ranked together. A group of any share of the data is spread
over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

BITS = 60


def _bucketed(df: DataFrame, h: str, bits: int) -> DataFrame:
    return df.withColumn("__b", F.shiftright(F.col(h), BITS - bits).cast("int"))


def positions(df: DataFrame, h: str, ties: list[str], group: list[str] | None = None, into: str = "position", bits: int = 12, total: str | None = None) -> DataFrame:
    """``into``: the 0-based place of each row in its group's order by (h, ties);
    ``total``: the rows of its group, from the same counts."""
    group = group or []
    b = _bucketed(df, h, bits)
    counts = b.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    over = W.partitionBy(*group).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(over), F.lit(0)))
    extra = []
    if total:
        counts = counts.withColumn(total, F.sum("__n").over(W.partitionBy(*group)))
        extra = [f"r.{total}"]
    counts = counts.drop("__n")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, "__b"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    j = b.alias("l").join(counts.alias("r"), cond).select("l.*", "r.__before", *extra)
    rank = F.row_number().over(W.partitionBy(*group, "__b").orderBy(h, *ties))
    return j.withColumn(into, F.col("__before") + rank - 1).drop("__b", "__before")


def head(df: DataFrame, h: str, ties: list[str], limit: str, group: list[str], bits: int = 12) -> DataFrame:
    """The first ``limit`` (a column, one value a group) rows of every group."""
    return positions(df, h, ties, group, "__pos", bits).filter(F.col("__pos") < F.col(limit)).drop("__pos")


def value_hash(value, descending: bool = False, scale: float = 1e6, top: int = 1 << 40):
    """A ``h`` for ``positions`` that orders like a non-negative number: its
    first 40 bits in steps of 1/scale (equal steps are told apart by ties, so
    give the value itself as the first tie)."""
    step = F.least(F.greatest(F.floor(value * scale), F.lit(0)), F.lit(top - 1)).cast("long")
    return F.shiftleft((F.lit(top - 1) - step) if descending else step, BITS - 40)


def median(df: DataFrame, group: list[str], value: str, into: str = "median") -> DataFrame:
    """Exact median of every group, from ranks: no group meets in one task."""
    v = df.filter(F.col(value).isNotNull()).withColumn("__h", value_hash(F.col(value)))
    placed = positions(v, "__h", [value], group, "__pos", bits=30)
    n = v.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    mid = placed.join(n, group).filter((F.col("__pos") == F.floor((F.col("__n") - 1) / 2)) | (F.col("__pos") == F.floor(F.col("__n") / 2)))
    return mid.groupBy(*group).agg(F.avg(value).alias(into))
