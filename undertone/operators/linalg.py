"""Averages and concatenations of adapter tensors (inventory 2.12).

A matrix is rows (name, row, vec); all sums run over rows and indices, so a
tensor of any size is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def mean_vectors(df: DataFrame, group: list[str], vec: str) -> DataFrame:
    """L1: element-wise mean of the vectors of a group."""
    e = df.select(*group, F.posexplode(vec).alias("i", "v")).groupBy(*group, "i").agg(F.avg("v").alias("v"))
    return e.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias(vec))


def cells(df: DataFrame, name: str, row: str, vec: str) -> DataFrame:
    return df.select(name, F.col(row).alias("i"), F.posexplode(vec).alias("j", "v"))


def product(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Cells of A B per name: join on the inner index and sum."""
    l, r = a.select(name, "i", F.col("j").alias("k"), F.col("v").alias("x")), b.select(name, F.col("i").alias("k"), "j", F.col("v").alias("y"))
    return l.join(r, [name, "k"]).groupBy(name, "i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))


def concat_adapters(parts: DataFrame, part: str, name: str, side: str, row: str, vec: str, k: int) -> DataFrame:
    """L2: cells of the joined factors: A stacked by rows, B by columns and
    divided by k, so that B A is the mean of the parts' products."""
    c = parts.select(part, name, side, F.col(row).alias("i"), F.posexplode(vec).alias("j", "v"))
    rank = c.groupBy(name).agg(F.max(F.when(F.col(side) == "A", F.col("i")).otherwise(F.col("j"))).alias("r"))
    c = c.join(rank, name).withColumn("off", F.col(part) * (F.col("r") + 1))
    a = F.col(side) == "A"
    return c.select(name, side, F.when(a, F.col("i") + F.col("off")).otherwise(F.col("i")).alias("i"), F.when(a, F.col("j")).otherwise(F.col("j") + F.col("off")).alias("j"), F.when(a, F.col("v")).otherwise(F.col("v") / k).alias("v"))


def relative_error(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """L3: Frobenius norm of a - b over that of b."""
    j = a.withColumnRenamed("v", "x").join(b.withColumnRenamed("v", "y"), [name, "i", "j"], "full").na.fill(0.0, ["x", "y"])
    return j.groupBy(name).agg((F.sqrt(F.sum(F.pow(F.col("x") - F.col("y"), F.lit(2.0)))) / F.sqrt(F.sum(F.col("y") * F.col("y")))).alias("error"))


def incompatible(df: DataFrame, part: str, name: str, shape: str) -> DataFrame:
    """L4: names whose shape differs between parts or that a part lacks."""
    n = df.select(part).distinct().agg(F.count(F.lit(1)).alias("n_all"))
    g = df.groupBy(name).agg(F.countDistinct(shape).alias("n_shapes"), F.countDistinct(part).alias("n_parts"))
    return g.crossJoin(F.broadcast(n)).filter("n_shapes <> 1 or n_parts <> n_all").drop("n_all")
