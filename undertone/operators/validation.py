"""Checks of mixes and suites as violation tables (inventory 2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def mix_violations(specs: DataFrame) -> DataFrame:
    """(spec_id, rule) of every broken rule."""
    s = specs.withColumn("name", F.trim("name"))
    rank = F.row_number().over(W.partitionBy("split", "name").orderBy("spec_id"))
    rules = [
        ("no name", F.coalesce("name", F.lit("")) == ""),
        ("no path", F.coalesce(F.trim("path"), F.lit("")) == ""),
        ("no task", F.coalesce(F.trim("task"), F.lit("")) == ""),
        ("unknown split", ~F.coalesce(F.col("split").isin("train", "validation"), F.lit(False))),
        ("duplicate name", F.col("rn") > 1),
        ("choose and repeat", F.col("choose").isNotNull() & F.col("repeat").isNotNull()),
        ("unusable weight", F.coalesce(F.col("weight") <= 0, F.lit(True))),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return s.withColumn("rn", rank).select("spec_id", F.explode(found).alias("rule"))


def config_diff(a: DataFrame, b: DataFrame, key: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """Status of every key: same, different, missing on a side."""
    j = a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key, "full")
    same = F.col("a").eqNullSafe(F.col("b")) | (F.abs(F.col("a") - F.col("b")) <= tolerance)
    status = F.when(F.col("a").isNull() & F.col("b").isNotNull(), "only right").when(F.col("b").isNull() & F.col("a").isNotNull(), "only left").when(F.coalesce(same, F.lit(False)), "same").otherwise("different")
    return j.withColumn("status", status)


def ordered_lookup(wanted: DataFrame, name: str, catalogue: DataFrame, key: str, prefixes: list[str]) -> DataFrame:
    """The entry under the name or, in this order, under a prefixed name;
    ``found`` null if there is none. The catalogue is the small side only if
    Spark's size threshold says so."""
    tries = F.array(F.struct(F.lit(0).alias("rank"), F.col(name).alias("k")), *[F.struct(F.lit(i + 1).alias("rank"), F.concat(F.lit(p), F.col(name)).alias("k")) for i, p in enumerate(prefixes)])
    t = wanted.select(name, F.explode(tries).alias("t")).select(name, "t.rank", F.col("t.k").alias("__k"))
    j = t.join(catalogue.select(F.col(key).alias("__k")).distinct(), "__k", "left_semi")
    best = j.groupBy(name).agg(F.min_by("__k", "rank").alias("found"))
    return wanted.select(name).distinct().join(best, name, "left")
