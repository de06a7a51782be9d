"""Mix sampling: choose and repeat, epochs, ranks, resume, replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from undertone.functions.keyed import hashed, key
from undertone.operators.ranking import positions

MAX_TRIES = 16


def epoch_hash(seed: int, epoch: int, group: Column, sample: Column, purpose: str = "choose") -> Column:
    """Order of an epoch. Seed and epoch enter as their sum, so (seed + 1,
    epoch) and (seed, epoch + 1) are one draw."""
    return hashed(key(seed + epoch, group, sample, purpose))


def draw(rows: DataFrame, sizes: DataFrame, group: str, sample: str, seed: int, epoch: int | None, n: Column | None = None) -> DataFrame:
    """``n`` rows of every group: floor(n / m) whole copies of its m rows and
    the first n mod m of the keyed order once more.

    ``sizes`` (one row a group) has the column n, or what the expression ``n``
    uses beside the group's size ``__m``. ``epoch`` None draws the same rows in
    every epoch. A group without rows or with n null or not positive gives
    none; copies are numbered from 0. The rows are read for their order and
    for one count of their buckets.
    """
    keyed = rows.withColumn("__h", epoch_hash(seed, epoch or 0, F.col(group), F.col(sample)))
    placed = positions(keyed, "__h", [sample], [group], "__pos", total="__m").join(sizes, group)
    rest = [c for c in sizes.columns if c != group]
    placed = placed.withColumn("__want", n if n is not None else F.col("n")).filter("__want > 0")
    whole = F.floor(F.col("__want") / F.col("__m"))
    times = whole + F.when(F.col("__pos") < F.col("__want") - whole * F.col("__m"), 1).otherwise(0)
    return placed.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1)).otherwise(F.array().cast("array<bigint>")))).drop("__h", "__pos", "__m", "__want", *rest)


def epoch_order(drawn: DataFrame, group: str, sample: str, seed: int, epoch: int) -> DataFrame:
    """``position`` of every drawn row in the epoch, before any partitioning,
    so it does not depend on the number of ranks; ``total``, the epoch's length."""
    h = hashed(key(seed + epoch, F.col(group), F.col(sample), F.col("copy"), "order"))
    return positions(drawn.withColumn("__h", h), "__h", [sample, "copy"], total="total").drop("__h")


def ranked(ordered: DataFrame, world: int, total: Column | int) -> DataFrame:
    """Deal positions to ranks: disjoint, equally many (a remainder is dropped)."""
    size = F.floor((F.lit(total) if isinstance(total, int) else total) / world)
    return ordered.withColumn("rank", F.pmod("position", F.lit(world))).withColumn("slot", F.floor(F.col("position") / world)).filter(F.col("slot") < size)


def batches(ordered: DataFrame, size: int, total: int, offset: int = 0) -> DataFrame:
    """Full batches of the positions from ``offset`` on."""
    last = offset + (max(0, total - offset) // size) * size
    return ordered.filter((F.col("position") >= offset) & (F.col("position") < last)).withColumn("batch", F.floor((F.col("position") - offset) / size))


def replacements(rows: DataFrame, position: str, bad: Column, tries: int = MAX_TRIES, block: int = 100_000) -> DataFrame:
    """``served``: the position that serves each row: itself if good, else the
    next good one, going round at the end, within ``tries``; null if none.

    Blocks of positions are windowed apart; each gets the next ``tries`` rows
    as context, the last block those from the start.
    """
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    r = rows.select(F.col(position).cast("long").alias("p"), bad.alias("bad")).crossJoin(F.broadcast(n))
    own = F.floor(F.col("p") / block)
    context = r.filter((F.col("p") % block < tries)).withColumn("blk", F.when(F.col("p") < tries, F.floor((F.col("n") - 1) / block)).otherwise(own - 1)).withColumn("at", F.when(F.col("p") < tries, F.col("p") + F.col("n")).otherwise(F.col("p")))
    every = r.withColumn("blk", own).withColumn("at", F.col("p")).withColumn("ctx", F.lit(False)).unionByName(context.withColumn("ctx", F.lit(True)))
    over = W.partitionBy("blk").orderBy("at").rowsBetween(0, tries - 1)
    good = F.first(F.when(~F.col("bad"), F.col("at")), ignorenulls=True).over(over)
    return every.withColumn("g", good).filter("not ctx").select(F.col("p").alias(position), "bad", F.pmod("g", F.col("n")).alias("served"))


def temperature_shares(counts: DataFrame, group: str, n: str, temperature: float) -> DataFrame:
    """Share of each group proportional to n^(1/T)."""
    w = F.pow(F.col(n).cast("double"), F.lit(1.0 / temperature))
    return counts.withColumn("share", w / F.sum(w).over(W.partitionBy()))


def unimax(counts: DataFrame, group: str, n: str, budget: float, epochs: float) -> DataFrame:
    """UniMax: as even as possible, no group over ``epochs`` times its size.

    Groups by size: a group takes its cap or an even part of what is left. In
    closed form a group is capped while its cap, given to all from it on, fits.
    """
    order = W.partitionBy().orderBy(n, group)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    cap = F.col(n) * epochs
    c = counts.withColumn("cap", cap.cast("double")).withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    c = c.withColumn("left", F.count(F.lit(1)).over(W.partitionBy()) - F.row_number().over(order) + 1)
    c = c.withColumn("capped", F.col("cap") * F.col("left") <= F.lit(budget) - F.col("spent"))
    even = (F.lit(budget) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(W.partitionBy())) / F.sum(F.when(~F.col("capped"), 1).otherwise(0)).over(W.partitionBy())
    return c.withColumn("allotted", F.when(F.col("capped"), F.col("cap")).otherwise(even)).drop("spent", "left")
