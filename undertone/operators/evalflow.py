"""Evaluation flow: filter, chunk, deal, batch, merge, score, report."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from undertone.operators.ranking import median, positions, value_hash

TAIL_S = 1.0


def token_budget(seconds: Column, max_new: Column, rate: Column, most: int = 16384) -> Column:
    """At least ``max_new``, ``rate`` tokens a second, at most ``most``."""
    return F.least(F.lit(most), F.greatest(max_new, F.ceil(rate * seconds)))


def length_estimate(prompt: Column, seconds: Column, answer: Column) -> Column:
    """Prompt + 13 tokens a second + a third of the characters."""
    return prompt + 13.0 * seconds + F.length(answer) / 3.0


def complete_refs(items: DataFrame, group: str, text: str, seconds: str, factor: Column) -> DataFrame:
    """``keep`` where the reference's rate is at least ``factor`` times the
    group's median rate (all where the factor is null)."""
    rate = F.length(F.coalesce(text, F.lit(""))) / F.greatest(F.col(seconds), F.lit(1e-3))
    r = items.withColumn("rate", rate)
    m = median(r, [group], "rate", "median_rate")
    return r.join(m, group, "left").withColumn("keep", F.coalesce(F.col("rate") >= factor * F.col("median_rate"), F.lit(True)))


def chunk_plan(items: DataFrame, seconds: str, step: Column, tail_s: float = TAIL_S) -> DataFrame:
    """(chunk, start_s, end_s) at multiples of ``step``; a last piece under
    ``tail_s`` belongs to the one before; without a step one chunk."""
    n = F.ceil(F.col(seconds) / step)
    n = F.when((n > 1) & (F.col(seconds) - (n - 1) * step < tail_s), n - 1).otherwise(n)
    n = F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("int")
    c = items.withColumn("n_chunks", n).withColumn("__step", step).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    start = F.when(F.col("chunk") == 0, 0.0).otherwise(F.col("chunk") * F.col("__step"))
    end = F.when(F.col("chunk") == F.col("n_chunks") - 1, F.col(seconds)).otherwise((F.col("chunk") + 1) * F.col("__step"))
    return c.withColumn("start_s", start).withColumn("end_s", end).drop("__step")


def deal(items: DataFrame, seconds: str, idx: str, world: int) -> DataFrame:
    """Longest first (ties by idx), then round robin."""
    placed = positions(items.withColumn("__h", value_hash(F.col(seconds), True)).withColumn("__neg", -F.col(seconds)), "__h", ["__neg", idx], into="place", bits=24)
    return placed.drop("__h", "__neg").withColumn("rank", F.pmod("place", F.lit(world)).cast("int"))


def greedy_batches(dealt: DataFrame, seconds: str, order: str, size: int, cap_s: float, into: str = "batch") -> DataFrame:
    """Within a rank, in order, a batch closes when it holds ``size`` items
    or the next would pass ``cap_s`` seconds; an oversize item stands alone.

    The rule is sequential, so a rank is one sorted stream; it is read batch by
    batch with two numbers of state and never collected.
    """
    schema = T.StructType([*dealt.schema.fields, T.StructField(into, T.IntegerType())])
    names = dealt.columns
    rank_at, sec_at = names.index("rank"), names.index(seconds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, number, count, total = None, 0, 0, 0.0
        for b in batches:
            out = []
            for r, s in zip(b.column(rank_at).to_pylist(), b.column(sec_at).to_pylist()):
                if r != rank:
                    rank, number, count, total = r, 0, 0, 0.0
                if count and (count >= size or total + s > cap_s):
                    number, count, total = number + 1, 0, 0.0
                count, total = count + 1, total + s
                out.append(number)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*names, into])

    return dealt.repartition("rank").sortWithinPartitions("rank", order).mapInArrow(run, schema)


def merge_chunks(parts: DataFrame, key: list[str], chunk: str, text: str, finish: str) -> DataFrame:
    """The pieces of an item in order, joined by single blanks; finish is
    ``length`` if any piece's is."""
    g = parts.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(chunk, text))).alias("p"), F.bool_or(F.col(finish) == "length").alias("cut"), F.count(F.lit(1)).alias("n_parts"))
    joined = F.trim(F.array_join(F.filter(F.transform("p", lambda x: F.trim(x[text])), lambda s: s != ""), " "))
    return g.select(*key, joined.alias(text), F.when(F.col("cut"), "length").otherwise("stop").alias(finish), "n_parts")


def incomplete(parts: DataFrame, key: list[str], chunk: str, n: str) -> DataFrame:
    """F8: items whose pieces are not exactly 0 .. n - 1."""
    g = parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n_parts"), F.countDistinct(chunk).alias("n_distinct"), F.min(chunk).alias("lo"), F.max(chunk).alias("hi"), F.max(n).alias("want"))
    return g.filter("n_parts <> want or n_distinct <> want or lo <> 0 or hi <> want - 1")


def last_wins(rows: DataFrame, key: list[str], written: str) -> DataFrame:
    """The last written row of every key."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(F.col(written).isNotNull(), written)).alias("r")).select(*key, "r.*")


def run_order(run: Column) -> list[Column]:
    """O2: base, then checkpoints by step, then the rest by name."""
    step = F.regexp_extract(run, r"checkpoint-(\d+)$", 1)
    return [F.when(run == "base", 0).when(step != "", 1).otherwise(2), F.coalesce(F.nullif(step, F.lit("")).cast("long"), F.lit(0)), run]


def task_averages(scores: DataFrame, runs: list[str]) -> DataFrame:
    """Averages per task and metric over the sets that every run has."""
    wide = scores.groupBy("set_name", "task", "metric").pivot("run", runs).agg(F.first("value"))
    full = wide.filter(F.forall(F.array(*[F.col(f"`{r}`") for r in runs]), lambda x: x.isNotNull()))
    return full.groupBy("task", "metric").agg(*[F.avg(f"`{r}`").alias(r) for r in runs], F.count(F.lit(1)).alias("n_sets"))


def merge_summary(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """The new value where there is one, else the old."""
    n = new.withColumnRenamed(value, "__new")
    return old.join(n, key, "full").withColumn(value, F.coalesce("__new", value)).drop("__new")


def islands(rows: DataFrame, group: list[str], order: str, same: str) -> DataFrame:
    """Number of the run of equal ``same`` values that a row belongs to."""
    w = W.partitionBy(*group).orderBy(order)
    new = F.when(F.col(same).eqNullSafe(F.lag(same).over(w)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    return rows.withColumn("__new", new).withColumn("island", F.sum("__new").over(w)).drop("__new")
