"""Problem 1: mixing sources to target weights.

Weights are propagated through the tree domain - language - source: a node's
share is its part of its parent's weight, its budget that share of its parent's
budget. A leaf may be drawn at most ``repeat`` times its available samples;
what it can't take goes to its siblings first, and only what a whole branch
can't take goes up to the branches beside it. A leaf's draw is a prefix of
seeded epochs: whole epochs first, then the head of one more permutation.

The tree has one leaf per entry of the mix, so its tables are the size of the
mix (checked against MAX_ENTRIES); only counting and drawing touch the samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from undertone.sources.tables import table

DEFAULT_REPEAT = 4.0
MAX_ENTRIES = 100_000


def clean_name(c: str | Column) -> Column:
    return F.trim(F.col(c) if isinstance(c, str) else c)


def availability(samples: DataFrame, dataset: str = "dataset", sample: str = "sample_id") -> DataFrame:
    """(name, n_samples): distinct samples of every dataset.

    Deduplicates by (dataset, sample) first, so a dataset that holds a third of
    all rows is spread over all tasks and only partial counts meet.
    """
    rows = samples.select(clean_name(dataset).alias("name"), F.col(sample).alias("sample")).filter("name is not null and sample is not null")
    return rows.distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n_samples"))


def leaves(specs: DataFrame, samples: DataFrame, split: str = "train") -> DataFrame:
    """The valid entries of a split with their available samples and caps.

    Of entries with one name the lowest spec_id counts. Valid: a weight above 0
    and not both choose and repeat. Available: distinct samples, at most
    ``choose``; an entry without samples has none and gets no draw. ``cap`` is
    what may be drawn: ``repeat`` (4 if null) times the available samples.
    """
    own = specs.filter(F.col("split") == split).withColumn("name", clean_name("name")).filter("name is not null")
    first = own.withColumn("__rn", F.row_number().over(W.partitionBy("name").orderBy("spec_id"))).filter("__rn = 1")
    valid = first.filter("weight > 0 and not isnan(weight) and not (choose is not null and repeat is not null)")
    counted = valid.join(availability(samples), "name", "left")
    n = F.coalesce(F.col("n_samples"), F.lit(0))
    return counted.select(
        "name",
        "spec_id",
        F.coalesce(F.nullif(F.trim("task"), F.lit("")), F.lit("?")).alias("domain"),
        F.coalesce(F.nullif(F.lower(F.trim("language")), F.lit("")), F.lit("?")).alias("lang"),
        "weight",
        F.when(F.col("choose").isNotNull(), F.least(n, F.greatest("choose", F.lit(0)))).otherwise(n).cast("double").alias("available"),
        F.coalesce("repeat", F.lit(DEFAULT_REPEAT)).cast("double").alias("max_repeat"),
    ).withColumn("cap", F.col("available") * F.greatest("max_repeat", F.lit(0.0)))


def budget(leaf: DataFrame, total: Column | None = None) -> DataFrame:
    """Leaves with ``target``, ``shortage`` and the redistributed ``draw``.

    ``target`` is the share of the weights times the summed available samples
    (or ``total``), computed down the tree; ``shortage`` what exceeds ``cap``.
    ``draw`` comes from water filling: in each level (siblings in a language,
    then languages in a domain, then domains) the shortage is offered to the
    members with room in proportion to their weights, so a shortage leaves a
    branch only when the branch is full.
    """
    all_ = W.partitionBy()
    dom, lang = W.partitionBy("domain"), W.partitionBy("domain", "lang")
    t = leaf.withColumn("__total", total if total is not None else F.sum("available").over(all_))
    t = t.withColumn("__w", F.sum("weight").over(all_)).withColumn("__wd", F.sum("weight").over(dom)).withColumn("__wl", F.sum("weight").over(lang))
    t = t.withColumn("budget_domain", F.col("__total") * F.col("__wd") / F.col("__w"))
    t = t.withColumn("budget_language", F.col("budget_domain") * F.col("__wl") / F.col("__wd"))
    t = t.withColumn("target", F.col("budget_language") * F.col("weight") / F.col("__wl"))
    # the three quotients may leave a target a rounding above an equal cap
    over = F.col("target") - F.col("cap")
    t = t.withColumn("shortage", F.when(over > F.lit(1e-9) * F.col("target"), over).otherwise(0.0))
    t = t.withColumn("draw", F.least("target", "cap"))
    for level, want in ((lang, "budget_language"), (dom, "budget_domain"), (all_, "__total")):
        t = _fill(t, level, want)
    return t.drop("__total", "__w", "__wd", "__wl")


def _fill(t: DataFrame, level, want: str) -> DataFrame:
    """Raise ``draw`` within ``level`` until its sum is ``want`` or all are full.

    Room is filled in proportion to the weights: with members sorted by
    room / weight, a member is full if giving everyone from it on its own
    room / weight needs no more than is left.
    """
    room = F.col("cap") - F.col("draw")
    order = level.orderBy(F.col("__r"), F.col("name"))
    t = t.withColumn("__gap", F.greatest(F.max(want).over(level) - F.sum("draw").over(level), F.lit(0.0))).withColumn("__r", room / F.col("weight"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("__room_before", F.coalesce(F.sum(F.col("cap") - F.col("draw")).over(before), F.lit(0.0)))
    t = t.withColumn("__w_from", F.sum("weight").over(level) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    t = t.withColumn("__full", F.col("__room_before") + F.col("__r") * F.col("__w_from") <= F.col("__gap") + F.lit(1e-9))
    t = t.withColumn("__room_full", F.sum(F.when(F.col("__full"), F.col("cap") - F.col("draw")).otherwise(0.0)).over(level))
    t = t.withColumn("__w_open", F.sum(F.when(~F.col("__full"), F.col("weight")).otherwise(0.0)).over(level))
    add = F.when(F.col("__full"), room).otherwise(F.when(F.col("__w_open") > 0, (F.col("__gap") - F.col("__room_full")) * F.col("weight") / F.col("__w_open")).otherwise(0.0))
    t = t.withColumn("draw", F.least("cap", F.col("draw") + F.greatest(add, F.lit(0.0))))
    return t.drop("__gap", "__r", "__room_before", "__w_from", "__full", "__room_full", "__w_open")


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = table(spark, sf_dir, "dataset_specs")
    if specs.limit(MAX_ENTRIES + 1).count() > MAX_ENTRIES:
        raise ValueError(f"a mix of more than {MAX_ENTRIES} entries")
    return budget(leaves(specs, table(spark, sf_dir, "mds_samples")))


def draw_samples(samples: DataFrame, planned: DataFrame, seed: int = 9176) -> DataFrame:
    """(name, sample_id, epoch): each leaf's prefix of its seeded epochs.

    A leaf that draws n of m available samples takes floor(n / m) whole epochs
    and the first n mod m of one more. The order inside an epoch is that of
    xxhash64(seed, epoch, sample). The head is found without sorting a leaf in
    one task: hashes are counted in 4,096 buckets, whole buckets before the
    limit are taken, and only the bucket at the limit is ranked.
    """
    rows = samples.select(clean_name("dataset").alias("name"), "sample_id").filter("name is not null and sample_id is not null").distinct()
    leaf = planned.select("name", F.floor(F.col("available") + 1e-6).alias("m"), F.round("draw").cast("long").alias("n")).filter("n > 0 and m > 0")
    keyed = rows.join(F.broadcast(leaf), "name").withColumn("h", F.xxhash64(F.lit(seed), F.lit("choose"), "sample_id"))
    # the available samples of an entry with a choose are the head of one order
    chosen = _head(keyed, "h", "m", ["name", "sample_id", "m", "n"])
    whole = F.floor(F.col("n") / F.col("m"))
    # n > m draws whole epochs; with m rows each, the rest comes from one more
    full = chosen.withColumn("epoch", F.explode(F.when(whole > 0, F.sequence(F.lit(0).cast("long"), whole - 1)).otherwise(F.array().cast("array<bigint>"))))
    rest = chosen.withColumn("rest", F.col("n") - whole * F.col("m")).filter("rest > 0").withColumn("epoch", whole)
    rest = rest.withColumn("h", F.xxhash64(F.lit(seed), "epoch", "sample_id"))
    head = _head(rest, "h", "rest", ["name", "sample_id", "epoch"])
    return full.select("name", "sample_id", "epoch").unionByName(head)


def _head(rows: DataFrame, h: str, limit: str, keep: list[str]) -> DataFrame:
    """Of every name the ``limit`` rows with the lowest ``h``."""
    bucketed = rows.withColumn("b", F.shiftrightunsigned(h, 52).cast("int"))
    counts = bucketed.groupBy("name", "b").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(W.partitionBy("name").orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = bucketed.join(counts.withColumn("before", before), ["name", "b"])
    inside = placed.filter(F.col("before") + F.col("c") <= F.col(limit))
    edge = placed.filter((F.col("before") < F.col(limit)) & (F.col("before") + F.col("c") > F.col(limit)))
    rank = F.row_number().over(W.partitionBy("name", "b").orderBy(h, "sample_id"))
    edge = edge.withColumn("rn", rank).filter(F.col("rn") + F.col("before") <= F.col(limit))
    return inside.select(*keep).unionByName(edge.select(*keep))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark, sf_dir).filter("shortage > 0").select("name")


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and real share of every valid entry after redistribution."""
    p = plan(spark, sf_dir)
    total = F.sum("draw").over(W.partitionBy())
    return p.select("name", F.round("target", 4).alias("target"), F.round("cap", 4).alias("cap"), F.round("draw", 4).alias("draw"), F.round(F.col("weight") / F.sum("weight").over(W.partitionBy()), 6).alias("target_share"), F.round(F.col("draw") / total, 6).alias("real_share"))


def p1_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows drawn and distinct samples of each entry, counted from the draw."""
    drawn = draw_samples(table(spark, sf_dir, "mds_samples"), plan(spark, sf_dir))
    per = drawn.groupBy("name", "sample_id").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("name").agg(F.sum("c").alias("n_drawn"), F.count(F.lit(1)).alias("n_distinct"), F.max("c").alias("most_repeats"))
