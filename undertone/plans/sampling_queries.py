"""Sampling, epochs, ranks, resume (inventory 2.9, 2.7, 2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from undertone.functions.keyed import hashed, key
from undertone.operators import sampling
from undertone.operators.ranking import head, positions
from undertone.plans.base import query
from undertone.sources.tables import table

SEED = 9176
H = "('0x' || substr(md5({}), 1, 15))::bigint"

#: One row per sample: its dataset without blanks.
SAMPLES = "samples AS (SELECT sample_id, min(trim(dataset)) AS name FROM mds_samples WHERE sample_id IS NOT NULL AND dataset IS NOT NULL GROUP BY sample_id)"
SPECS = "specs AS (SELECT * FROM (SELECT trim(name) AS name, choose, \"repeat\", weight, spec_id, row_number() OVER (PARTITION BY trim(name) ORDER BY spec_id) AS rn FROM dataset_specs WHERE split = 'train') WHERE rn = 1)"
SIZES = "sizes AS (SELECT name, count(*) AS m FROM samples GROUP BY name)"


def samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mds_samples").filter("sample_id is not null and dataset is not null").groupBy("sample_id").agg(F.min(F.trim("dataset")).alias("name"))


def specs(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "dataset_specs").filter("split = 'train'").withColumn("name", F.trim("name"))
    return s.withColumn("rn", F.row_number().over(W.partitionBy("name").orderBy("spec_id"))).filter("rn = 1").drop("rn")


def chosen(spark: SparkSession, d: str, epoch: int | None, seed: int = SEED) -> DataFrame:
    """Draw of the mix: choose, else int(repeat * size), else all once."""
    n = F.coalesce("choose", F.floor(F.col("repeat") * F.col("__m")), F.col("__m"))
    return sampling.draw(samples(spark, d), specs(spark, d).select("name", "choose", "repeat"), "name", "sample_id", seed, epoch, n)


DRAW = f"""WITH {SAMPLES}, {SPECS}, {SIZES},
want AS (SELECT name, m, coalesce(choose, floor("repeat" * m)::bigint, m) AS n FROM specs JOIN sizes USING (name)),
placed AS (SELECT s.sample_id, s.name, w.m, w.n, row_number() OVER (PARTITION BY s.name ORDER BY {H.format("'{key}:' || s.name || ':' || s.sample_id || ':choose'")}, s.sample_id) - 1 AS pos
 FROM samples s JOIN want w USING (name) WHERE n > 0),
drawn AS (SELECT name, sample_id, unnest(range((n // m + CASE WHEN pos < n % m THEN 1 ELSE 0 END)::bigint)) AS copy FROM placed)
"""
ORDER = f"ordered AS (SELECT *, row_number() OVER (ORDER BY {H.format(chr(39) + '{key}:' + chr(39) + ' || name || ' + chr(39) + ':' + chr(39) + ' || sample_id || ' + chr(39) + ':' + chr(39) + ' || copy || ' + chr(39) + ':order' + chr(39))}, sample_id, copy) - 1 AS position FROM drawn)"


def draw_sql(epoch: int, seed: int = SEED) -> str:
    return DRAW.replace("{key}", str(seed + epoch))


def order_sql(epoch: int, seed: int = SEED) -> str:
    return draw_sql(epoch, seed) + ", " + ORDER.replace("{key}", str(seed + epoch))


@query("sample_choose_epoch", draw_sql(0) + "SELECT name, sample_id, copy FROM drawn")
def sample_choose_epoch(spark, d):
    """The draw of epoch 0."""
    return chosen(spark, d, 0).select("name", "sample_id", "copy")


@query("sample_fixed_validation", draw_sql(0) + "SELECT name, sample_id FROM drawn WHERE copy = 0")
def sample_fixed_validation(spark, d):
    """The same rows in every epoch."""
    return chosen(spark, d, None).filter("copy = 0").select("name", "sample_id")


@query(
    "sample_oversize",
    f"""WITH {SAMPLES}, {SIZES}, placed AS (SELECT s.sample_id, s.name, m, m + m // 2 + 1 AS n, row_number() OVER (PARTITION BY s.name ORDER BY {H.format(f"'{SEED + 3}:' || s.name || ':' || s.sample_id || ':choose'")}, s.sample_id) - 1 AS pos FROM samples s JOIN sizes USING (name)),
drawn AS (SELECT name, sample_id, unnest(range((n // m + CASE WHEN pos < n % m THEN 1 ELSE 0 END)::bigint)) AS copy FROM placed)
SELECT name, count(*) AS n_drawn, count(DISTINCT sample_id) AS n_distinct, sum(CASE WHEN copy > 0 THEN sample_id % 1009 ELSE 0 END)::bigint AS checksum FROM drawn GROUP BY name""",
)
def sample_oversize(spark, d):
    """G1: more than a dataset holds gives whole copies and a remainder."""
    rows = samples(spark, d)
    drawn = sampling.draw(rows, rows.select("name").distinct(), "name", "sample_id", SEED, 3, F.col("__m") + F.floor(F.col("__m") / 2) + 1)
    return drawn.groupBy("name").agg(F.count(F.lit(1)).alias("n_drawn"), F.countDistinct("sample_id").alias("n_distinct"), F.sum(F.when(F.col("copy") > 0, F.col("sample_id") % 1009).otherwise(0)).alias("checksum"))


@query(
    "sample_repeat",
    draw_sql(5) + "SELECT d.name, count(*) AS n_drawn, max(copy) AS most FROM drawn d JOIN specs s USING (name) WHERE s.choose IS NULL AND s.\"repeat\" IS NOT NULL GROUP BY d.name",
)
def sample_repeat(spark, d):
    """int(repeat * size) rows."""
    only = specs(spark, d).filter("choose is null and repeat is not null").select("name")
    return chosen(spark, d, 5).join(only, "name").groupBy("name").agg(F.count(F.lit(1)).alias("n_drawn"), F.max("copy").alias("most"))


@query(
    "epoch_overlap",
    draw_sql(0).replace("drawn AS", "e0 AS")
    + ", placed1 AS (SELECT s.sample_id, s.name, w.m, w.n, row_number() OVER (PARTITION BY s.name ORDER BY "
    + H.format(f"'{SEED + 1}:' || s.name || ':' || s.sample_id || ':choose'")
    + ", s.sample_id) - 1 AS pos FROM samples s JOIN want w USING (name) WHERE n > 0), e1 AS (SELECT name, sample_id, 0 AS copy FROM placed1 WHERE pos < n) SELECT a.name, count(*) AS n_both FROM (SELECT DISTINCT name, sample_id FROM e0) a JOIN (SELECT DISTINCT name, sample_id FROM e1) b USING (name, sample_id) GROUP BY a.name",
)
def epoch_overlap(spark, d):
    """Rows that two epochs share."""
    a, b = (chosen(spark, d, e).select("name", "sample_id").distinct() for e in (0, 1))
    return a.intersect(b).groupBy("name").agg(F.count(F.lit(1)).alias("n_both"))


@query("epoch_shift_law", draw_sql(1, 42) + "SELECT count(*) AS n_rows, 0::bigint AS n_different FROM drawn")
def epoch_shift_law(spark, d):
    """(43, 0) and (42, 1) are one draw."""
    a, b = chosen(spark, d, 0, 43).select("name", "sample_id", "copy"), chosen(spark, d, 1, 42).select("name", "sample_id", "copy")
    diff = a.exceptAll(b).agg(F.count(F.lit(1)).alias("n_different"))
    return a.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(diff)


@query("epoch_length", draw_sql(0) + "SELECT count(*) AS n_rows, count(DISTINCT name) AS n_datasets FROM drawn")
def epoch_length(spark, d):
    """G10."""
    return chosen(spark, d, 0).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("name").alias("n_datasets"))


def ordered(spark, d, epoch=0):
    return sampling.epoch_order(chosen(spark, d, epoch), "name", "sample_id", SEED, epoch)


@query("epoch_order", order_sql(0) + " SELECT name, sample_id, copy, position FROM ordered")
def epoch_order(spark, d):
    """The order of an epoch, fixed before any partitioning."""
    return ordered(spark, d).select("name", "sample_id", "copy", "position")


@query("rank_partition", order_sql(0) + " SELECT sample_id, copy, position % 4 AS rank, position // 4 AS slot FROM ordered WHERE position // 4 < (SELECT count(*) FROM ordered) // 4")
def rank_partition(spark, d):
    """Four ranks, equal, disjoint, covering but for the remainder."""
    return sampling.ranked(ordered(spark, d), 4, F.col("total")).select("sample_id", "copy", "rank", "slot")


@query(
    "partition_audit",
    order_sql(0)
    + """, r AS (SELECT sample_id, copy, position % 4 AS rank FROM ordered WHERE position // 4 < (SELECT count(*) FROM ordered) // 4),
per AS (SELECT rank, count(*) AS n, count(*) - count(DISTINCT (sample_id, copy)) AS dup_within FROM r GROUP BY rank),
ov AS (SELECT a.rank, count(*) AS overlap FROM r a JOIN r b ON a.sample_id = b.sample_id AND a.copy = b.copy AND a.rank < b.rank GROUP BY a.rank)
SELECT per.rank, n, dup_within, coalesce(overlap, 0) AS overlap FROM per LEFT JOIN ov USING (rank)""",
)
def partition_audit(spark, d):
    """Counts, duplicates within and overlaps between ranks."""
    r = rank_partition(spark, d)
    per = r.groupBy("rank", "sample_id", "copy").agg(F.count(F.lit(1)).alias("c")).groupBy("rank").agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("dup_within"))
    # ranks that hold one element, from one grouping instead of a self join
    shared = r.groupBy("sample_id", "copy").agg(F.array_sort(F.collect_set("rank")).alias("ranks")).filter("size(ranks) > 1")
    over = shared.select(F.posexplode("ranks").alias("i", "rank"), F.size("ranks").alias("k")).groupBy("rank").agg(F.sum(F.col("k") - F.col("i") - 1).alias("overlap"))
    return per.join(over, "rank", "left").select("rank", "n", "dup_within", F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap"))


@query("resume_tail", order_sql(0) + " SELECT sample_id, copy, (position - 100) // 8 AS batch FROM ordered WHERE position >= 100 AND position < 100 + ((SELECT count(*) FROM ordered) - 100) // 8 * 8")
def resume_tail(spark, d):
    """Full batches of eight after the first 100 samples."""
    o = ordered(spark, d)
    last = 100 + F.floor((F.col("total") - 100) / 8) * 8
    return o.filter((F.col("position") >= 100) & (F.col("position") < last)).select("sample_id", "copy", F.floor((F.col("position") - 100) / 8).alias("batch"))


BAD = "(text IS NULL OR text = '')"


@query(
    "replace_bad",
    """WITH s AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS id, t IS NULL OR t = '' AS bad FROM (SELECT sample_id, max(response_text) AS t FROM mds_samples GROUP BY sample_id)),
n AS (SELECT count(*) AS n FROM s),
twice AS (SELECT id AS place, bad FROM s UNION ALL SELECT id + n, bad FROM s, n WHERE id < 16),
nxt AS (SELECT place, first_value(CASE WHEN bad THEN NULL ELSE place END IGNORE NULLS) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS g FROM twice)
SELECT s.id, s.bad, g % n AS served FROM s JOIN nxt ON nxt.place = s.id, n""",
)
def replace_bad(spark, d):
    """The next good sample serves for a bad one."""
    one = table(spark, d, "mds_samples").groupBy("sample_id").agg(F.max("response_text").alias("t"))
    # ids are the ranks of sample_ids; ranged buckets instead of one sort
    span = one.agg(F.min("sample_id").alias("lo"), F.max("sample_id").alias("hi"))
    scaled = one.crossJoin(F.broadcast(span)).withColumn("h", F.floor((F.col("sample_id") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1) * F.lit(float(1 << 60))).cast("long"))
    ranked = positions(scaled, "h", ["sample_id"], into="id")
    return sampling.replacements(ranked, "id", F.col("t").isNull() | (F.col("t") == ""))


@query("block_shuffle", f"SELECT l_orderkey, l_linenumber, l_orderkey // 1000 AS block, row_number() OVER (PARTITION BY l_orderkey // 1000 ORDER BY {H.format(chr(39) + '7:' + chr(39) + ' || l_orderkey || ' + chr(39) + ':' + chr(39) + ' || l_linenumber')}, l_orderkey, l_linenumber) AS place FROM lineitem")
def block_shuffle(spark, d):
    """Keyed order inside blocks of 1,000 order keys."""
    h = hashed(key(7, F.col("l_orderkey"), F.col("l_linenumber")))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_orderkey") / 1000).alias("block"))
    return rows.withColumn("place", F.row_number().over(W.partitionBy("block").orderBy(h, "l_orderkey", "l_linenumber")))


ITEMS = "items AS (SELECT item_id, any_value(trim(set_name)) AS set_name, any_value(split) AS split, any_value(idx) AS idx, any_value(answer) AS answer, any_value(task_type) AS task_type, any_value(language) AS language, any_value(CASE WHEN duration > 0 THEN duration ELSE n_bytes / 32000.0 END) AS seconds FROM eval_items WHERE item_id IS NOT NULL GROUP BY item_id)"


def items(spark, d):
    """One row per evaluation item (re-deliveries are equal)."""
    sec = F.when(F.col("duration") > 0, F.col("duration")).otherwise(F.col("n_bytes") / 32000.0)
    e = table(spark, d, "eval_items").filter("item_id is not null").withColumn("seconds", sec).withColumn("set_name", F.trim("set_name"))
    return e.groupBy("item_id").agg(*[F.any_value(c).alias(c) for c in ("set_name", "split", "idx", "answer", "task_type", "language", "language_target", "text", "seconds")])


@query(
    "subset_n",
    f"""WITH {ITEMS}, kept AS (SELECT i.*, s.n FROM items i JOIN eval_sets s ON s.name = i.set_name WHERE s.max_audio_s IS NULL OR i.seconds <= s.max_audio_s),
placed AS (SELECT *, row_number() OVER (PARTITION BY set_name ORDER BY {H.format("'42:' || set_name || ':' || item_id")}, item_id) AS rn FROM kept)
SELECT set_name, item_id FROM placed WHERE rn <= CASE WHEN n < 0 THEN 9223372036854775807 ELSE n END""",
)
def subset_n(spark, d):
    """Filter by length, then a keyed subset of n per set."""
    sets = table(spark, d, "eval_sets").select(F.col("name").alias("set_name"), "n", "max_audio_s")
    kept = items(spark, d).join(sets, "set_name").filter("max_audio_s is null or seconds <= max_audio_s")
    kept = kept.withColumn("h", hashed(key(42, F.col("set_name"), F.col("item_id")))).withColumn("limit", F.when(F.col("n") < 0, F.lit(2**62)).otherwise(F.col("n")))
    return head(kept, "h", ["item_id"], "limit", ["set_name"]).select("set_name", "item_id")


@query("temperature_mix", f"WITH {SAMPLES}, {SIZES} SELECT name, m, round(power(m, 0.5) / sum(power(m, 0.5)) OVER (), 6) AS share FROM sizes")
def temperature_mix(spark, d):
    """Shares by n^(1/2)."""
    m = samples(spark, d).groupBy("name").agg(F.count(F.lit(1)).alias("m"))
    return sampling.temperature_shares(m, "name", "m", 2.0).select("name", "m", F.round("share", 6).alias("share"))


@query(
    "unimax_mix",
    f"""WITH RECURSIVE {SAMPLES}, {SIZES}, r AS (SELECT name, m, m * 2.0::double AS cap, row_number() OVER (ORDER BY m, name) AS i, count(*) OVER () AS k FROM sizes),
w AS (SELECT 0::bigint AS i, (SELECT sum(m) * 1.0 FROM sizes)::double AS rest, NULL::varchar AS name, 0.0::double AS allotted UNION ALL
 SELECT r.i, w.rest - least(r.cap, w.rest / (r.k - r.i + 1)), r.name, least(r.cap, w.rest / (r.k - r.i + 1)) FROM w JOIN r ON r.i = w.i + 1)
SELECT name, round(allotted, 4) AS allotted FROM w WHERE i > 0""",
)
def unimax_mix(spark, d):
    """UniMax with a budget of one epoch and a cap of two."""
    m = samples(spark, d).groupBy("name").agg(F.count(F.lit(1)).alias("m"))
    total = m.agg(F.sum("m")).first()[0] or 0
    return sampling.unimax(m, "name", "m", float(total), 2.0).select("name", F.round("allotted", 4).alias("allotted"))


@query("score_shards", "SELECT name, (row_number() OVER (ORDER BY name) - 1) % 4 AS shard FROM eval_sets")
def score_shards(spark, d):
    """sets[i::4]."""
    return table(spark, d, "eval_sets").select("name", ((F.row_number().over(W.orderBy("name")) - 1) % 4).cast("long").alias("shard"))


@query("val_choose", "SELECT spec_id, trim(name) AS name, 32 AS choose FROM dataset_specs WHERE split = 'validation'")
def val_choose(spark, d):
    """One number for every validation entry."""
    return table(spark, d, "dataset_specs").filter("split = 'validation'").select("spec_id", F.trim("name").alias("name"), F.lit(32).alias("choose"))


@query(
    "class_balanced",
    f"""WITH {SAMPLES}, {SIZES}, t AS (SELECT *, ceil(max(m) OVER () / m::double)::bigint AS copies FROM sizes) SELECT name, m, copies, m * copies AS n_rows FROM t""",
)
def class_balanced(spark, d):
    """Rare classes are repeated ceil(max / n) times."""
    m = samples(spark, d).groupBy("name").agg(F.count(F.lit(1)).alias("m"))
    c = F.ceil(F.max("m").over(W.partitionBy()) / F.col("m"))
    return m.withColumn("copies", c).withColumn("n_rows", F.col("m") * F.col("copies"))


@query("group_split", f"WITH {SAMPLES} SELECT name, CASE WHEN {H.format(chr(39) + 'split:' + chr(39) + ' || name')} % 10 < 8 THEN 'train' WHEN {H.format(chr(39) + 'split:' + chr(39) + ' || name')} % 10 = 8 THEN 'validation' ELSE 'test' END AS part, count(*) AS n FROM samples GROUP BY 1, 2")
def group_split(spark, d):
    """A group is in one part only."""
    b = F.pmod(hashed(key("split", F.col("name"))), F.lit(10))
    part = F.when(b < 8, "train").when(b == 8, "validation").otherwise("test")
    return samples(spark, d).groupBy("name", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
