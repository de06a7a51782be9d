"""Accessors, extra mix keys and the metrics of the further tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from undertone.functions.keyed import hashed, key
from undertone.operators import hooks, metrics as m
from undertone.plans.base import query
from undertone.plans.eval_queries import predictions
from undertone.plans.sampling_queries import H, ITEMS, SAMPLES, SPECS, items, samples, specs
from undertone.sources.tables import table


@query("nested_accessors", "SELECT DISTINCT item_id, text AS instruction, answer, octet_length(encode(answer))::int AS n_audio FROM eval_items")
def nested_accessors(spark, d):
    """Evaluation rows with nested texts and audio, read through the accessors."""
    e = table(spark, d, "eval_items").select("item_id", F.struct("text").alias("instruction"), "answer", F.struct(F.struct(F.col("answer").cast("binary").alias("bytes")).alias("audio")).alias("context"))
    return e.select("item_id", hooks.text_of(e.schema, "instruction").alias("instruction"), hooks.text_of(e.schema, "answer").alias("answer"), F.length(hooks.audio_of(e.schema)).alias("n_audio")).distinct()


@query(
    "extra_mix_keys",
    f"""WITH {SAMPLES}, {SPECS}, k AS (SELECT name, CASE WHEN spec_id % 5 > 0 THEN 5.0 + spec_id % 20 END AS max_seconds, CASE spec_id % 3 WHEN 0 THEN 'dataset' WHEN 1 THEN 'none' END AS prompt_type FROM specs),
s AS (SELECT DISTINCT sample_id, trim(dataset) AS name, duration FROM mds_samples WHERE sample_id IS NOT NULL)
SELECT sample_id, coalesce(prompt_type, 'default') AS prompt_type FROM s LEFT JOIN k USING (name) WHERE coalesce(duration <= max_seconds, true)""",
)
def extra_mix_keys(spark, d):
    """A length limit and a prompt type per mix entry."""
    i = F.col("spec_id")
    k = specs(spark, d).select("name", F.when(i % 5 > 0, 5.0 + i % 20).alias("max_seconds"), F.when(i % 3 == 0, "dataset").when(i % 3 == 1, "none").alias("prompt_type"))
    s = table(spark, d, "mds_samples").filter("sample_id is not null").select("sample_id", F.trim("dataset").alias("name"), "duration").distinct()
    return hooks.mix_keys(s, k).select("sample_id", "prompt_type")


@query(
    "mean_average_precision",
    f"""WITH {ITEMS}, c AS (SELECT set_name AS label, ({H.format("'map:' || item_id")} % 1000) / 1000.0 AS s, (task_type = 'ASR')::int AS y FROM items WHERE set_name IS NOT NULL),
r AS (SELECT label, y, row_number() OVER (PARTITION BY label ORDER BY s DESC, y) AS rank FROM c),
p AS (SELECT label, rank, row_number() OVER (PARTITION BY label ORDER BY rank) AS k FROM r WHERE y = 1)
SELECT label, round(avg(k / rank), 6) AS ap, count(*) AS n_positive FROM p GROUP BY label""",
)
def mean_average_precision(spark, d):
    """Average precision of a keyed score for speech recognition items."""
    i = items(spark, d).withColumn("s", F.pmod(hashed(key("map", F.col("item_id"))), F.lit(1000)) / 1000.0)
    return m.average_precision(i.withColumn("y", F.col("task_type") == "ASR"), "set_name", "s", "y").select("label", F.round("ap", 6).alias("ap"), "n_positive")


@query("switch_point_error")
def switch_point_error(spark, d):
    """A19."""
    return m.switch_error(predictions(spark, d), ["run", "set_name"], "answer", "hyp").select("run", "set_name", "n_switch", "n_wrong", F.round("value", 6).alias("value"))
