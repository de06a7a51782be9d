"""The rest of the inventory: windows over tokens, tiers, entities, chrF."""

from __future__ import annotations

from pyspark.sql import functions as F

from undertone.functions import numbers, text as t
from undertone.functions.tokens import words
from undertone.operators import metrics as m
from undertone.plans.base import query
from undertone.plans.eval_queries import PRED, predictions
from undertone.plans.row_queries import FULL, full_rows
from undertone.plans.sampling_queries import ITEMS, SPECS, items, specs
from undertone.plans.text_queries import BASE, base
from undertone.sources.tables import table


@query("folder_specs", "SELECT spec_id, split_part(path, '/', 4) AS split_folder, split_part(path, '/', 5) AS task_folder, split_part(path, '/', 6) AS dataset FROM dataset_specs")
def folder_specs(spark, d):
    """Split, task and dataset from the folders of a path."""
    part = lambda i: F.split_part("path", F.lit("/"), F.lit(i))
    return table(spark, d, "dataset_specs").select("spec_id", part(4).alias("split_folder"), part(5).alias("task_folder"), part(6).alias("dataset"))


@query("suite_tier", "SELECT name, CASE WHEN task = 'ASR' THEN 8 WHEN length(name) % 4 = 0 THEN 0 ELSE n END AS n FROM eval_sets WHERE CASE WHEN task = 'ASR' THEN 8 WHEN length(name) % 4 = 0 THEN 0 ELSE n END <> 0")
def suite_tier(spark, d):
    """a tier's numbers; sets with 0 are left out."""
    n = F.when(F.col("task") == "ASR", 8).when(F.length("name") % 4 == 0, 0).otherwise(F.col("n"))
    return table(spark, d, "eval_sets").select("name", n.alias("n")).filter("n <> 0")


@query("sample_specs", f"WITH {SPECS}, {FULL} SELECT sample_id, s.spec_id, s.weight FROM full_rows f LEFT JOIN specs s ON s.name = trim(f.dataset)")
def sample_specs(spark, d):
    """Each sample of all streams with its stream's entry."""
    s = specs(spark, d).select("name", "spec_id", "weight")
    return full_rows(spark, d, "dataset").withColumn("name", F.trim("dataset")).join(s, "name", "left").select("sample_id", "spec_id", "weight")


@query("item_index", f"WITH {FULL} SELECT sample_id, trim(dataset) AS name, task, nullif(trim(language), '') AS lang, duration, length(coalesce(response_text, '')) AS answer_chars FROM full_rows")
def item_index(spark, d):
    """The index table of all samples."""
    return full_rows(spark, d, "dataset", "task", "language", "duration", "response_text").select("sample_id", F.trim("dataset").alias("name"), "task", F.nullif(F.trim("language"), F.lit("")).alias("lang"), "duration", F.length(F.coalesce("response_text", F.lit(""))).cast("long").alias("answer_chars"))


@query("total_join", f"WITH {ITEMS}, {PRED}, b AS (SELECT item_id, hyp FROM hyps WHERE run = 'base' AND item_id % 11 <> 0) SELECT count(*) AS n_items, count(hyp) AS n_predicted, count(*) - count(hyp) AS n_missing FROM items LEFT JOIN b USING (item_id)")
def total_join(spark, d):
    """Every item needs its prediction."""
    p = predictions(spark, d, ("base",)).filter("item_id % 11 <> 0").select("item_id", "hyp")
    return items(spark, d).select("item_id").join(p, "item_id", "left").agg(F.count(F.lit(1)).alias("n_items"), F.count("hyp").alias("n_predicted"), F.count_if(F.col("hyp").isNull()).alias("n_missing"))


@query("token_window", f"WITH {BASE}, w AS (SELECT sample_id, list_filter(string_split_regex(trim(x), '\\s+'), lambda w: w <> '') AS ws FROM base), p AS (SELECT sample_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w) SELECT sample_id, pos, coalesce(ws[pos - 1], '') AS prev, ws[pos] AS cur, coalesce(ws[pos + 1], '') AS next FROM p")
def token_window(spark, d):
    """Each word with its neighbours, from the array itself (no sort)."""
    w = base(spark, d).select("sample_id", words(F.col("x")).alias("ws"))
    e = w.select("sample_id", "ws", F.posexplode("ws").alias("i", "cur"))
    return e.select("sample_id", (F.col("i") + 1).cast("long").alias("pos"), F.coalesce(F.when(F.col("i") > 0, F.get("ws", F.col("i") - 1)), F.lit("")).alias("prev"), "cur", F.coalesce(F.get("ws", F.col("i") + 1), F.lit("")).alias("next"))


@query("exact_match", f"WITH {ITEMS}, {PRED} SELECT run, set_name, count(*) FILTER (WHERE lower(trim(hyp)) = lower(trim(coalesce(answer, '')))) AS n_exact, count(*) AS n FROM hyps GROUP BY run, set_name")
def exact_match(spark, d):
    """Exact matches."""
    same = F.lower(F.trim("hyp")) == F.lower(F.trim(F.coalesce("answer", F.lit(""))))
    return predictions(spark, d).groupBy("run", "set_name").agg(F.count_if(same).alias("n_exact"), F.count(F.lit(1)).alias("n"))


ENTITIES = ("pharmacy", "harbour", "lantern", "durian", "jambatan", "sepatu", "Merantau", "Seraya")


@query("entity_recall", f"WITH {ITEMS}, {PRED}, e AS (SELECT unnest([{', '.join(repr(x) for x in ENTITIES)}]) AS e) SELECT e, count(*) FILTER (WHERE contains(answer, e)) AS n_true, count(*) FILTER (WHERE contains(answer, e) AND contains(hyp, e)) AS n_hit, count(*) FILTER (WHERE NOT contains(answer, e) AND contains(hyp, e)) AS n_false FROM hyps, e WHERE run = 'other' AND answer IS NOT NULL GROUP BY e")
def entity_recall(spark, d):
    """Entities found, missed and inserted."""
    p = predictions(spark, d, ("other",)).filter("answer is not null")
    e = p.select("answer", "hyp", F.explode(F.array(*[F.lit(x) for x in ENTITIES])).alias("e"))
    inside = lambda c: F.contains(F.col(c), F.col("e"))
    return e.groupBy("e").agg(F.count_if(inside("answer")).alias("n_true"), F.count_if(inside("answer") & inside("hyp")).alias("n_hit"), F.count_if(~inside("answer") & inside("hyp")).alias("n_false"))


@query("chrf")
def chrf(spark, d):
    """chrF++ of each set."""
    return m.chrf(predictions(spark, d, ("base",)), ["set_name"], "answer", "hyp").select("set_name", F.round("value", 4).alias("chrf"))


@query("preprocess_asr")
def preprocess_asr(spark, d):
    """P20: the whole chain before error rates: dataset step, English
    normaliser, digits, brackets, hesitations, Chinese and Thai apart."""
    x = t.unwrap_language(F.col("x"))
    x = t.digit_words(numbers.english_text(x))
    return base(spark, d).select("sample_id", t.space_out(t.remove_non_speech(t.basic(t.remove_bracketed(x)))).alias("y"))
