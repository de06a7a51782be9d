"""Evaluation flow and metrics (inventory 2.2, 2.4-2.7)."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from undertone.functions.keyed import hashed, key
from undertone.functions.tokens import words
from undertone.operators import evalflow as ev, metrics as m
from undertone.plans.base import query
from undertone.plans.sampling_queries import H, ITEMS, items
from undertone.sources.specs import TASK_TOKENS_PER_S
from undertone.sources.tables import table

RUNS = ("base", "checkpoint-20", "checkpoint-100", "other")

# A prediction of a run: the answer with every word kept, dropped (0) or
# replaced (1) by a keyed number.
PRED = (
    "pred AS (SELECT i.*, r.run, ws, list_transform(ws, lambda w, k: {h} % 12) AS op FROM (SELECT *, list_filter(string_split_regex(trim(coalesce(answer, '')), '\\s+'), lambda w: w <> '') AS ws FROM items) i, (SELECT unnest(['base', 'checkpoint-20', 'checkpoint-100', 'other']) AS run) r), "
    "hyps AS (SELECT *, array_to_string(list_filter(list_transform(ws, lambda w, k: CASE op[k] WHEN 0 THEN NULL WHEN 1 THEN 'zzz' ELSE w END), lambda w: w IS NOT NULL), ' ') AS hyp, len(list_filter(op, lambda x: x < 2)) AS edits, len(ws) AS n_ref FROM pred)"
).format(h=H.format("run || ':' || item_id || ':' || k"))


def predictions(spark, d, runs=RUNS):
    """Items with a prediction of each run."""
    i = items(spark, d).withColumn("ws", words(F.col("answer")))
    p = i.withColumn("run", F.explode(F.array(*[F.lit(r) for r in runs])))
    op = F.transform("ws", lambda w, k: F.struct(w.alias("w"), F.pmod(hashed(F.concat_ws(":", F.col("run"), F.col("item_id").cast("string"), (k + 1).cast("string"))), F.lit(12)).alias("o")))
    kept = F.transform(F.filter(op, lambda x: x["o"] != 0), lambda x: F.when(x["o"] == 1, F.lit("zzz")).otherwise(x["w"]))
    return p.withColumn("hyp", F.array_join(kept, " "))


@query("wer_by_group", f"WITH {ITEMS}, {PRED} SELECT run, set_name, sum(edits)::bigint AS edits, sum(n_ref)::bigint AS n_ref, round(sum(edits) / sum(n_ref), 6) AS value FROM hyps WHERE n_ref > 0 GROUP BY run, set_name")
def wer_by_group(spark, d):
    """A1, A3: word error rate per run and set."""
    return m.wer(predictions(spark, d), ["run", "set_name"], "answer", "hyp").select("run", "set_name", "edits", "n_ref", F.round("value", 6).alias("value"))


@query("wer_condition", f"WITH {ITEMS}, {PRED} SELECT run, item_id, round(edits / n_ref, 6) AS wer FROM hyps WHERE n_ref > 0")
def wer_condition(spark, d):
    """Per item."""
    return m.error_counts(predictions(spark, d), "answer", "hyp").select("run", "item_id", F.round(F.col("edits") / F.col("n_ref"), 6).alias("wer"))


@query("cer")
def cer(spark, d):
    """A3: character error rate per run and set, over answers in any script.
    No SQL: DuckDB's levenshtein counts bytes."""
    return m.cer(predictions(spark, d), ["run", "set_name"], "answer", "hyp").select("run", "set_name", "edits", "n_ref", F.round("value", 6).alias("value"))


@query("mer")
def mer(spark, d):
    """Mixed unit."""
    return m.mer(predictions(spark, d), ["run", "set_name"], "answer", "hyp").select("run", "set_name", "edits", "n_ref", F.round("value", 6).alias("value"))


@query("perfect_score", f"WITH {ITEMS} SELECT set_name, 0::bigint AS edits FROM items WHERE trim(coalesce(answer, '')) <> '' GROUP BY set_name")
def perfect_score(spark, d):
    """References as predictions make no errors."""
    return m.wer(items(spark, d).withColumn("hyp", F.col("answer")), ["set_name"], "answer", "hyp").select("set_name", "edits")


BLEU = (
    PRED
    + """, hw AS (SELECT set_name, item_id, ws AS r, list_filter(string_split_regex(hyp, '\\s+'), lambda w: w <> '') AS h FROM hyps WHERE run = 'base'),
hg AS (SELECT set_name, item_id, o, g, count(*) AS n FROM (SELECT set_name, item_id, o, array_to_string(h[k:k + o - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(h) - o + 2, 1))) AS k FROM (SELECT *, unnest([1, 2, 3, 4]) AS o FROM hw))) GROUP BY ALL),
rg AS (SELECT set_name, item_id, o, g, count(*) AS n FROM (SELECT set_name, item_id, o, array_to_string(r[k:k + o - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(r) - o + 2, 1))) AS k FROM (SELECT *, unnest([1, 2, 3, 4]) AS o FROM hw))) GROUP BY ALL),
oc AS (SELECT set_name, o, sum(least(hg.n, coalesce(rg.n, 0)))::bigint AS hits, sum(hg.n)::bigint AS total FROM hg LEFT JOIN rg USING (set_name, item_id, o, g) GROUP BY set_name, o),
ln AS (SELECT set_name, sum(len(r))::bigint AS ref_len, sum(len(h))::bigint AS hyp_len FROM hw GROUP BY set_name)"""
)


def _bleu_input(spark, d):
    return predictions(spark, d, ("base",)), words(F.col("hyp"))


@query("bleu_components", f"WITH {ITEMS}, {BLEU} SELECT set_name, o, hits, total, ref_len, hyp_len FROM oc JOIN ln USING (set_name)")
def bleu_components(spark, d):
    """Clipped n-gram counts."""
    p, hyp = _bleu_input(spark, d)
    return m.bleu_counts(p, ["set_name"], F.array("ws"), hyp).filter("total > 0").select("set_name", "o", "hits", "total", "ref_len", "hyp_len")


@query(
    "bleu_corpus",
    f"""WITH {ITEMS}, {BLEU}, z AS (SELECT *, sum(CASE WHEN hits = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY set_name ORDER BY o) AS zeros FROM oc)
SELECT set_name, round(CASE WHEN count(*) = 4 THEN 100 * CASE WHEN max(hyp_len) < max(ref_len) THEN exp(1 - max(ref_len) / max(hyp_len)) ELSE 1 END * exp(avg(ln(CASE WHEN hits > 0 THEN hits / total ELSE 1 / (power(2, zeros) * total) END))) ELSE 0 END, 4) AS bleu FROM z JOIN ln USING (set_name) GROUP BY set_name""",
)
def bleu_corpus(spark, d):
    """A4: corpus BLEU of each set."""
    p, hyp = _bleu_input(spark, d)
    return m.bleu(p, ["set_name"], F.array("ws"), hyp).select("set_name", F.round("value", 4).alias("bleu"))


@query("bleu_suite")
def bleu_suite(spark, d):
    """A4 as the suite scores it: 13a tokens, Chinese ones for Chinese targets,
    two references (the answer and the text) where both are there."""
    p = predictions(spark, d, ("base",)).withColumn("zh", F.coalesce(F.lower(F.trim("language_target")).startswith("zh"), F.lit(False)))

    def tokens(c):
        return F.when(F.col("zh"), m.bleu_tokens(F.col(c), "zh")).otherwise(m.bleu_tokens(F.col(c)))

    refs = F.array(*[F.when(F.trim(c) != "", tokens(c)) for c in ("answer", "text")])
    return m.bleu(p, ["set_name"], refs, tokens("hyp")).select("set_name", F.round("value", 4).alias("bleu"))


@query(
    "token_f1",
    f"""WITH {ITEMS}, {PRED}, c AS (SELECT item_id, (SELECT sum(least(len(list_filter(a, lambda x: x = u)), len(list_filter(b, lambda x: x = u)))) FROM (SELECT unnest(list_distinct(a)) AS u)) AS common, len(a) AS na, len(b) AS nb FROM (SELECT item_id, list_transform(ws, lambda w: lower(w)) AS a, list_filter(string_split_regex(lower(hyp), '\\s+'), lambda w: w <> '') AS b FROM hyps WHERE run = 'base'))
SELECT item_id, round(CASE WHEN na = 0 OR nb = 0 THEN (na = nb)::int::double ELSE 2.0 * coalesce(common, 0) / (na + nb) END, 6) AS f1 FROM c""",
)
def token_f1(spark, d):
    """A20."""
    return predictions(spark, d, ("base",)).select("item_id", F.round(m.token_f1(F.col("answer"), F.col("hyp")), 6).alias("f1"))


@query("macro_f1", f"""WITH {ITEMS}, c AS (SELECT task_type AS t, CASE WHEN {H.format("'guess:' || item_id")} % 4 = 0 THEN 'ASR' ELSE task_type END AS g FROM items WHERE task_type IS NOT NULL),
l AS (SELECT DISTINCT t AS label FROM c UNION SELECT g FROM c), s AS (SELECT label, (SELECT count(*) FROM c WHERE t = label) AS nt, (SELECT count(*) FROM c WHERE g = label) AS ng, (SELECT count(*) FROM c WHERE t = label AND g = label) AS hits FROM l)
SELECT round(avg(2.0 * hits / (nt + ng)), 6) AS macro_f1, round(sum(hits) / sum(nt), 6) AS weighted_accuracy, round(avg(CASE WHEN nt > 0 THEN hits / nt END), 6) AS unweighted_accuracy FROM s""")
def macro_f1(spark, d):
    """Macro F1, weighted and unweighted accuracy over task labels."""
    guess = F.when(F.pmod(hashed(key("guess", F.col("item_id"))), F.lit(4)) == 0, "ASR").otherwise(F.col("task_type"))
    c = m.class_scores(items(spark, d).filter("task_type is not null").withColumn("g", guess), "task_type", "g")
    return c.agg(F.round(F.avg("f1"), 6).alias("macro_f1"), F.round(F.sum("hits") / F.sum("n_true"), 6).alias("weighted_accuracy"), F.round(F.avg(F.when(F.col("n_true") > 0, F.col("hits") / F.col("n_true"))), 6).alias("unweighted_accuracy"))


@query("judge_scores", f"WITH {ITEMS} SELECT set_name, count(*) AS n, round(avg(CASE WHEN {H.format(chr(39) + 'judge:' + chr(39) + ' || item_id')} % 7 = 6 THEN 0 ELSE {H.format(chr(39) + 'judge:' + chr(39) + ' || item_id')} % 7 END * 20.0), 6) AS value FROM items GROUP BY set_name")
def judge_scores(spark, d):
    """0 to 5 times 20, unparsable as 0."""
    s = F.pmod(hashed(key("judge", F.col("item_id"))), F.lit(7))
    i = items(spark, d).withColumn("score", F.when(s < 6, s))
    return m.judge_score(i, ["set_name"], "score", F.lit(20.0)).select("set_name", "n", F.round("value", 6).alias("value"))


@query("meteor_exact")
def meteor_exact(spark, d):
    """A5: METEOR's exact stage (alpha .9, beta 3, gamma .5) from word counts;
    chunks are counted over the matched words in order of the prediction."""
    p = predictions(spark, d, ("base",)).withColumn("h", words(F.lower("hyp"))).withColumn("r", words(F.lower("answer")))
    p = p.withColumn("pos", F.filter(F.transform("h", lambda w: F.array_position("r", w)), lambda k: k > 0)).withColumn("mt", F.least(F.size("pos"), F.size("r")))
    chunks = F.aggregate(F.sequence(F.lit(2), F.greatest(F.size("pos"), F.lit(2))), F.lit(1), lambda a, i: a + F.when((i <= F.size("pos")) & (F.get("pos", i - 1) != F.get("pos", i - 2) + 1), 1).otherwise(0))
    pr, rc = F.col("mt") / F.size("h"), F.col("mt") / F.size("r")
    f = F.when(F.col("mt") > 0, pr * rc / (0.9 * pr + 0.1 * rc)).otherwise(0.0)
    score = F.when((F.size("h") == 0) | (F.size("r") == 0) | (F.col("mt") == 0), 0.0).otherwise(f * (1 - 0.5 * F.pow(chunks / F.col("mt"), F.lit(3.0))))
    return p.groupBy("set_name").agg(F.round(F.avg(score), 6).alias("meteor"))


@query(
    "complete_refs",
    f"""WITH {ITEMS}, r AS (SELECT i.item_id, i.set_name, s.min_ref_rate AS f, length(coalesce(answer, '')) / greatest(seconds, 0.001) AS rate FROM items i JOIN eval_sets s ON s.name = i.set_name),
md AS (SELECT set_name, median(rate) AS m FROM r WHERE rate IS NOT NULL GROUP BY set_name)
SELECT item_id, coalesce(rate >= f * m, true) AS keep FROM r LEFT JOIN md USING (set_name)""",
)
def complete_refs(spark, d):
    """References short for their duration are left out."""
    sets = table(spark, d, "eval_sets").select(F.col("name").alias("set_name"), "min_ref_rate")
    j = items(spark, d).join(sets, "set_name")
    return ev.complete_refs(j, "set_name", "answer", "seconds", F.col("min_ref_rate")).select("item_id", "keep")


@query("token_budget", f"WITH {ITEMS} SELECT item_id, least(16384, greatest(s.max_new_tokens, ceil(CASE WHEN s.task IN ('ASR', 'ST') THEN 15 ELSE 0 END * seconds)))::bigint AS budget, round(40 + 13.0 * seconds + length(answer) / 3.0, 4) AS estimate FROM items i JOIN eval_sets s ON s.name = i.set_name")
def token_budget(spark, d):
    """P41, P43, C3."""
    rate = F.create_map(*[F.lit(x) for kv in TASK_TOKENS_PER_S.items() for x in kv])
    sets = table(spark, d, "eval_sets").select(F.col("name").alias("set_name"), "max_new_tokens", F.coalesce(F.try_element_at(rate, F.col("task")), F.lit(0)).alias("rate"))
    j = items(spark, d).join(sets, "set_name")
    return j.select("item_id", ev.token_budget(F.col("seconds"), F.col("max_new_tokens"), F.col("rate")).cast("long").alias("budget"), F.round(ev.length_estimate(F.lit(40), F.col("seconds"), F.col("answer")), 4).alias("estimate"))


@query("over_length", f"WITH {ITEMS} SELECT set_name, count(*) FILTER (WHERE 40 + 13.0 * seconds + length(coalesce(answer, '')) / 3.0 > 2048) AS n_dropped, count(*) AS n FROM items GROUP BY set_name")
def over_length(spark, d):
    """Items whose estimate passes the limit."""
    e = ev.length_estimate(F.lit(40), F.col("seconds"), F.coalesce("answer", F.lit("")))
    return items(spark, d).groupBy("set_name").agg(F.count_if(e > 2048).alias("n_dropped"), F.count(F.lit(1)).alias("n"))


CHUNKS = f"""{ITEMS}, c AS (SELECT item_id, seconds, chunk_s, ceil(seconds / chunk_s) AS k FROM items i JOIN eval_sets s ON s.name = i.set_name WHERE seconds > 0),
k AS (SELECT *, greatest(coalesce(CASE WHEN k > 1 AND seconds - (k - 1) * chunk_s < 1 THEN k - 1 ELSE k END, 1), 1)::int AS n_chunks FROM c),
p AS (SELECT *, unnest(range(n_chunks)) AS chunk FROM k)"""


@query("chunk_plan", f"WITH {CHUNKS} SELECT item_id, chunk, n_chunks, round(CASE WHEN chunk = 0 THEN 0 ELSE chunk * chunk_s END, 4) AS start_s, round(CASE WHEN chunk = n_chunks - 1 THEN seconds ELSE (chunk + 1) * chunk_s END, 4) AS end_s FROM p")
def chunk_plan(spark, d):
    """Fixed chunks, a short tail joined to the one before."""
    sets = table(spark, d, "eval_sets").select(F.col("name").alias("set_name"), "chunk_s")
    j = items(spark, d).join(sets, "set_name").filter("seconds > 0")
    return ev.chunk_plan(j, "seconds", F.col("chunk_s")).select("item_id", F.col("chunk").cast("long").alias("chunk"), "n_chunks", F.round("start_s", 4).alias("start_s"), F.round("end_s", 4).alias("end_s"))


@query("chunk_merge", f"WITH {CHUNKS} SELECT item_id, array_to_string(list('part ' || chunk ORDER BY chunk), ' ') AS text, CASE WHEN bool_or({H.format(chr(39) + 'cut:' + chr(39) + ' || item_id || ' + chr(39) + ':' + chr(39) + ' || chunk')} % 50 = 0) THEN 'length' ELSE 'stop' END AS finish, count(*) AS n_parts FROM p GROUP BY item_id")
def chunk_merge(spark, d):
    """Pieces joined in order."""
    c = chunk_plan(spark, d)
    cut = F.when(F.pmod(hashed(key("cut", F.col("item_id"), F.col("chunk"))), F.lit(50)) == 0, "length").otherwise("stop")
    parts = c.withColumn("text", F.concat(F.lit(" part "), F.col("chunk").cast("string"))).withColumn("finish", cut)
    return ev.merge_chunks(parts, ["item_id"], "chunk", "text", "finish")


@query("chunk_audit", f"WITH {CHUNKS}, q AS (SELECT * FROM p WHERE NOT (n_chunks > 1 AND chunk = n_chunks - 1 AND item_id % 10 = 0)) SELECT item_id, count(*) AS n_parts, max(n_chunks) AS want FROM q GROUP BY item_id HAVING count(*) <> max(n_chunks)")
def chunk_audit(spark, d):
    """F8: items with a piece missing (here the last of every tenth)."""
    c = chunk_plan(spark, d).filter("not (n_chunks > 1 and chunk = n_chunks - 1 and item_id % 10 = 0)")
    return ev.incomplete(c, ["item_id"], "chunk", "n_chunks").select("item_id", "n_parts", "want")


DEALT = f"{ITEMS}, dealt AS (SELECT item_id, seconds, row_number() OVER (ORDER BY seconds DESC, item_id) - 1 AS place FROM items WHERE seconds > 0)"


@query("deal_longest_first", f"WITH {DEALT} SELECT item_id, place, (place % 8)::int AS rank FROM dealt")
def deal_longest_first(spark, d):
    """O1, W4."""
    i = items(spark, d).filter("seconds > 0").select("item_id", "seconds")
    return ev.deal(i, "seconds", "item_id", 8).select("item_id", "place", "rank")


@query(
    "greedy_batches",
    f"""WITH RECURSIVE {DEALT}, o AS (SELECT item_id, seconds, place % 8 AS rank, place // 8 AS k FROM dealt),
w AS (SELECT item_id, rank, k, 0 AS batch, 1 AS n, seconds AS total FROM o WHERE k = 0 UNION ALL
SELECT o.item_id, o.rank, o.k, CASE WHEN w.n >= 8 OR w.total + o.seconds > 480 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.n >= 8 OR w.total + o.seconds > 480 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n >= 8 OR w.total + o.seconds > 480 THEN o.seconds ELSE w.total + o.seconds END FROM w JOIN o ON o.rank = w.rank AND o.k = w.k + 1)
SELECT item_id, rank::int AS rank, batch FROM w""",
)
def greedy_batches(spark, d):
    """Batches of at most eight items and 480 seconds."""
    i = items(spark, d).filter("seconds > 0").select("item_id", "seconds")
    return ev.greedy_batches(ev.deal(i, "seconds", "item_id", 8), "seconds", "place", 8, 480.0).select("item_id", "rank", "batch")


SCORES = f"{ITEMS}, {PRED}, scores AS (SELECT run, set_name, max(task_type) AS task, 'wer' AS metric, sum(edits) / sum(n_ref) AS value, count(*) AS n FROM hyps WHERE n_ref > 0 AND NOT (run = 'other' AND length(set_name) % 5 = 0) GROUP BY run, set_name)"


def scores(spark, d):
    """Long score table; one run lacks some sets."""
    p = predictions(spark, d).filter("not (run = 'other' and length(set_name) % 5 = 0)")
    return m.error_counts(p, "answer", "hyp").groupBy("run", "set_name").agg(F.max("task_type").alias("task"), F.lit("wer").alias("metric"), (F.sum("edits") / F.sum("n_ref")).alias("value"), F.count(F.lit(1)).alias("n"))


@query("score_report", f"""WITH {SCORES} SELECT set_name, coalesce(format('{{:.4f}}', max(CASE WHEN run = 'base' THEN value END)), '-') AS base, coalesce(format('{{:.4f}}', max(CASE WHEN run = 'checkpoint-20' THEN value END)), '-') AS c20, coalesce(format('{{:.4f}}', max(CASE WHEN run = 'checkpoint-100' THEN value END)), '-') AS c100, coalesce(format('{{:.4f}}', max(CASE WHEN run = 'other' THEN value END)), '-') AS other FROM scores GROUP BY set_name""")
def score_report(spark, d):
    """K5: sets by runs, a dash where a run has none."""
    s = scores(spark, d).groupBy("set_name").pivot("run", list(RUNS)).agg(F.first("value"))
    show = lambda r: F.coalesce(F.format_string("%.4f", F.col(f"`{r}`")), F.lit("-"))
    fill = lambda r, a: F.when(F.col(f"`{r}`").isNull(), "-").otherwise(show(r)).alias(a)
    return s.select("set_name", fill("base", "base"), fill("checkpoint-20", "c20"), fill("checkpoint-100", "c100"), fill("other", "other"))


@query("task_averages", f"""WITH {SCORES}, f AS (SELECT set_name, task, metric FROM scores GROUP BY ALL HAVING count(DISTINCT run) = 4)
SELECT task, metric, round(avg(value) FILTER (WHERE run = 'base'), 6) AS base, round(avg(value) FILTER (WHERE run = 'checkpoint-20'), 6) AS c20, round(avg(value) FILTER (WHERE run = 'checkpoint-100'), 6) AS c100, round(avg(value) FILTER (WHERE run = 'other'), 6) AS other, count(DISTINCT set_name) AS n_sets FROM scores JOIN f USING (set_name, task, metric) GROUP BY task, metric""")
def task_averages(spark, d):
    """Only sets that every run has."""
    t = ev.task_averages(scores(spark, d), list(RUNS))
    r = lambda c, a: F.round(F.col(f"`{c}`"), 6).alias(a)
    return t.select("task", "metric", r("base", "base"), r("checkpoint-20", "c20"), r("checkpoint-100", "c100"), r("other", "other"), "n_sets")


@query("weighted_score", f"WITH {SCORES} SELECT run, round(sum(value * n) / sum(n), 6) AS score FROM scores GROUP BY run")
def weighted_score(spark, d):
    """Weighted by records."""
    return scores(spark, d).groupBy("run").agg(F.round(F.sum(F.col("value") * F.col("n")) / F.sum("n"), 6).alias("score"))


@query("best_checkpoint", f"WITH {SCORES}, a AS (SELECT run, sum(value * n) / sum(n) AS score FROM scores GROUP BY run) SELECT arg_min(run, score) AS best FROM a")
def best_checkpoint(spark, d):
    """The run with the best weighted score (lower is better)."""
    a = scores(spark, d).groupBy("run").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("score"))
    return a.agg(F.min_by("run", F.struct("score", "run")).alias("best"))


@query("run_order", "SELECT run, (row_number() OVER (ORDER BY c, step, run))::int AS place FROM (SELECT run, CASE WHEN run = 'base' THEN 0 WHEN regexp_matches(run, 'checkpoint-\\d+$') THEN 1 ELSE 2 END AS c, coalesce(try_cast(regexp_extract(run, 'checkpoint-(\\d+)$', 1) AS bigint), 0) AS step FROM (SELECT unnest(['base', 'checkpoint-20', 'checkpoint-100', 'other']) AS run))")
def run_order(spark, d):
    """O2."""
    r = spark.createDataFrame([(x,) for x in RUNS], "run string")
    return r.select("run", F.row_number().over(W.orderBy(*ev.run_order(F.col("run")))).alias("place"))


@query("merge_summary", f"WITH {SCORES}, o AS (SELECT set_name, value FROM scores WHERE run = 'base'), n AS (SELECT set_name, value FROM scores WHERE run = 'other') SELECT set_name, round(coalesce(n.value, o.value), 6) AS value FROM o FULL JOIN n USING (set_name)")
def merge_summary(spark, d):
    """K4: a summary updated by new scores."""
    s = scores(spark, d)
    o, n = (s.filter(F.col("run") == r).select("set_name", "value") for r in ("base", "other"))
    return ev.merge_summary(o, n, ["set_name"], "value").select("set_name", F.round("value", 6).alias("value"))


@query("prediction_diff", f"WITH {ITEMS}, {PRED}, a AS (SELECT item_id, set_name, hyp FROM hyps WHERE run = 'base'), b AS (SELECT item_id, hyp FROM hyps WHERE run = 'other' AND item_id % 9 <> 0) SELECT set_name, count(*) FILTER (WHERE a.hyp IS NOT DISTINCT FROM b.hyp) AS n_same, count(*) FILTER (WHERE a.hyp IS DISTINCT FROM b.hyp) AS n_different FROM a LEFT JOIN b USING (item_id) GROUP BY set_name")
def prediction_diff(spark, d):
    """Missing on one side counts as different."""
    p = predictions(spark, d, ("base", "other"))
    a = p.filter("run = 'base'").select("item_id", "set_name", "hyp")
    b = p.filter("run = 'other' and item_id % 9 <> 0").select("item_id", F.col("hyp").alias("other"))
    same = F.col("hyp").eqNullSafe(F.col("other"))
    return a.join(b, "item_id", "left").groupBy("set_name").agg(F.count_if(same).alias("n_same"), F.count_if(~same).alias("n_different"))


@query("resume_todo", f"WITH {CHUNKS} SELECT item_id, chunk FROM p WHERE {H.format(chr(39) + 'done:' + chr(39) + ' || item_id || ' + chr(39) + ':' + chr(39) + ' || chunk')} % 3 <> 0")
def resume_todo(spark, d):
    """Units without a finished prediction."""
    c = chunk_plan(spark, d).select("item_id", "chunk")
    done = c.filter(F.pmod(hashed(key("done", F.col("item_id"), F.col("chunk"))), F.lit(3)) == 0)
    return c.join(done, ["item_id", "chunk"], "left_anti")


@query("last_write_wins", "SELECT sample_id, dataset, duration, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM mds_samples) WHERE rn = 1")
def last_write_wins(spark, d):
    """The last delivery of every sample."""
    s = table(spark, d, "mds_samples").select("sample_id", "dataset", "duration", "ingested_at")
    return s.groupBy("sample_id").agg(F.max_by(F.struct("dataset", "duration", "ingested_at"), F.coalesce(F.col("ingested_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))).alias("r")).select("sample_id", "r.*")


@query("eval_load", "SELECT set_name, CASE WHEN count(*) FILTER (WHERE split = 'test') > 0 THEN 'test' ELSE min(split) END AS used, count(DISTINCT item_id) AS n FROM (SELECT DISTINCT trim(set_name) AS set_name, split, item_id FROM eval_items) GROUP BY set_name")
def eval_load(spark, d):
    """The test split if there is one."""
    e = table(spark, d, "eval_items").select(F.trim("set_name").alias("set_name"), "split", "item_id").distinct()
    return e.groupBy("set_name").agg(F.when(F.count_if(F.col("split") == "test") > 0, "test").otherwise(F.min("split")).alias("used"), F.countDistinct("item_id").alias("n"))


@query("requested_sets", "SELECT name FROM (SELECT unnest(['harbour_clean_test', 'no_such_set', 'sds_table_zh', 'other_missing']) AS name) WHERE name NOT IN (SELECT name FROM eval_sets)")
def requested_sets(spark, d):
    """Requested names that are not available."""
    want = spark.createDataFrame([("harbour_clean_test",), ("no_such_set",), ("sds_table_zh",), ("other_missing",)], "name string")
    return want.select("name").exceptAll(table(spark, d, "eval_sets").select("name"))
