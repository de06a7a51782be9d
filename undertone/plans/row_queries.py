"""Chat rows, mixes, catalogues, logs and inventories."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from undertone.functions import text as t
from undertone.functions.keyed import hashed, key, pick, uniform
from undertone.operators import evalflow as ev, rows, sampling, validation
from undertone.plans.base import query
from undertone.plans.sampling_queries import H, ITEMS, SAMPLES, SEED, SIZES, SPECS, chosen, draw_sql, items, samples, specs
from undertone.sources.tables import table

#: Last delivery of each sample with its texts.
FULL = "full_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM mds_samples WHERE sample_id IS NOT NULL) WHERE rn = 1)"


def full_rows(spark, d, *columns):
    """The last delivery of every sample; only ``columns`` are read and moved."""
    s = table(spark, d, "mds_samples").filter("sample_id is not null").select("sample_id", *columns, F.col("ingested_at").cast("timestamp").alias("__t"))
    return ev.last_wins(s, ["sample_id"], "__t").drop("__t")


def with_audio(spark, d, drawn, *columns):
    """Draws with the texts and the audio of their sample's last delivery.

    Which row is the last delivery (its file and place in it) comes from ids and
    times alone; texts and audio are then fetched once, for the drawn rows, so
    the bytes of other samples meet no aggregate and (by the join's filter at
    scale) no shuffle.
    """
    s = table(spark, d, "mds_samples").filter("sample_id is not null")
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    narrow = s.select("sample_id", F.col("ingested_at").cast("timestamp").alias("__t"), where.alias("__where"))
    last = ev.last_wins(narrow, ["sample_id"], "__t").select("sample_id", "__where.place", "__where.file")
    rows_ = s.select("sample_id", F.col("_metadata.row_index").alias("place"), F.col("_metadata.file_path").alias("file"), *columns, "context_audio")
    return drawn.join(last, "sample_id").join(rows_, ["sample_id", "place", "file"]).drop("place", "file")


LISTS = {lang: kinds["asr"] for lang, kinds in rows.PROMPTS.items()}
_q = lambda s: "'" + s.replace("'", "''") + "'"
ASR_MAP = "MAP {" + ", ".join(f"{_q(k)}: [{', '.join(map(_q, v))}]" for k, v in LISTS.items()) + "}"
AC_MAP = "MAP {" + ", ".join(f"{_q(k)}: [{', '.join(map(_q, v['ac']))}]" for k, v in rows.PROMPTS.items()) + "}"
LANG = f"CASE WHEN {H.format(f'{_q(str(SEED) + chr(58))} || sample_id || {_q(chr(58) + chr(108) + chr(97) + chr(110) + chr(103))}')} / 1152921504606846976.0 < 0.5 THEN 'en' ELSE lower(coalesce(language, 'en')) END"
PROMPT = f"""CASE WHEN task LIKE 'ASR%' THEN list_extract(coalesce(map_extract({ASR_MAP}, lang)[1], map_extract({ASR_MAP}, 'en')[1]), ({H.format(f"'{SEED}:' || sample_id || ':prompt'")} % len(coalesce(map_extract({ASR_MAP}, lang)[1], map_extract({ASR_MAP}, 'en')[1])) + 1)::bigint)
WHEN task = 'AC' THEN list_extract(coalesce(map_extract({AC_MAP}, lang)[1], map_extract({AC_MAP}, 'en')[1]), ({H.format(f"'{SEED}:' || sample_id || ':prompt'")} % len(coalesce(map_extract({AC_MAP}, lang)[1], map_extract({AC_MAP}, 'en')[1])) + 1)::bigint) ELSE coalesce(instruction_text, '') END"""
CLEAN = "trim(regexp_replace(regexp_replace(replace(response_text, chr(10), ' '), '(?i)[(<](SPN|ppo|ppl|ppb|ppc|laugh|unk|unknown)[)>]', '', 'g'), '\\s+', ' ', 'g'))"
HASHLESS = f"trim(regexp_replace(replace({CLEAN}, '#', ' '), '\\s+', ' ', 'g'))"
ANSWER = f"CASE WHEN task LIKE 'ASR%' THEN CASE WHEN regexp_matches({HASHLESS}, '<Speaker\\d>') THEN {HASHLESS} ELSE '<Speaker1>: ' || {HASHLESS} END ELSE response_text END"


@query(
    "entry_chat_rows",
    draw_sql(0) + f""", {FULL}, p AS (SELECT f.*, d.name, d.copy, {LANG} AS lang FROM drawn d JOIN full_rows f USING (sample_id) WHERE octet_length(f.context_audio) > 0)
SELECT sample_id, copy, name AS dataset, '<audio>' || {PROMPT} AS user_text, {ANSWER} AS assistant_text FROM p""",
)
def entry_chat_rows(spark, d):
    """Flagship: epoch draw, normalised answer, keyed prompt, chat row."""
    cfg = rows.RowConfig(seed=SEED)
    drawn = chosen(spark, d, 0).select("sample_id", "copy", "name")
    j = with_audio(spark, d, drawn, "task", "language", "instruction_text", "response_text")
    clean = t.add_speaker(t.remove_hash(t.remove_no_sound(F.col("response_text"))))
    j = j.withColumn("prompt", rows.random_prompt(F.col("sample_id"), F.col("language"), F.col("task"), F.col("instruction_text"), cfg)).withColumn("answer", F.when(F.substring("task", 1, 3) == "ASR", clean).otherwise(F.col("response_text")))
    built = rows.build_rows(j.withColumnRenamed("name", "dataset"), "prompt", "answer", "context_audio", ["sample_id", "copy", "dataset"], cfg)
    return built.select("_meta.sample_id", "_meta.copy", "_meta.dataset", F.col("messages")[0]["content"].alias("user_text"), F.col("messages")[1]["content"].alias("assistant_text"))


@query("prompt_pick", f"WITH {FULL}, p AS (SELECT *, 'en' AS lang FROM full_rows) SELECT sample_id, {PROMPT} AS prompt FROM p")
def prompt_pick(spark, d):
    """P36 in English only."""
    cfg = rows.RowConfig(prompt_type="random_english", seed=SEED)
    return full_rows(spark, d, "task", "language", "instruction_text").select("sample_id", rows.random_prompt(F.col("sample_id"), F.col("language"), F.col("task"), F.col("instruction_text"), cfg).alias("prompt"))


PAIRS = [("Say hello.", "Hello."), ("Count to three.", "One, two, three."), ("Name a colour.", "Blue.")]


@query(
    "instruction_dropout",
    f"""WITH {FULL}, k AS (SELECT *, {H.format(f"'{SEED}:' || sample_id || ':drop'")} / 1152921504606846976.0 < 0.1 AS dropped, {H.format(f"'{SEED}:' || sample_id || ':pair'")} % 3 AS i FROM full_rows)
SELECT sample_id, dropped, CASE WHEN dropped THEN list_extract([{', '.join(_q(a) for a, _ in PAIRS)}], (i + 1)::bigint) ELSE instruction_text END AS prompt, CASE WHEN dropped THEN list_extract([{', '.join(_q(b) for _, b in PAIRS)}], (i + 1)::bigint) ELSE response_text END AS answer FROM k""",
)
def instruction_dropout(spark, d):
    """J13, P38."""
    f = full_rows(spark, d, "instruction_text", "response_text").select("sample_id", F.col("instruction_text").alias("prompt"), F.col("response_text").alias("answer"))
    return rows.dropout(f, "prompt", "answer", F.col("sample_id"), PAIRS, rows.RowConfig(dropout=0.1, seed=SEED)).select("sample_id", "dropped", "prompt", "answer")


@query("context_prompt", f"WITH {FULL} SELECT sample_id, CASE WHEN length(coalesce(context_text, '')) > 0 THEN 'Context: ' || context_text || chr(10) || 'Question: ' || instruction_text ELSE instruction_text END AS prompt FROM full_rows")
def context_prompt(spark, d):
    """P39."""
    return full_rows(spark, d, "context_text", "instruction_text").select("sample_id", rows.context_prompt(F.col("context_text"), F.col("instruction_text")).alias("prompt"))


@query("drop_no_audio", f"WITH {FULL} SELECT trim(dataset) AS name, count(*) FILTER (WHERE coalesce(octet_length(context_audio), 0) = 0) AS n_without, count(*) AS n FROM full_rows GROUP BY 1")
def drop_no_audio(spark, d):
    """rows without audio bytes."""
    sized = table(spark, d, "mds_samples").filter("sample_id is not null").select("sample_id", "dataset", F.coalesce(F.length("context_audio"), F.lit(0)).alias("n_audio"), F.col("ingested_at").cast("timestamp").alias("__t"))
    return ev.last_wins(sized, ["sample_id"], "__t").groupBy(F.trim("dataset").alias("name")).agg(F.count_if(F.col("n_audio") == 0).alias("n_without"), F.count(F.lit(1)).alias("n"))


@query("chat_json", f"WITH {FULL} SELECT sample_id, '[{{\"role\":\"user\",\"content\":' || to_json(task) || '}}]' AS line FROM full_rows WHERE task IS NOT NULL")
def chat_json(spark, d):
    """K1: one JSON line a row."""
    m = F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("task").alias("content"))))
    return full_rows(spark, d, "task").filter("task is not null").select("sample_id", m.alias("line"))


@query("mix_budget", draw_sql(0) + ", c AS (SELECT name, count(*) AS n FROM drawn GROUP BY name) SELECT task AS label, count(*) AS n_sets, sum(n)::bigint AS n_rows, round(100.0 * sum(n) / sum(sum(n)) OVER (), 4) AS share FROM c JOIN (SELECT * FROM (SELECT trim(name) AS name, task, row_number() OVER (PARTITION BY trim(name) ORDER BY spec_id) AS rn FROM dataset_specs WHERE split = 'train') WHERE rn = 1) t USING (name) GROUP BY task")
def mix_budget(spark, d):
    """Rows an epoch and share by task."""
    c = chosen(spark, d, 0).groupBy("name").agg(F.count(F.lit(1)).alias("n")).join(specs(spark, d).select("name", "task"), "name")
    g = c.groupBy(F.col("task").alias("label")).agg(F.count(F.lit(1)).alias("n_sets"), F.sum("n").alias("n_rows"))
    return g.withColumn("share", F.round(100.0 * F.col("n_rows") / F.sum("n_rows").over(W.partitionBy()), 4))


RULES = """WITH s AS (SELECT *, trim(name) AS nm, row_number() OVER (PARTITION BY split, trim(name) ORDER BY spec_id) AS rn FROM dataset_specs)
SELECT spec_id, 'no name' AS rule FROM s WHERE coalesce(nm, '') = '' UNION ALL SELECT spec_id, 'no path' FROM s WHERE coalesce(trim(path), '') = '' UNION ALL SELECT spec_id, 'no task' FROM s WHERE coalesce(trim(task), '') = ''
UNION ALL SELECT spec_id, 'unknown split' FROM s WHERE split IS NULL OR split NOT IN ('train', 'validation') UNION ALL SELECT spec_id, 'duplicate name' FROM s WHERE rn > 1
UNION ALL SELECT spec_id, 'choose and repeat' FROM s WHERE choose IS NOT NULL AND "repeat" IS NOT NULL UNION ALL SELECT spec_id, 'unusable weight' FROM s WHERE weight IS NULL OR weight <= 0"""


@query("mix_violations", RULES)
def mix_violations(spark, d):
    """C1, F10."""
    return validation.mix_violations(table(spark, d, "dataset_specs"))


@query("spec_meta", "SELECT spec_id, trim(name) AS name, task, nullif(trim(language), '') AS language, nullif(trim(src_lang), '') AS src_lang, nullif(trim(tgt_lang), '') AS tgt_lang FROM dataset_specs")
def spec_meta(spark, d):
    """Only values that say something."""
    g = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    return table(spark, d, "dataset_specs").select("spec_id", F.trim("name").alias("name"), "task", g("language"), g("src_lang"), g("tgt_lang"))


@query("path_overlap", "SELECT DISTINCT replace(path, '/validation/', '/train/') AS path FROM dataset_specs WHERE split = 'validation' INTERSECT SELECT path FROM dataset_specs WHERE split = 'train'")
def path_overlap(spark, d):
    """Paths that both splits use (as given, the split's folder aside)."""
    s = table(spark, d, "dataset_specs")
    v = s.filter("split = 'validation'").select(F.replace("path", F.lit("/validation/"), F.lit("/train/")).alias("path"))
    return v.intersect(s.filter("split = 'train'").select("path"))


@query("config_audit", f"WITH a AS (SELECT trim(name) AS name, min(weight) AS w FROM dataset_specs WHERE split = 'train' GROUP BY 1), b AS (SELECT trim(name) AS name, min(weight) AS w FROM dataset_specs WHERE split = 'validation' GROUP BY 1) SELECT name, CASE WHEN a.w IS NULL AND b.w IS NOT NULL THEN 'only right' WHEN b.w IS NULL AND a.w IS NOT NULL THEN 'only left' WHEN a.w IS NOT DISTINCT FROM b.w OR abs(a.w - b.w) <= 1e-9 THEN 'same' ELSE 'different' END AS status FROM a FULL JOIN b USING (name)")
def config_audit(spark, d):
    """Two configurations, key by key."""
    s = table(spark, d, "dataset_specs").groupBy("split", F.trim("name").alias("name")).agg(F.min("weight").alias("w"))
    a, b = (s.filter(F.col("split") == x) for x in ("train", "validation"))
    return validation.config_diff(a, b, "name", "w").select("name", "status")


@query(
    "catalogue_lookup",
    """WITH w AS (SELECT DISTINCT regexp_replace(trim(name), '^[A-Z]+_', '') AS short FROM dataset_specs), c AS (SELECT DISTINCT trim(name) AS k FROM dataset_specs WHERE split = 'validation'),
t AS (SELECT short, unnest([{'r': 0, 'k': short}, {'r': 1, 'k': 'ASR_' || short}, {'r': 2, 'k': 'ST_' || short}, {'r': 3, 'k': 'SQA_' || short}], recursive := true) FROM w)
SELECT w.short, (SELECT arg_min(t.k, t.r) FROM t JOIN c ON c.k = t.k WHERE t.short = w.short) AS found FROM w""",
)
def catalogue_lookup(spark, d):
    """First of several candidate names in the catalogue."""
    s = table(spark, d, "dataset_specs")
    want = s.select(F.regexp_replace(F.trim("name"), "^[A-Z]+_", "").alias("short"))
    cat = s.filter("split = 'validation'").select(F.trim("name").alias("k"))
    return validation.ordered_lookup(want, "short", cat, "k", ["ASR_", "ST_", "SQA_"])


@query("catalogue_override", "WITH a AS (SELECT trim(name) AS name, min(path) AS p FROM dataset_specs WHERE split = 'train' GROUP BY 1), b AS (SELECT trim(name) AS name, min(path) AS p FROM dataset_specs WHERE split = 'validation' GROUP BY 1) SELECT name, coalesce(b.p, a.p) AS path FROM a FULL JOIN b USING (name)")
def catalogue_override(spark, d):
    """Entries of the right replace those of the same name."""
    s = table(spark, d, "dataset_specs").groupBy("split", F.trim("name").alias("name")).agg(F.min("path").alias("path"))
    a, b = (s.filter(F.col("split") == x).select("name", "path") for x in ("train", "validation"))
    return ev.merge_summary(a, b, ["name"], "path").select("name", "path")


@query("shard_sizes", "WITH s AS (SELECT shard_id, any_value(trim(dataset)) AS name, any_value(subdir) AS subdir, any_value(samples) AS n FROM shard_index GROUP BY shard_id) SELECT name, count(*) AS n_shards, sum(n)::bigint AS n_samples, count(DISTINCT subdir) AS n_subdirs FROM s GROUP BY name")
def shard_sizes(spark, d):
    """Shards and samples of every dataset."""
    s = table(spark, d, "shard_index").groupBy("shard_id").agg(F.any_value(F.trim("dataset")).alias("name"), F.any_value("subdir").alias("subdir"), F.any_value("samples").alias("n"))
    return s.groupBy("name").agg(F.count(F.lit(1)).alias("n_shards"), F.sum("n").cast("long").alias("n_samples"), F.countDistinct("subdir").alias("n_subdirs"))


@query("subdir_order", "SELECT name, subdir, (row_number() OVER (PARTITION BY name ORDER BY length(subdir), subdir))::int AS place FROM (SELECT DISTINCT trim(dataset) AS name, subdir FROM shard_index)")
def subdir_order(spark, d):
    """Folders by length, then name."""
    s = table(spark, d, "shard_index").select(F.trim("dataset").alias("name"), "subdir").distinct()
    return s.withColumn("place", F.row_number().over(W.partitionBy("name").orderBy(F.length("subdir"), "subdir")))


@query("shard_probe", "WITH s AS (SELECT DISTINCT trim(dataset) AS name, subdir, shard_no, basename FROM shard_index), k AS (SELECT *, row_number() OVER (PARTITION BY name, subdir ORDER BY shard_no, basename) - 1 AS i, count(*) OVER (PARTITION BY name, subdir) AS n FROM s) SELECT name, subdir, basename FROM k WHERE i IN (0, n // 2, n - 1)")
def shard_probe(spark, d):
    """First, middle and last shard of every folder."""
    s = table(spark, d, "shard_index").select(F.trim("dataset").alias("name"), "subdir", "shard_no", "basename").distinct()
    w = W.partitionBy("name", "subdir")
    k = s.withColumn("i", F.row_number().over(w.orderBy("shard_no", "basename")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    return k.filter("i = 0 or i = floor(n / 2) or i = n - 1").select("name", "subdir", "basename")


@query("hours_inventory", f"WITH {FULL} SELECT coalesce(task, '?') AS task, coalesce(nullif(lower(trim(language)), ''), '?') AS lang, round(sum(CASE WHEN duration > 0 THEN duration ELSE 0 END) / 3600, 6) AS hours, count(*) AS n FROM full_rows GROUP BY CUBE (1, 2)".replace("GROUP BY CUBE (1, 2)", "GROUP BY CUBE (coalesce(task, '?'), coalesce(nullif(lower(trim(language)), ''), '?'))"))
def hours_inventory(spark, d):
    """Hours and samples by task and language, with totals."""
    f = full_rows(spark, d, "task", "language", "duration").select(F.coalesce("task", F.lit("?")).alias("task"), F.coalesce(F.nullif(F.lower(F.trim("language")), F.lit("")), F.lit("?")).alias("lang"), F.when(F.col("duration") > 0, F.col("duration")).otherwise(0.0).alias("s"))
    return f.cube("task", "lang").agg(F.round(F.sum("s") / 3600, 6).alias("hours"), F.count(F.lit(1)).alias("n"))


@query("language_histogram", f"WITH {FULL} SELECT task, language, count(*) AS n FROM full_rows GROUP BY task, language ORDER BY n DESC, task NULLS FIRST, language NULLS FIRST LIMIT 60")
def language_histogram(spark, d):
    """The 60 largest groups."""
    return full_rows(spark, d, "task", "language").groupBy("task", "language").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("task"), F.asc_nulls_first("language")).limit(60)


@query("label_canonical", f"WITH {FULL} SELECT sample_id, CASE lower(string_split(trim(language), '-')[1]) WHEN 'english' THEN 'en' WHEN 'eng' THEN 'en' WHEN 'malay' THEN 'ms' WHEN 'msa' THEN 'ms' WHEN 'chinese' THEN 'zh' WHEN 'zho' THEN 'zh' ELSE lower(string_split(trim(language), '-')[1]) END AS label FROM full_rows WHERE language IS NOT NULL")
def label_canonical(spark, d):
    """E5: one string a class, from a small map."""
    m = F.create_map(*[F.lit(x) for x in ("english", "en", "eng", "en", "malay", "ms", "msa", "ms", "chinese", "zh", "zho", "zh")])
    low = F.lower(F.split_part(F.trim("language"), F.lit("-"), F.lit(1)))
    return full_rows(spark, d, "language").filter("language is not null").select("sample_id", F.coalesce(F.try_element_at(m, low), low).alias("label"))


@query("multilabel_serialise", "SELECT trim(dataset) AS name, array_to_string(list_sort(list(DISTINCT task) FILTER (WHERE task IS NOT NULL)), '|') AS tasks FROM mds_samples GROUP BY 1")
def multilabel_serialise(spark, d):
    """Labels in one order with one separator."""
    return table(spark, d, "mds_samples").groupBy(F.trim("dataset").alias("name")).agg(F.array_join(F.array_sort(F.collect_set("task")), "|").alias("tasks"))


@query("channel_metric", f"WITH {ITEMS} SELECT coalesce(task_type, '?') || ':' || coalesce(lower(trim(language)), '?') AS channel, count(*) AS n, round(avg(seconds), 6) AS mean_s FROM items GROUP BY 1")
def channel_metric(spark, d):
    """Metrics keyed by task:language."""
    ch = F.concat_ws(":", F.coalesce("task_type", F.lit("?")), F.coalesce(F.lower(F.trim("language")), F.lit("?")))
    return items(spark, d).groupBy(ch.alias("channel")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("seconds"), 6).alias("mean_s"))


@query("curriculum", f"WITH {ITEMS} SELECT item_id, row_number() OVER (ORDER BY seconds, item_id) - 1 AS place FROM items WHERE seconds > 0")
def curriculum(spark, d):
    """Short items first."""
    from undertone.operators.ranking import positions, value_hash

    i = items(spark, d).filter("seconds > 0").select("item_id", "seconds").withColumn("h", value_hash(F.col("seconds")))
    return positions(i, "h", ["seconds", "item_id"], into="place", bits=24).select("item_id", "place")


@query("length_buckets", f"WITH {ITEMS} SELECT (floor(ln(seconds) / ln(1.5)))::bigint AS bucket, count(*) AS n, round(sum(seconds), 4) AS total_s FROM items WHERE seconds > 0 GROUP BY 1")
def length_buckets(spark, d):
    """Clips of similar length together."""
    b = F.floor(F.ln("seconds") / F.ln(F.lit(1.5)))
    return items(spark, d).filter("seconds > 0").groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("seconds"), 4).alias("total_s"))


@query("agreement_filter", f"WITH {FULL}, j AS (SELECT sample_id, lower(string_split(trim(language), '-')[1]) AS a, regexp_extract(trim(dataset), '_([a-z]{{2}})_(?:\\d+_)?[A-Z]+$', 1) AS b FROM full_rows) SELECT CASE WHEN coalesce(a, '') = '' OR b = '' THEN 'unknown' WHEN a = b THEN 'keep' ELSE 'review' END AS route, count(*) AS n FROM j GROUP BY 1")
def agreement_filter(spark, d):
    """Keep where two sources agree, review where they don't."""
    a = F.lower(F.split_part(F.trim("language"), F.lit("-"), F.lit(1)))
    b = F.regexp_extract(F.trim("dataset"), r"_([a-z]{2})_(?:\d+_)?[A-Z]+$", 1)
    route = F.when((F.coalesce(a, F.lit("")) == "") | (b == ""), "unknown").when(a == b, "keep").otherwise("review")
    return full_rows(spark, d, "language", "dataset").groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


CANDIDATES = ("harbour", "lantern", "kopi", "tiffin", "brass", "bamboo", "seawall", "ferry", "longtable", "raincheck")


@query("candidate_lists", f"WITH {ITEMS}, c AS (SELECT unnest([{', '.join(map(_q, CANDIDATES))}]) AS w), k AS (SELECT item_id, w, row_number() OVER (PARTITION BY item_id ORDER BY {H.format(chr(39) + 'cand:' + chr(39) + ' || item_id || ' + chr(39) + ':' + chr(39) + ' || w')}, w) AS rn, {H.format(chr(39) + 'size:' + chr(39) + ' || item_id')} % 3 * 5 AS n FROM items, c WHERE NOT contains(lower(coalesce(answer, '')), w)) SELECT item_id, array_to_string(list(w ORDER BY rn), ',') AS candidates FROM k WHERE rn <= n GROUP BY item_id")
def candidate_lists(spark, d):
    """Keyed lists of 0, 5 or 10 distractors, none from the transcript."""
    words_ = F.filter(F.array(*[F.lit(w) for w in CANDIDATES]), lambda w: ~F.contains(F.lower(F.coalesce("answer", F.lit(""))), w))
    h = lambda w: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("cand"), F.col("item_id").cast("string"), w)), 1, 15), 16, 10).cast("long")
    n = F.pmod(hashed(key("size", F.col("item_id"))), F.lit(3)) * 5
    order = F.transform(F.array_sort(F.transform(words_, lambda w: F.struct(h(w).alias("h"), w.alias("w")))), lambda s: s["w"])
    i = items(spark, d).withColumn("n", n.cast("int")).withColumn("c", order)
    return i.filter("n > 0 and size(c) > 0").select("item_id", F.array_join(F.slice("c", 1, F.col("n")), ",").alias("candidates"))


@query("leakage_exact", f"WITH {ITEMS}, {FULL}, a AS (SELECT DISTINCT md5(lower(trim(answer))) AS k, item_id, set_name FROM items WHERE trim(coalesce(answer, '')) <> '') SELECT set_name, count(DISTINCT item_id) AS n_items, count(DISTINCT sample_id) AS n_samples FROM a JOIN full_rows f ON md5(lower(trim(f.response_text))) = a.k GROUP BY set_name")
def leakage_exact(spark, d):
    """Equal texts of both sides by hash."""
    a = items(spark, d).filter("trim(coalesce(answer, '')) <> ''").select(F.md5(F.lower(F.trim("answer"))).alias("k"), "item_id", "set_name")
    f = full_rows(spark, d, "response_text").filter("response_text is not null").select(F.md5(F.lower(F.trim("response_text"))).alias("k"), "sample_id")
    return a.join(f, "k").groupBy("set_name").agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct("sample_id").alias("n_samples"))


@query(
    "merge_speakers",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, regexp_extract(line, '^(user|assistant): ', 1) AS who, trim(regexp_replace(line, '^(user|assistant): ', '')) AS said FROM l WHERE regexp_matches(line, '^(user|assistant): ')),
n AS (SELECT *, CASE WHEN who = lag(who) OVER w THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM n)
SELECT doc_id, island::bigint AS turn, any_value(who) AS who, array_to_string(list(said ORDER BY pos), ' ') AS said FROM i GROUP BY doc_id, island""",
)
def merge_speakers(spark, d):
    """Neighbours of one speaker joined; lines without a tag dropped."""
    docs = table(spark, d, "documents").filter("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.col("line").rlike("^(user|assistant): "))
    tagged = lines.select("doc_id", "pos", F.regexp_extract("line", "^(user|assistant): ", 1).alias("who"), F.trim(F.regexp_replace("line", "^(user|assistant): ", "")).alias("said"))
    i = ev.islands(tagged, ["doc_id"], "pos", "who")
    return i.groupBy("doc_id", F.col("island").alias("turn")).agg(F.any_value("who").alias("who"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "said"))), lambda x: x["said"]), " ").alias("said"))


LOG = "lines AS (SELECT doc_id, source, try_cast(m[1] AS bigint) AS step, try_cast(m[2] AS bigint) AS most, try_cast(m[3] AS double) AS loss FROM (SELECT doc_id, source, regexp_extract_all(line, 'because step (\\d+) of (\\d+) gave a loss of ([0-9.]*[0-9])', 0) AS hit, line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)) q, LATERAL (SELECT [regexp_extract(line, 'because step (\\d+) of (\\d+) gave a loss of ([0-9.]*[0-9])', 1), regexp_extract(line, 'because step (\\d+) of (\\d+) gave a loss of ([0-9.]*[0-9])', 2), regexp_extract(line, 'because step (\\d+) of (\\d+) gave a loss of ([0-9.]*[0-9])', 3)] AS m) WHERE len(hit) > 0)"


def log_lines(spark, d):
    r = r"because step (\d+) of (\d+) gave a loss of ([0-9.]*[0-9])"
    e = table(spark, d, "documents").filter("text is not null").select("doc_id", "source", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(r))
    g = lambda i, ty: F.regexp_extract("line", r, i).try_cast(ty)
    return e.select("doc_id", "source", g(1, "bigint").alias("step"), g(2, "bigint").alias("most"), g(3, "double").alias("loss"))


@query("log_summary", f"WITH {LOG} SELECT source, count(*) AS n, min(loss) AS least, max(loss) AS most_loss, max(step) AS last_step, round(avg(step / most), 6) AS progress FROM lines GROUP BY source")
def log_summary(spark, d):
    """Training log lines out of run logs."""
    return log_lines(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("loss").alias("least"), F.max("loss").alias("most_loss"), F.max("step").alias("last_step"), F.round(F.avg(F.col("step") / F.col("most")), 6).alias("progress"))


@query("resume_loss_diff", f"WITH {LOG}, a AS (SELECT step, avg(loss) AS l FROM lines WHERE doc_id % 2 = 0 GROUP BY step), b AS (SELECT step, avg(loss) AS l FROM lines WHERE doc_id % 2 = 1 GROUP BY step) SELECT count(*) AS n_steps, round(max(abs(a.l - b.l)), 6) AS most FROM a JOIN b USING (step)")
def resume_loss_diff(spark, d):
    """Common steps of two runs."""
    s = log_lines(spark, d).groupBy((F.col("doc_id") % 2).alias("run"), "step").agg(F.avg("loss").alias("l"))
    a, b = s.filter("run = 0").select("step", F.col("l").alias("a")), s.filter("run = 1").select("step", F.col("l").alias("b"))
    return a.join(b, "step").agg(F.count(F.lit(1)).alias("n_steps"), F.round(F.max(F.abs(F.col("a") - F.col("b"))), 6).alias("most"))


@query("steady_throughput", "SELECT user_id, round((count(*) - 1) / greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 1e-3), 9) AS per_second FROM events GROUP BY user_id HAVING count(*) > 1")
def steady_throughput(spark, d):
    """Steps over elapsed time between the first and the last event."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    e = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).filter("n > 1")
    return e.select("user_id", F.round((F.col("n") - 1) / F.greatest((us(F.col("b")) - us(F.col("a"))) / F.lit(1e6), F.lit(1e-3)), 9).alias("per_second"))


@query("rank_logs", "SELECT user_id % 4 AS rank, count(*) AS n, count(*) - count(DISTINCT event_id) AS dup_within FROM events GROUP BY 1")
def rank_logs(spark, d):
    """Ids logged by each rank."""
    e = table(spark, d, "events").select((F.col("user_id") % 4).alias("rank"), "event_id").groupBy("rank", "event_id").agg(F.count(F.lit(1)).alias("c"))
    return e.groupBy("rank").agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("dup_within"))


_EDGE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


@query("transcript_lines", f"SELECT doc_id, line_no, string_split(l, ' ')[1] AS uid, substr(l, length(string_split(l, ' ')[1]) + 2) AS rest FROM (SELECT doc_id, k AS line_no, regexp_replace(regexp_replace(ls[k], '^{_EDGE}', ''), '{_EDGE}$', '') AS l FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS ls FROM documents WHERE text IS NOT NULL))) WHERE contains(l, ' ')")
def transcript_lines(spark, d):
    """Id and text of every line of a document, without blanks at its
    ends and split once at the first blank; a line without one has no text."""
    x = table(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", r"\r\n|\r|\n", -1)).alias("k", "l"))
    l = F.regexp_replace(F.regexp_replace("l", f"^{_EDGE}", ""), rf"{_EDGE}\z", "")  # noqa: E741
    p = F.split("l", " ", 2)
    return x.select("doc_id", (F.col("k") + 1).alias("line_no"), l.alias("l")).filter(F.contains("l", F.lit(" "))).select("doc_id", "line_no", p[0].alias("uid"), p[1].alias("rest"))


@query("condition_intersect", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) INTERSECT SELECT DISTINCT user_id FROM events WHERE event_type = (SELECT max(event_type) FROM events))")
def condition_intersect(spark, d):
    """Keys that both conditions have."""
    e = table(spark, d, "events").select("event_type", "user_id").distinct()
    span = e.agg(F.min("event_type").alias("a"), F.max("event_type").alias("b"))
    j = e.crossJoin(F.broadcast(span))
    return j.filter("event_type = a").select("user_id").intersect(j.filter("event_type = b").select("user_id")).agg(F.count(F.lit(1)).alias("n"))


@query("task_reward", f"WITH {ITEMS} SELECT task_type, round(avg(greatest(0, 1 - abs(length(coalesce(answer, '')) / greatest(seconds * 14, 1) - 1))), 6) AS reward FROM items GROUP BY task_type")
def task_reward(spark, d):
    """Reward with a penalty for a length off the expected one."""
    r = F.greatest(F.lit(0.0), 1 - F.abs(F.length(F.coalesce("answer", F.lit(""))) / F.greatest(F.col("seconds") * 14, F.lit(1.0)) - 1))
    return items(spark, d).groupBy("task_type").agg(F.round(F.avg(r), 6).alias("reward"))


@query("short_clip_text", f"WITH {FULL} SELECT sample_id, CASE WHEN duration * 16000 < 500 THEN 'EMPTY' ELSE response_text END AS y FROM full_rows")
def short_clip_text(spark, d):
    """the text of a clip under 500 samples."""
    return full_rows(spark, d, "duration", "response_text").select("sample_id", F.when(F.col("duration") * 16000 < 500, "EMPTY").otherwise(F.col("response_text")).alias("y"))


@query("disjoint_cover", draw_sql(0) + f", r AS (SELECT DISTINCT sample_id, sample_id % 3 AS part FROM drawn) SELECT (SELECT count(*) FROM r a JOIN r b ON a.sample_id = b.sample_id AND a.part < b.part) AS n_shared, (SELECT count(*) FROM r) - (SELECT count(DISTINCT sample_id) FROM drawn) AS n_missing")
def disjoint_cover(spark, d):
    """Parts are disjoint and their union is everything."""
    c = chosen(spark, d, 0).select("sample_id").distinct()
    parts = [c.filter(F.col("sample_id") % 3 == i) for i in range(3)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    shared = union.groupBy("sample_id").count().filter("count > 1").agg(F.count(F.lit(1)).alias("n_shared"))
    missing = c.exceptAll(union).agg(F.count(F.lit(1)).alias("n_missing"))
    return shared.crossJoin(missing)


@query("mix_yaml")
def mix_yaml(spark, d):
    """K6: lines of a generated mix file, with counts as comments."""
    n = samples(spark, d).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    s = specs(spark, d).join(n, "name", "left")
    line = F.concat(F.lit("  - {name: "), F.col("name"), F.lit(", task: "), F.col("task"), F.coalesce(F.concat(F.lit(", choose: "), F.col("choose").cast("string")), F.coalesce(F.concat(F.lit(", repeat: "), F.col("repeat").cast("string")), F.lit(""))), F.lit("}  # "), F.coalesce(F.col("n"), F.lit(0)).cast("string"), F.lit(" samples"))
    return s.select("spec_id", line.alias("line"))
