"""Projections over text (inventory 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from undertone.functions import numbers, text as t
from undertone.plans.base import query
from undertone.sources.tables import table

#: Distinct texts of the training samples with task and language.
BASE = "base AS (SELECT DISTINCT sample_id, response_text AS x, task, language, trim(dataset) AS name FROM mds_samples WHERE response_text IS NOT NULL)"
#: What may stand beside a whole word.
EDGE = "[^\\p{L}\\p{N}_]"
SQ = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


def base(spark, d):
    return table(spark, d, "mds_samples").filter("response_text is not null").select("sample_id", F.col("response_text").alias("x"), "task", "language", F.trim("dataset").alias("name")).distinct()


def text_query(name: str, f, sql: str | None):
    """Register ``sample_id, y`` of one text function with its SQL over x."""

    def run(spark, d):
        return base(spark, d).select("sample_id", f(F.col("x")).alias("y"))

    query(name, f"WITH {BASE} SELECT sample_id, {sql} AS y FROM base" if sql else None)(run)


def words_sql(x: str, pairs, title=False) -> str:
    for a, b in pairs:
        for p, q in ((a, b), (a.capitalize(), b.capitalize())) if title else ((a, b),):
            p, q = p.replace("'", "''"), q.replace("'", "''")
            x = f"regexp_replace(regexp_replace({x}, '(^|{EDGE}){p}($|{EDGE})', '\\1{q}\\2', 'g'), '(^|{EDGE}){p}($|{EDGE})', '\\1{q}\\2', 'g')"
    return x


NOSOUND = SQ.format("regexp_replace(replace(x, chr(10), ' '), '(?i)[(<](SPN|ppo|ppl|ppb|ppc|laugh|unk|unknown)[)>]', '', 'g')")
text_query("normalize_nosound", t.remove_no_sound, NOSOUND)
text_query("normalize_hashtag", t.remove_hash, SQ.format("replace(x, '#', ' ')"))
text_query("normalize_speaker", t.add_speaker, "CASE WHEN regexp_matches(x, '<Speaker\\d>') THEN x ELSE '<Speaker1>: ' || x END")
text_query("strip_speaker_tags", t.strip_speaker_tags, "trim(regexp_replace(x, '(?i)<\\s*speaker\\s*\\d+\\s*(,\\s*[mf])?\\s*>\\s*:?', ' ', 'g'))")
text_query("normalize_lower", t.lower_keep_speaker, "replace(lower(x), '<speaker', '<Speaker')")
text_query("normalize_language_wrappers", t.unwrap_language, SQ.format("regexp_replace(regexp_replace(x, '<(tamil|malay|mandarin)>([^<>:]*):?([^<>:]*)</(tamil|malay|mandarin)>', '\\2', 'g'), '\\s?[\\[(<][a-zA-Z]*[\\])>]\\s?', ' ', 'g')"))
text_query("normalize_punctuation_tags", t.punctuation_tags, "replace(replace(replace(replace(regexp_replace(x, '<SIL>|<MUSIC>|<NOISE>|<OTHER>', '', 'g'), '<COMMA>', ','), '<PERIOD>', '.'), '<QUESTIONMARK>', '?'), '<EXCLAMATIONPOINT>', '!')")
text_query("normalize_smoke", t.smoke, SQ.format("regexp_replace(replace(upper(x), '’', ''''), '[^A-Z0-9'' ]', ' ', 'g')"))
text_query("normalize_brackets", t.remove_bracketed, "regexp_replace(x, '[\\[({<][^\\[\\](){}<>]*[\\])}>]', '', 'g')")
text_query("normalize_brackets_compat", lambda c: t.remove_bracketed(c, True), "regexp_replace(x, '[\\[({<][^()\\\\n\\[\\]]*[\\])}>]', '', 'g')")
text_query("normalize_nonspeech", t.remove_non_speech, SQ.format(f"regexp_replace(regexp_replace(x, '(^|{EDGE})(uh|umm|um|er|ah)($|{EDGE})', '\\1\\3', 'g'), '(^|{EDGE})(uh|umm|um|er|ah)($|{EDGE})', '\\1\\3', 'g')"))
text_query("normalize_space_cjk", t.space_out, SQ.format("regexp_replace(x, '([\\x{4e00}-\\x{9fff}\\x{0e00}-\\x{0e7f}])', ' \\1 ', 'g')"))
text_query("normalize_symbols", t.symbols_and_marks, "regexp_replace(x, '[\\p{M}\\p{S}\\p{P}]', ' ', 'g')")
text_query("normalize_basic", t.basic, SQ.format("regexp_replace(regexp_replace(regexp_replace(lower(x), '[<\\[][^>\\]]*[>\\]]', '', 'g'), '\\(([^)]+?)\\)', '', 'g'), '[\\p{S}\\p{P}]', ' ', 'g')"))
text_query("squeeze_han", t.squeeze_han, "trim(regexp_replace(regexp_replace(x, '([\\x{4e00}-\\x{9fff}])\\s+([\\x{4e00}-\\x{9fff}])', '\\1\\2', 'g'), '([\\x{4e00}-\\x{9fff}])\\s+([\\x{4e00}-\\x{9fff}])', '\\1\\2', 'g'))")
text_query("squeeze_thai", t.squeeze_thai, "trim(regexp_replace(regexp_replace(x, '([\\x{0e00}-\\x{0e7f}])\\s+([\\x{0e00}-\\x{0e7f}])', '\\1\\2', 'g'), '([\\x{0e00}-\\x{0e7f}])\\s+([\\x{0e00}-\\x{0e7f}])', '\\1\\2', 'g'))")
text_query("apostrophes", t.apostrophes, words_sql("x", t.APOSTROPHES, True))


def _spelled(w: str) -> str:
    for pattern, american in t._spelling_patterns(t.SPELLING_RULES):
        w = f"regexp_replace({w}, '{pattern}', '\\1{american}\\2')"
    return w


text_query("spelling_map", t.spelling, "array_to_string(list_transform(string_split(x, ' '), lambda w: coalesce(map_extract(MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in t.SPELLING) + "}, w)[1], " + _spelled("w") + ")), ' ')")
text_query("normalize_digits", t.digit_words, words_sql(words_sql("x", t.DIGITS), t.CONTRACTIONS))
text_query("basic_composed", numbers.basic_composed, None)
text_query("number_normalize", numbers.number_words, None)
text_query("nfkd_clean", numbers.without_diacritics, None)
text_query("english_normalize", numbers.english_text, None)
text_query("fillers", t.fillers, None)
text_query("tag_punct", t.punct_in_tags, None)
text_query("correct_words", lambda c: t.correct_words(c, [("kopi o", "kopi-o"), ("mrt", "MRT")], [("hand phone", "handphone"), ("any how", "anyhow")]), None)


@query("case_flags", f"WITH {BASE} SELECT sample_id, regexp_matches(x, '\\p{{L}}') AND NOT regexp_matches(x, '\\p{{Ll}}|\\p{{Lt}}|\\p{{Lm}}|\\p{{Lo}}') AS all_upper, regexp_matches(x, '\\p{{L}}') AND NOT regexp_matches(x, '\\p{{Lu}}|\\p{{Lt}}|\\p{{Lm}}|\\p{{Lo}}') AS all_lower, regexp_matches(x, '\\p{{P}}') AS has_punctuation FROM base")
def case_flags(spark, d):
    """P3, P4."""
    return base(spark, d).select("sample_id", t.all_upper(F.col("x")).alias("all_upper"), t.all_lower(F.col("x")).alias("all_lower"), t.has_punctuation(F.col("x")).alias("has_punctuation"))


SCRIPTS = "list_filter([CASE WHEN regexp_matches(x, '[\\x{4e00}-\\x{9fff}]') THEN 'zh' END, CASE WHEN regexp_matches(x, '[\\x{0e00}-\\x{0e7f}]') THEN 'th' END, CASE WHEN regexp_matches(x, '[\\x{0b80}-\\x{0bff}]') THEN 'ta' END, CASE WHEN regexp_matches(x, '[ĂăĐđĨĩŨũƠơƯưẠ-ỹ]') THEN 'vi' END], lambda c: c IS NOT NULL)"


@query("script_detect", f"WITH {BASE} SELECT sample_id, array_to_string({SCRIPTS}, ',') AS scripts FROM base")
def script_detect(spark, d):
    """P15."""
    return base(spark, d).select("sample_id", F.array_join(t.scripts(F.col("x")), ",").alias("scripts"))


_NAMES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in t.LANGUAGE_NAMES.items()) + "}"


@query("language_tag", f"WITH {BASE}, s AS (SELECT *, {SCRIPTS} AS sc, coalesce(language, 'unk') AS l FROM base) SELECT sample_id, '<speech_language: ' || CASE WHEN l = 'codeswitch' THEN 'English,' || CASE WHEN len(sc) > 0 THEN array_to_string(list_transform(sc, lambda k: map_extract({_NAMES}, k)[1]), ',') ELSE 'other' END ELSE coalesce(map_extract({_NAMES}, l)[1], 'Unknown') END || '>' || x AS y FROM s")
def language_tag(spark, d):
    """Tags with names."""
    return base(spark, d).select("sample_id", t.language_tag(F.col("x"), F.col("language")).alias("y"))


_TOKENS = "MAP {" + ", ".join(f"'{k}': '{'<unused12>' if k in t.CHINESE_KIN else ''}<unused{v}>'" for k, v in t.LANGUAGE_IDS.items()) + "}"


@query("language_token", f"WITH {BASE}, s AS (SELECT *, {SCRIPTS} AS sc, coalesce(language, 'unk') AS l FROM base) SELECT sample_id, coalesce(map_extract({_TOKENS}, l)[1], '<unused18>') || CASE WHEN l = 'codeswitch' THEN array_to_string(list_transform(sc, lambda k: map_extract({_TOKENS}, k)[1]), '') ELSE '' END || x AS y FROM s")
def language_token(spark, d):
    """Special tokens."""
    return base(spark, d).select("sample_id", t.language_tag(F.col("x"), F.col("language"), False).alias("y"))


@query("language_ids", f"WITH {BASE} SELECT sample_id, coalesce(map_extract(MAP {{{', '.join(f'{chr(39)}{k}{chr(39)}: {v}' for k, v in t.LANGUAGE_IDS.items())}}}, language)[1], -1) AS language_id, string_split(language, '-')[1] AS base_language FROM base")
def language_ids(spark, d):
    """P2, P34."""
    return base(spark, d).select("sample_id", t.language_id(F.col("language")).alias("language_id"), t.base_language(F.col("language")).alias("base_language"))


@query(
    "resolve_language",
    f"""WITH {BASE}, sp AS (SELECT * FROM (SELECT trim(name) AS name, language AS mix, src_lang, tgt_lang, row_number() OVER (PARTITION BY trim(name) ORDER BY spec_id) AS rn FROM dataset_specs WHERE split = 'train') WHERE rn = 1),
j AS (SELECT b.sample_id, b.name, nullif(trim(b.language), '') AS l, nullif(trim(mix), '') AS mix, coalesce(string_split(nullif(trim(src_lang), ''), '-')[1], nullif(regexp_extract(b.name, '_([a-z]{{2}})_([a-z]{{2}})_(?:\\d+_)?ST$', 1), '')) AS src, coalesce(string_split(nullif(trim(tgt_lang), ''), '-')[1], nullif(regexp_extract(b.name, '_([a-z]{{2}})_([a-z]{{2}})_(?:\\d+_)?ST$', 2), '')) AS tgt FROM base b LEFT JOIN sp USING (name))
SELECT sample_id, src, tgt, coalesce(l, mix, src, nullif(regexp_extract(name, '_([a-z]{{2}}|codeswitch)_(?:\\d+_)?(?:ASR|AC)$', 1), ''), '') AS language FROM j""",
)
def resolve_language(spark, d):
    """Column, mix entry, then the dataset's name."""
    from undertone.plans.sampling_queries import specs

    s = specs(spark, d).select("name", F.col("language").alias("mix"), "src_lang", "tgt_lang")
    j = base(spark, d).join(s, "name", "left")
    src, tgt, lang = t.resolve_languages(F.col("name"), F.col("language"), F.col("mix"), F.col("src_lang"), F.col("tgt_lang"))
    return j.select("sample_id", src.alias("src"), tgt.alias("tgt"), lang.alias("language"))


@query("standardize_response")
def standardize_response(spark, d):
    """P5."""
    return base(spark, d).select("sample_id", t.standardize(F.col("x"), F.coalesce("task", F.lit("")), F.col("language")).alias("y"))


def _13a(x: str) -> str:
    for a, b in (("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"), ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'")):
        x = f"replace({x}, {a}, {b})"
    x = f"' ' || {x} || ' '"
    for a, b in ((r"([\{-\~\[-\x60 -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        x = f"regexp_replace({x}, '{a}', '{b}', 'g')"
    return SQ.format(x)


@query("tokenize_13a", f"WITH {BASE} SELECT sample_id, {_13a('x')} AS y FROM base")
def tokenize_13a(spark, d):
    """P33."""
    return base(spark, d).select("sample_id", F.array_join(t.tokens_13a(F.col("x")), " ").alias("y"))


@query(
    "metric_routing",
    """SELECT spec_id, CASE WHEN contains(path, 'ASR/') THEN 'wer' WHEN contains(path, 'ST/') THEN 'bleu' WHEN contains(path, 'AC/') OR contains(path, 'AQA/') THEN 'meteor' END AS metric,
CASE WHEN contains(path, 'ASR/') THEN CASE WHEN contains(lower(path), 'gigaspeech') THEN 'gigaspeech' WHEN contains(lower(path), 'imda') THEN 'imda' WHEN contains(lower(path), 'aishell') THEN 'aishell' ELSE 'default' END END AS dataset,
CASE WHEN contains(path, 'ASR/') THEN CASE WHEN contains(lower(path), 'gigaspeech') THEN 'en' WHEN contains(lower(path), 'imda') THEN CASE WHEN contains(lower(path), 'part4') THEN 'en_zh_ms_ta' ELSE 'en' END WHEN contains(lower(path), 'aishell') THEN 'zh' ELSE 'en' END WHEN contains(path, 'ST/') AND contains(path, 'en_zh') THEN 'zh' END AS target FROM dataset_specs""",
)
def metric_routing(spark, d):
    """Metric, dataset rule and target language by parts of the path."""
    has = lambda x: F.contains("path", F.lit(x))
    low = lambda x: F.contains(F.lower("path"), F.lit(x))
    asr, st = has("ASR/"), has("ST/")
    metric = F.when(asr, "wer").when(st, "bleu").when(has("AC/") | has("AQA/"), "meteor")
    dataset = F.when(asr, F.when(low("gigaspeech"), "gigaspeech").when(low("imda"), "imda").when(low("aishell"), "aishell").otherwise("default"))
    target = F.when(asr, F.when(low("gigaspeech"), "en").when(low("imda"), F.when(low("part4"), "en_zh_ms_ta").otherwise("en")).when(low("aishell"), "zh").otherwise("en")).when(st & has("en_zh"), "zh")
    return table(spark, d, "dataset_specs").select("spec_id", metric.alias("metric"), dataset.alias("dataset"), target.alias("target"))


@query("error_unit", "SELECT name, CASE WHEN lang IN ('zh', 'th', 'lo', 'km', 'my') THEN 'cer' WHEN lang = 'codeswitch' THEN 'mer' ELSE 'wer' END AS unit FROM eval_sets WHERE task = 'ASR'")
def error_unit(spark, d):
    """Unit of the error rate by language."""
    from undertone.operators.metrics import CHARACTER_LANGUAGES

    unit = F.when(F.col("lang").isin(*CHARACTER_LANGUAGES), "cer").when(F.col("lang") == "codeswitch", "mer").otherwise("wer")
    return table(spark, d, "eval_sets").filter("task = 'ASR'").select("name", unit.alias("unit"))


@query("model_out_name", "SELECT name, CASE WHEN processor IN ('base', 'none') THEN 'base' ELSE regexp_extract(path, '[^/]+$') END AS out_name FROM eval_sets")
def model_out_name(spark, d):
    """P40."""
    return table(spark, d, "eval_sets").select("name", F.when(F.col("processor").isin("base", "none"), "base").otherwise(F.regexp_extract("path", "[^/]+$", 0)).alias("out_name"))
