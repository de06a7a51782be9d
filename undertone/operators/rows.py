"""Prompts and chat rows.

Prompt lists are tables (language, kind, idx, text); the ones here are this
package's own. Every choice is a keyed pick, so a row is the same wherever and
whenever it is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from undertone.functions.keyed import key, pick, uniform

# Own instruction texts.
PROMPTS = {
    "en": {"asr": ["Write down what the speaker says.", "Give a transcript of this recording.", "Turn the speech into text."], "ac": ["Name the sound you hear.", "Describe the audio in a phrase."], "no_punct": ["Leave out punctuation."], "lower": ["Use lower case."], "upper": ["Use capitals."]},
    "zh": {"asr": ["请写下录音内容。", "请把语音转成文字。"], "ac": ["请说出听到的声音。"], "no_punct": ["不要标点。"], "lower": ["用小写。"], "upper": ["用大写。"]},
    "ms": {"asr": ["Tulis apa yang disebut.", "Salin rakaman ini."], "ac": ["Namakan bunyi ini."], "no_punct": ["Tanpa tanda baca."], "lower": ["Guna huruf kecil."], "upper": ["Guna huruf besar."]},
}


@dataclass(frozen=True)
class RowConfig:
    """How prompts and rows are made."""

    prompt_type: str = "random_multilingual"
    english_weight: float = 0.5
    dropout: float = 0.0
    keep_audio: bool = True
    system: str | None = None
    seed: int = 9176

    def __post_init__(self):
        if self.prompt_type not in ("none", "dataset", "random_english", "random_multilingual"):
            raise ValueError(f"unknown prompt type {self.prompt_type}")
        if not 0 <= self.english_weight <= 1 or not 0 <= self.dropout <= 1:
            raise ValueError("weights and rates lie in [0, 1]")


def prompt_table(spark: SparkSession) -> DataFrame:
    """All instruction texts as rows."""
    rows = [(lang, kind, i, t) for lang, kinds in PROMPTS.items() for kind, ts in kinds.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "lang string, kind string, idx int, text string")


def _lists(kind: str) -> Column:
    return F.create_map(*[x for lang, k in PROMPTS.items() for x in (F.lit(lang), F.array(*[F.lit(t) for t in k[kind]]))])


def random_prompt(sample: Column, language: Column, task: Column, given: Column, cfg: RowConfig) -> Column:
    """ASR and AC tasks get a keyed prompt, others keep theirs;
    languages without a list use English."""
    if cfg.prompt_type == "none":
        return F.lit("")
    if cfg.prompt_type == "dataset":
        return F.coalesce(given, F.lit(""))
    use_english = uniform(key(cfg.seed, sample, "lang")) < F.lit(cfg.english_weight) if cfg.prompt_type == "random_multilingual" else F.lit(True)
    lang = F.when(use_english, F.lit("en")).otherwise(F.lower(F.coalesce(language, F.lit("en"))))
    choose = lambda kind: F.coalesce(F.try_element_at(_lists(kind), lang), F.try_element_at(_lists(kind), F.lit("en")))
    k = key(cfg.seed, sample, "prompt")
    of = lambda kind: F.element_at(choose(kind), (pick(k, F.size(choose(kind))) + 1).cast("int"))
    return F.when(F.substring(task, 1, 3) == "ASR", of("asr")).when(task == "AC", of("ac")).otherwise(F.coalesce(given, F.lit("")))


def dropout(df: DataFrame, prompt: str, answer: str, sample: Column, pairs: list[tuple[str, str]], cfg: RowConfig) -> DataFrame:
    """With probability ``dropout`` a text pair replaces both sides."""
    p = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    hit = uniform(key(cfg.seed, sample, "drop")) < cfg.dropout
    one = F.element_at(p, (pick(key(cfg.seed, sample, "pair"), len(pairs)) + 1).cast("int"))
    return df.withColumn("dropped", hit).withColumn(prompt, F.when(hit, one["a"]).otherwise(F.col(prompt))).withColumn(answer, F.when(hit, one["b"]).otherwise(F.col(answer)))


def build_rows(df: DataFrame, prompt: str, answer: str, audio: str, meta: list[str], cfg: RowConfig) -> DataFrame:
    """(messages, audios, _meta); rows without audio are null rows and
    left to the caller's replacement (they are filtered here)."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = [turn("user", F.concat(F.lit("<audio>"), F.col(prompt))), turn("assistant", F.col(answer))]
    if cfg.system:
        messages.insert(0, turn("system", F.lit(cfg.system)))
    return df.filter(F.length(audio) > 0).select(F.array(*messages).alias("messages"), F.array(audio).alias("audios"), F.struct(*meta).alias("_meta"))


def context_prompt(context: Column, question: Column) -> Column:
    """Layout of a text context before a question."""
    return F.when(F.length(F.coalesce(context, F.lit(""))) > 0, F.concat(F.lit("Context: "), context, F.lit("\nQuestion: "), question)).otherwise(question)
