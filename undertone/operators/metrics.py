"""Error rates, BLEU and class metrics as aggregates, and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from undertone.functions.text import space_out, tokens_13a
from undertone.functions.tokens import edit_distance, let, ngrams, words
from undertone.operators.ranking import positions, value_hash

REGISTRY: dict[str, "Metric"] = {}
#: Unit of the error rate by language; words where none is named.
CHARACTER_LANGUAGES = ("zh", "th", "lo", "km", "my")


@dataclass(frozen=True)
class Metric:
    name: str
    of: Callable[[DataFrame, list[str], str, str], DataFrame]
    higher_is_better: bool


def register_metric(name: str, higher_is_better: bool):
    def add(f):
        REGISTRY[name] = Metric(name, f, higher_is_better)
        return f

    return add


def characters(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""), ""), lambda x: x != "")


def mixed(c: Column) -> Column:
    """Chinese by character, the rest by word."""
    return words(F.regexp_replace(F.coalesce(c, F.lit("")), "([一-鿿])", " $1 "))


def error_counts(df: DataFrame, ref: str, hyp: str, unit: Callable[[Column], Column] = words) -> DataFrame:
    """``edits`` and ``n_ref`` of every row; rows with an empty reference are
    left out, an empty hypothesis deletes everything."""
    d = df.withColumn("__r", unit(F.col(ref))).withColumn("__h", unit(F.col(hyp))).filter(F.size("__r") > 0)
    return d.withColumn("edits", edit_distance(F.col("__r"), F.col("__h")).cast("long")).withColumn("n_ref", F.size("__r").cast("long")).drop("__r", "__h")


def error_rate(df: DataFrame, group: list[str], ref: str, hyp: str, unit: Callable[[Column], Column] = words) -> DataFrame:
    """A1-A3: summed edits over summed reference length, ``inf`` without one."""
    c = error_counts(df, ref, hyp, unit).groupBy(*group).agg(F.sum("edits").alias("edits"), F.sum("n_ref").alias("n_ref"))
    return c.withColumn("value", F.when(F.col("n_ref") > 0, F.col("edits") / F.col("n_ref")).otherwise(F.lit(float("inf"))))


@register_metric("wer", False)
def wer(df, group, ref, hyp):
    return error_rate(df, group, ref, hyp)


@register_metric("cer", False)
def cer(df, group, ref, hyp):
    return error_rate(df, group, ref, hyp, characters)


@register_metric("mer", False)
def mer(df, group, ref, hyp):
    return error_rate(df, group, ref, hyp, mixed)


def numbered(grams: Column) -> Column:
    """The set of a multiset: every element with its occurrence number, so that
    intersection and union count repeated elements."""
    return let(F.array_sort(grams), lambda g: F.transform(g, lambda x, k: F.struct(x.alias("g"), (k - F.array_position(g, x)).alias("k"))))


def bleu_counts(df: DataFrame, group: list[str], refs: Column, hyp: Column, order: int = 4) -> DataFrame:
    """Clipped hits and totals of each order, and lengths, per group.

    ``refs`` is an array of token arrays. Hypothesis and references stand in
    one row, so n-grams are clipped inside it (the largest count over the
    references is the union of their numbered sets) and only sums are shuffled.
    The reference length is the one closest to the hypothesis's, the shorter of
    two. A row without hypothesis tokens adds its reference length only; a row
    without references is left out.
    """
    base = df.select(*group, F.filter(refs, lambda r: r.isNotNull()).alias("__r"), F.coalesce(hyp, F.array().cast("array<string>")).alias("__h")).filter(F.size("__r") > 0)

    def hits(n: int) -> Column:
        known = F.flatten(F.transform("__r", lambda r: numbered(ngrams(r, n))))
        return F.size(F.array_intersect(numbered(ngrams(F.col("__h"), n)), known)).cast("long")

    closest = F.array_min(F.transform("__r", lambda r: F.struct(F.abs(F.size(r) - F.size("__h")).alias("d"), F.size(r).alias("n"))))["n"]
    orders = range(1, order + 1)
    row = base.select(*group, closest.alias("__rl"), F.size("__h").alias("__hl"), *[hits(n).alias(f"__hit{n}") for n in orders])
    total = lambda n: F.greatest(F.col("__hl") - (n - 1), F.lit(0))
    sums = row.groupBy(*group).agg(F.sum("__rl").cast("long").alias("ref_len"), F.sum("__hl").cast("long").alias("hyp_len"), *[F.sum(f"__hit{n}").alias(f"__hit{n}") for n in orders], *[F.sum(total(n)).cast("long").alias(f"__all{n}") for n in orders])
    per = F.explode(F.array(*[F.struct(F.lit(n).alias("o"), F.col(f"__hit{n}").alias("hits"), F.col(f"__all{n}").alias("total")) for n in orders]))
    return sums.select(*group, "ref_len", "hyp_len", per.alias("x")).select(*group, "x.o", "x.hits", "x.total", "ref_len", "hyp_len")


def bleu(df: DataFrame, group: list[str], refs: Column, hyp: Column, order: int = 4) -> DataFrame:
    """A4: corpus BLEU, 0 to 100, exponential smoothing, any number of references."""
    c = bleu_counts(df, group, refs, hyp, order)
    w = W.partitionBy(*group).orderBy("o")
    zeros = F.sum(F.when(F.col("hits") == 0, 1).otherwise(0)).over(w)
    p = F.when(F.col("hits") > 0, F.col("hits") / F.col("total")).otherwise(1 / (F.pow(F.lit(2.0), zeros) * F.col("total")))
    c = c.withColumn("logp", F.when(F.col("total") > 0, F.ln(p)))
    out = c.groupBy(*group).agg(F.avg("logp").alias("m"), F.count("logp").alias("orders"), F.max("ref_len").alias("ref_len"), F.max("hyp_len").alias("hyp_len"))
    penalty = F.when(F.col("hyp_len") < F.col("ref_len"), F.exp(1 - F.col("ref_len") / F.col("hyp_len"))).otherwise(1.0)
    return out.withColumn("value", F.when(F.col("orders") == order, 100 * penalty * F.exp("m")).otherwise(0.0)).drop("m", "orders")


def chrf(df: DataFrame, group: list[str], ref: str, hyp: str, char_order: int = 6, word_order: int = 2, beta: float = 2.0) -> DataFrame:
    """chrF++ of each group, 0 to 100 (chrF with ``word_order`` 0).

    Precision and recall are averaged over the orders of character and word
    n-grams that both sides have; null texts count as empty.
    """

    def orders(unit, n: int, kind: str) -> DataFrame:
        d = df.select(*group, unit(F.col(ref)).alias("r"), unit(F.col(hyp)).alias("h"))
        keys = [*group, "o"]
        there = bleu_counts(d, group, F.array("r"), F.col("h"), n).select(*keys, "hits", "total")
        back = bleu_counts(d, group, F.array("h"), F.col("r"), n).select(*keys, F.col("total").alias("ref_total"))
        return there.join(back, keys).withColumn("kind", F.lit(kind))

    c = orders(characters, char_order, "chars")
    if word_order:
        c = c.unionByName(orders(words, word_order, "words"))
    s = c.filter("total > 0 and ref_total > 0").groupBy(*group).agg(F.avg(F.col("hits") / F.col("total")).alias("p"), F.avg(F.col("hits") / F.col("ref_total")).alias("r"))
    b = beta * beta
    return s.withColumn("value", F.when(F.col("p") + F.col("r") > 0, 100 * (1 + b) * F.col("p") * F.col("r") / (b * F.col("p") + F.col("r"))).otherwise(0.0))


#: Token rules of BLEU by target language, 13a where none is named.
BLEU_TOKENS: dict[str, Callable[[Column], Column]] = {"zh": lambda c: tokens_13a(space_out(c))}


def bleu_tokens(c: Column, language: str | None = None) -> Column:
    """Tokens of a text for BLEU; null and empty texts have none."""
    text = F.coalesce(c, F.lit(""))
    return F.filter(BLEU_TOKENS.get(language or "", tokens_13a)(text), lambda x: x != "")


@register_metric("bleu", True)
def _bleu(df, group, ref, hyp):
    return bleu(df, group, F.array(bleu_tokens(F.col(ref))), bleu_tokens(F.col(hyp)))


def token_f1(ref: Column, hyp: Column) -> Column:
    """F1 of the word multisets."""

    def score(p):
        r, h = p["r"], p["h"]
        common = F.aggregate(F.array_distinct(h), F.lit(0), lambda a, w: a + F.least(F.size(F.filter(h, lambda x: x == w)), F.size(F.filter(r, lambda x: x == w))))
        return F.when((F.size(r) == 0) | (F.size(h) == 0), (F.size(r) == F.size(h)).cast("double")).otherwise(2.0 * common / (F.size(r) + F.size(h)))

    return let(F.struct(words(F.lower(ref)).alias("r"), words(F.lower(hyp)).alias("h")), score)


def class_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall and F1 of every class, from confusion counts."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    t = cells.groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("n_true"), F.sum(F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0)).alias("hits"))
    g = cells.groupBy(F.col("g").alias("label")).agg(F.sum("n").alias("n_guess"))
    j = t.join(g, "label", "full").na.fill(0)
    return j.withColumn("f1", F.when(F.col("n_true") + F.col("n_guess") > 0, 2.0 * F.col("hits") / (F.col("n_true") + F.col("n_guess"))).otherwise(0.0))


def judge_score(df: DataFrame, group: list[str], score: str, scale: Column) -> DataFrame:
    """Mean score, unparsable ones 0, on 0 to 100."""
    return df.groupBy(*group).agg(F.avg(F.coalesce(F.col(score).cast("double"), F.lit(0.0)) * scale).alias("value"), F.count(F.lit(1)).alias("n"))


def average_precision(df: DataFrame, label: str, score: str, positive: str) -> DataFrame:
    """Average precision of every label and, by their mean, mAP.

    Rows are ranked by falling score (0 to 1; of equal scores positive ones
    last, so ties flatter nobody) without sorting a label in one task; each
    positive adds its rank among the positives over its rank. Labels without
    positives have none.
    """
    d = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).select(F.col(label).alias("label"), F.col(score).cast("double").alias("s"), F.coalesce(F.col(positive).cast("int"), F.lit(0)).alias("y"))
    d = d.withColumn("h", value_hash(F.col("s"), descending=True)).withColumn("down", -F.col("s"))
    placed = positions(d, "h", ["down", "y"], ["label"], "rank", bits=30).filter("y = 1")
    own = positions(placed, "h", ["down", "rank"], ["label"], "k", bits=30)
    return own.groupBy("label").agg(F.avg((F.col("k") + 1) / (F.col("rank") + 1)).alias("ap"), F.count(F.lit(1)).alias("n_positive"))


def switch_points(words_: Column) -> Column:
    """Neighbouring tokens of which one has Chinese letters and one has not."""
    han = lambda w: w.rlike("[一-鿿]")
    pairs = F.zip_with(F.slice(words_, 1, F.greatest(F.size(words_) - 1, F.lit(0))), F.slice(words_, 2, F.greatest(F.size(words_) - 1, F.lit(0))), lambda a, b: F.when(han(a) != han(b), F.concat_ws(" ", a, b)))
    return F.filter(pairs, lambda x: x.isNotNull())


def switch_error(df: DataFrame, group: list[str], ref: str, hyp: str) -> DataFrame:
    """Share of the references' switch points (both tokens, as often as
    they come) that the hypothesis doesn't have; null without switch points."""
    d = df.select(*group, switch_points(mixed(F.col(ref))).alias("r"), switch_points(mixed(F.col(hyp))).alias("h"))
    d = d.select(*group, F.size("r").alias("n"), F.size(F.array_intersect(numbered(F.col("r")), numbered(F.col("h")))).alias("kept"))
    out = d.groupBy(*group).agg(F.sum("n").cast("long").alias("n_switch"), F.sum(F.col("n") - F.col("kept")).cast("long").alias("n_wrong"))
    return out.withColumn("value", F.when(F.col("n_switch") > 0, F.col("n_wrong") / F.col("n_switch")))
