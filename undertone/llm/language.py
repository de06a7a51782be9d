"""Problem 3: missing or wrong language labels.

Hyperdimensional profiles: every letter has a random bipolar vector; a letter
n-gram is the product (binding) of its letters' vectors, each rolled by its
place; a text is the sum (bundle) of its n-grams, and a language's prototype
the bundle of labelled texts. A word's products with the prototypes are kept,
so a passage's cosines are sums over its words.

Prototypes are fitted on a bounded sample of labelled rows (PER_LANGUAGE for
each language, spread over the whole table by hash) in two passes: the second
leaves out rows whose text disagrees with their label. Everything else runs
over all rows, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from undertone.llm.arrow import duckdb_project, schema_with
from undertone.llm.lookalike import canonical_sql
from undertone.sources.tables import table

LANGUAGES = ("en", "zh", "ms", "id", "vi", "th", "ta", "tl")
PER_LANGUAGE = 500
DIMENSIONS = 8192
SIZES = (3, 4)
#: Evidence, in mean words, that a change of language costs.
SWITCH = 2.5
LEAST_WORDS = 4.0
#: How many characters of unspaced writing count as a word.
HAN_WORD, THAI_WORD = 2.0, 4.0
CACHE = 300_000

# Ways of writing a language, and marks for an unknown one.
NAMES = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "cmn", "chinese", "mandarin"),
    "ms": ("ms", "msa", "may", "zsm", "malay"),
    "id": ("id", "ind", "indonesian"),
    "vi": ("vi", "vie", "vietnamese"),
    "th": ("th", "tha", "thai"),
    "ta": ("ta", "tam", "tamil"),
    "tl": ("tl", "tgl", "fil", "tagalog", "filipino"),
}
UNKNOWN = ("", "unk", "unknown", "und", "undefined", "undetermined", "n/a", "na", "none", "null", "nan", "-", "--", "?", "xx", "mis", "zxx")
FILLERS = frozenset("uh um umm erm er hmm hm mm mhm ah spn ppo ppb ppl ppc unk".split())


def label(c: Column) -> Column:
    """The language a label names: a code of LANGUAGES, the label itself in
    lower case if it names something else, null if it names nothing."""
    low = F.lower(F.trim(F.regexp_replace(c, r"[\p{Z}\p{Cf}\s]+", " ")))
    base = F.split(low, "[-_ (]")[0]
    known = F.create_map(*[F.lit(x) for code, names in NAMES.items() for n in names for x in (n, code)])
    return F.when(c.isNull() | low.isin(*UNKNOWN), F.lit(None)).otherwise(F.coalesce(F.try_element_at(known, low), F.try_element_at(known, base), low))


def spoken_sql(column: str, chars: set[str]) -> str:
    """Canonical lower-case words; labels, stamps and annotations removed."""
    e = canonical_sql(column, chars, lines=False)
    if chars & set("[<*("):
        e = rf"regexp_replace({e}, '\[[^\[\]]*\]|<[^<>]*>|\*[^*]*\*|\([A-Za-z]{{1,10}}( [A-Za-z]+)?\)', ' ', 'g')"
    e = rf"regexp_replace({e}, '(?i)(speaker|spk|说话人|\bs)[ _-]?[0-9]+|\b(host|guest|caller|agent|interviewer|student) ?[:>]|\b[ABC] ?[:>]', ' ', 'g')"
    return rf"trim(regexp_replace(lower({e}), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))"


def letter(ch: str, size: int) -> np.ndarray:
    return (np.random.Generator(np.random.PCG64(ord(ch) * 2654435761 % 2**32)).integers(0, 2, size, dtype=np.int8) * 2 - 1).astype(np.int8)


def grams(word: str) -> list[str]:
    """Letter n-grams of a word with its ends marked; of unspaced writing the
    pairs (Chinese) or triples (Thai) without ends."""
    if "฀" <= word[0] <= "๿":
        return [word[i : i + 3] for i in range(max(1, len(word) - 2))]
    if "⺀" <= word[0] <= "鿿":
        return [word[i : i + 2] for i in range(max(1, len(word) - 1))]
    w = f"_{word}_"
    return [w[i : i + n] for n in SIZES for i in range(len(w) - n + 1)]


_DIGIT = re.compile(r"\d")
_UNSPACED = re.compile("[⺀-鿿฀-๿]")
_RUNS = re.compile("[⺀-鿿]+|[฀-๿]+|[^⺀-鿿฀-๿]+")


def words_of(text: str) -> list[str]:
    """Words of a ``spoken_sql`` text; fillers and words with digits left out;
    a run of Chinese or Thai stands for itself, apart from what it touches."""
    out = text.split(" ") if text else []
    if not FILLERS.isdisjoint(out):
        out = [w for w in out if w not in FILLERS]
    if _DIGIT.search(text):
        out = [w for w in out if not _DIGIT.search(w)]
    if not text.isascii() and _UNSPACED.search(text):
        out = [r for w in out for r in ((w,) if w.isascii() else _RUNS.findall(w))]
    return out


def weight(word: str) -> float:
    if "⺀" <= word[0] <= "鿿":
        return len(word) / HAN_WORD
    if "฀" <= word[0] <= "๿":
        return len(word) / THAI_WORD
    return 1.0


class Profiles:
    """Prototypes and the products of words with them."""

    def __init__(self, prototypes: np.ndarray, scale: float = 1.0):
        self.prototypes, self.scale, self.size = prototypes, scale, prototypes.shape[1]
        self.letters: dict[str, np.ndarray] = {}
        self.grams: dict[str, int] = {}
        self.products = np.zeros((1024, len(prototypes)), np.float32)
        self.ids: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.weights: list[float] = []

    def vector(self, gram: str) -> np.ndarray:
        out = None
        for k, ch in enumerate(gram):
            v = self.letters.get(ch)
            if v is None:
                v = self.letters[ch] = letter(ch, self.size)
            v = np.roll(v, k)
            out = v if out is None else out * v
        return out

    def product(self, gram: str) -> int:
        """Row of ``products`` with the products of a new n-gram."""
        if len(self.grams) >= CACHE:
            self.grams.clear()
        i = self.grams[gram] = len(self.grams)
        if i >= len(self.products):
            self.products = np.concatenate([self.products, np.zeros_like(self.products)])
        self.products[i] = self.prototypes @ self.vector(gram).astype(np.float32)
        return i

    def word(self, word: str) -> np.ndarray:
        """Sum of the word's n-gram products, in mean words of evidence."""
        gs = grams(word)
        if len(self.grams) + len(gs) > CACHE:
            self.grams.clear()
        known = self.grams
        at = [i if (i := known.get(g)) is not None else self.product(g) for g in gs]
        total = self.products[at].sum(axis=0)
        if not _UNSPACED.match(word):
            total = total / np.sqrt(len(gs))
        return total / self.scale

    def matrix(self, words: list[str]) -> np.ndarray:
        """One row of evidence a word."""
        if len(self.rows) > CACHE:
            self.ids, self.rows, self.weights = {}, [], []
        ids = self.ids
        index = list(map(ids.get, words))
        if None in index:
            for at, w in enumerate(words):
                if index[at] is None:
                    i = ids.get(w)
                    if i is None:
                        i = ids[w] = len(self.rows)
                        self.rows.append(self.word(w))
                        self.weights.append(weight(w))
                    index[at] = i
        if getattr(self, "_table", None) is None or len(self._table) != len(self.rows):
            self._table, self._w = np.array(self.rows, np.float32), np.array(self.weights, np.float32)
        return self._table[index], self._w[index]


def fit(rows: list[tuple[str, str]], size: int = DIMENSIONS) -> tuple[np.ndarray, float]:
    """(prototypes, scale) from (language, spoken text) rows."""

    def bundle(kept: list[tuple[str, list[str]]]) -> Profiles:
        counts = [Counter() for _ in LANGUAGES]
        for lang, ws in kept:
            c = counts[LANGUAGES.index(lang)]
            for w in ws:
                c.update(grams(w))
        sums = [max(1, sum(c.values())) for c in counts]
        blank = Profiles(np.zeros((len(LANGUAGES), size), np.float32))
        proto = np.zeros((len(LANGUAGES), size), np.float32)
        for g in set().union(*counts):
            v = blank.vector(g)
            for k, c in enumerate(counts):
                if n := c.get(g):
                    proto[k] += np.float32(np.sqrt(n / sums[k])) * v
        proto -= proto.mean(axis=0)
        norm = np.linalg.norm(proto, axis=1, keepdims=True)
        return Profiles(proto / np.where(norm > 0, norm, 1))

    split = [(lang, words_of(t)) for lang, t in rows]
    split = [(lang, ws) for lang, ws in split if ws]
    if not split:
        return np.zeros((len(LANGUAGES), size), np.float32), 1.0
    p = bundle(split)
    good = [(lang, ws) for lang, ws in split if LANGUAGES[int(np.argmax(p.matrix(ws)[0].sum(axis=0)))] == lang]
    p = bundle(good or split)
    gaps = []
    for lang, ws in good or split:
        k = LANGUAGES.index(lang)
        if lang in ("zh", "th"):
            continue
        m, _ = p.matrix(ws)
        gaps.append(float((m[:, k] - np.delete(m, k, axis=1).max(axis=1)).mean()))
    return p.prototypes, float(np.median(gaps)) if gaps and np.median(gaps) > 0 else 1.0


def segments(evidence: np.ndarray, languages: list[int], switch: float = SWITCH) -> list[tuple[int, int, int]]:
    """(language, from, to) passages: the best path through ``languages`` with
    a cost a change."""
    rows = evidence[:, languages].tolist()
    states = range(len(languages))
    best, back = rows[0], []
    for row in rows[1:]:
        top = max(states, key=best.__getitem__)
        jump = best[top] - switch
        back.append([k if best[k] >= jump else top for k in states])
        best = [(b if b >= jump else jump) + e for b, e in zip(best, row)]
    path = [max(states, key=best.__getitem__)]
    for step in reversed(back):
        path.append(step[path[-1]])
    path.reverse()
    runs: list[list[int]] = []
    for i, k in enumerate(path):
        if runs and runs[-1][0] == languages[k]:
            runs[-1][2] = i + 1
        else:
            runs.append([languages[k], i, i + 1])
    return [tuple(r) for r in runs]


class Labeller:
    """Passages of texts, a batch at a time."""

    def __init__(self, prototypes: np.ndarray, scale: float):
        self.profiles = Profiles(prototypes, scale)

    def batch(self, texts: list[str | None]) -> list[list[tuple[str, float, float]]]:
        """Per text its passages as (language, confidence, words).

        Texts whose every window of four words agrees with the whole are one
        passage and never cut; only the others go through ``segments``, with
        the languages that lead the whole or some window.
        """
        split = [words_of(t) if t else [] for t in texts]
        flat = [w for ws in split for w in ws]
        if not flat:
            return [[] for _ in texts]
        evidence, weights = self.profiles.matrix(flat)
        bounds = np.concatenate([[0], np.cumsum([len(ws) for ws in split])])
        sums = np.concatenate([np.zeros((1, evidence.shape[1]), np.float64), np.cumsum(evidence, axis=0, dtype=np.float64)])
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        whole = np.where(np.diff(bounds)[:, None] > 0, sums[bounds[1:]] - sums[bounds[:-1]], 0)
        main = whole.argmax(axis=1)
        # evidence of up to four words from each word on, inside its text
        stop = np.minimum(np.arange(len(flat)) + 4, bounds[1:][owner])
        window = sums[stop] - sums[:-1]
        odd = window.max(axis=1) - window[np.arange(len(flat)), main[owner]] > 0.5 * SWITCH
        lead = window.argmax(axis=1)
        mixed: dict[int, set[int]] = {}
        for o, k in zip(owner[odd].tolist(), lead[odd].tolist()):
            mixed.setdefault(o, {int(main[o])}).add(k)
        out = []
        for i in range(len(texts)):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if a == b:
                out.append([])
                continue
            runs = [(int(main[i]), 0, b - a)] if i not in mixed else segments(evidence[a:b], sorted(mixed[i]))
            found = []
            for lang, x, y in runs:
                e = sums[a + y] - sums[a + x]
                size = float(weights[a + x : a + y].sum())
                second = np.partition(e, -2)[-2]
                found.append((LANGUAGES[lang], float(1 / (1 + np.exp(-(e[lang] - second) / max(1.0, size) * 4))), size))
            out.append(found)
        return out


def sample_for_fit(samples: DataFrame, text: str, lang: Column, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most about ``per_language`` labelled rows of each language.

    Texts are taken by a hash threshold, so they come from all over the table,
    a repeated text counts once, and of more than twice the bound those with the
    lowest hashes are kept: the sample depends on the rows alone.
    """
    named = samples.select(lang.alias("lang"), F.col(text).alias("t")).filter(F.col("lang").isin(*LANGUAGES) & (F.length("t") > 20))
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[x for code, n in counts.items() for x in (F.lit(code), F.lit(int(2**31 * min(1.0, per_language / n))))])
    place = F.pmod(F.xxhash64("t"), F.lit(2**31))
    picked = named.filter(place < share[F.col("lang")]).distinct().withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy(place, "t"))).filter(F.col("place") <= 2 * per_language).drop("place")
    spoken = duckdb_project(picked, {"s": lambda chars: spoken_sql('"t"', chars)}, ["lang"], "t")
    return [(r["lang"], r["s"]) for r in spoken.collect() if r["s"]]


def passages(samples: DataFrame, key: str, text: str, fitted: tuple[np.ndarray, float]) -> DataFrame:
    """(key, passage_no, language, confidence, words) of every passage of at
    least LEAST_WORDS words. Null, empty and word-free texts have none."""
    shared = samples.sparkSession.sparkContext.broadcast(fitted)
    slim = samples.select(F.col(key).alias("key"), F.col(text).alias("t")).filter("key is not null and t is not null and t <> ''")
    spoken = duckdb_project(slim, {"s": lambda chars: spoken_sql('"t"', chars)}, ["key"], "t")
    schema = schema_with(slim, ["key"], passage_no=T.IntegerType(), language=T.StringType(), confidence=T.DoubleType(), words=T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(*shared.value)
        for batch in batches:
            keys, no, lang, conf, size = [], [], [], [], []
            for k, found in zip(batch.column(0).to_pylist(), labeller.batch(batch.column(1).to_pylist())):
                number = 0
                for code, c, n in found:
                    if n >= LEAST_WORDS:
                        number += 1
                        keys.append(k)
                        no.append(number)
                        lang.append(code)
                        conf.append(c)
                        size.append(n)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(no, pa.int32()), pa.array(lang), pa.array(conf), pa.array(size)], names=["key", "passage_no", "language", "confidence", "words"])

    return spoken.mapInArrow(run, schema).withColumnRenamed("key", key)


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "mds_samples")
    fitted = fit(sample_for_fit(samples, "response_text", label(F.col("language"))))
    return passages(samples, "sample_id", "response_text", fitted)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "mds_samples")
    specs = table(spark, sf_dir, "dataset_specs")
    fitted = fit(sample_for_fit(samples, "response_text", label(F.col("language"))))
    # the label travels with the key, so no join of the two sides is needed
    entry = specs.filter("split = 'train'").withColumn("name", F.trim("name")).filter("name is not null")
    entry = entry.withColumn("rn", F.row_number().over(W.partitionBy("name").orderBy("spec_id"))).filter("rn = 1")
    entry = entry.select("name", label(F.col("language")).alias("own"))
    named = samples.select("sample_id", "language", "response_text", F.trim("dataset").alias("name")).join(entry, "name", "left").filter("sample_id is not null")
    keyed = named.select(F.struct("sample_id", F.coalesce(label(F.col("language")), "own", F.lit("")).alias("label")).alias("k"), "response_text")
    found = passages(keyed, "k", "response_text", fitted)
    return found.filter("language <> k.label").select("k.sample_id", "language").distinct()


def p3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every passage of every sample."""
    p = _passages(spark, sf_dir)
    return p.select("sample_id", "passage_no", "language", F.round("confidence", 4).alias("confidence"), F.round("words", 1).alias("words")).distinct()
