"""Problem 7: one form for texts that look the same.

``canonical_sql`` builds one DuckDB expression that removes invisible
characters, translates compatibility forms and look-alike letters, composes
accents with ``nfc_normalize`` and unifies spaces. It is run by the embedded
DuckDB inside Arrow partitions (`duckdb_project`).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from undertone.llm.arrow import cut, duckdb_project, key128
from undertone.sources.tables import table

# Letters of other scripts that draw like a Latin letter.
LOOKALIKES = {
    "АВЕЅІЈКМНОРСТУХҮԌԚԜаесіјорѕухһԁԛԝҽӏ": "ABESIJKMHOPCTYXYGQWaecijopsyxhdqwel",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳοϲ": "ABEZHIKMNOPTYXCjoc",
}
# Characters that draw nothing.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff\ufe0e\ufe0f"
# Decomposition tags whose characters keep the look of their parts.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<compat>", "<noBreak>", "<isolated>", "<initial>", "<medial>", "<final>")


# Blanks of other widths, and line ends.
BLANKS = "\t\x0b\x0c\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
LINE_ENDS = "\r\u2028\u2029"


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one other, and forms that become several.

    Derived from the Unicode character database: every character whose
    compatibility decomposition carries a tag in SAME_LOOK, with look-alike
    letters, blanks and line ends.
    """
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for code in [*range(0xA1, 0x3100), *range(0x3130, 0x3400), *range(0xFB00, 0xFB50), *range(0xFE10, 0xFFEF), *range(0x1D400, 0x1D800)]:
        ch = chr(code)
        tag = unicodedata.decomposition(ch).split(" ")[0]
        if tag not in SAME_LOOK or ch.isspace() or ch == "\u0e33":
            continue
        to = unicodedata.normalize("NFKC", ch)
        if " " in to or to == ch:
            continue
        if len(to) == 1:
            one[ch] = to
        elif 0xFB00 <= code <= 0xFB06 or code == 0x2026:
            many[ch] = to
    for source, target in LOOKALIKES.items():
        assert len(source) == len(target)
        one.update(zip(source, target))
    for ch in list(one):  # a look-alike reached through a compatibility form
        one[ch] = one.get(one[ch], one[ch])
    one |= dict.fromkeys(BLANKS, " ") | dict.fromkeys(LINE_ENDS, "\n")
    return one, many


def known_characters() -> set[str]:
    """All characters that ``canonical_sql`` treats, and plain ones."""
    one, many = _tables()
    return set(one) | set(many) | set(INVISIBLE) | set("\n'\u2019`\u00b4\u200d\u0e4da")


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(column: str, chars: set[str], lines: bool = True) -> str:
    """DuckDB expression for the canonical form of ``column``, whose texts hold
    no other characters than ``chars``.

    Null stays null, empty stays empty; a text of blanks and invisible
    characters becomes empty. Case, accents, punctuation and word breaks stay;
    a run of spaces of any width becomes one space, a run holding a line break
    one line break (a space with ``lines=False``).
    """
    one, many = _tables()

    def translated(e: str, here: list[str]) -> str:
        here.sort(key=lambda c: (c in INVISIBLE, c))  # characters without a partner are removed
        return f"translate({e}, {_quote(''.join(here))}, {_quote(''.join(one[c] for c in here if c in one))})" if here else e

    treated = [c for c in chars if c in one or c in INVISIBLE]
    plain = translated(column, [c for c in treated if c.isascii()])
    e = translated(plain, [c for c in treated if not c.isascii()])
    for ch in sorted(chars & many.keys()):
        e = f"replace({e}, {_quote(ch)}, {_quote(many[ch])})"
    if "\u200d" in chars:  # a joiner inside a word
        e = rf"regexp_replace({e}, '([\p{{L}}\p{{M}}])\x{{200d}}+', '\1', 'g')"
    if "\u0e4d" in chars:  # Thai sara am written as two signs
        e = f"regexp_replace({e}, '\u0e4d([\u0e48-\u0e4b]?)\u0e32', '\\1\u0e33', 'g')"
    if not all(c.isascii() for c in chars):  # texts of plain letters are spared
        e = f"CASE WHEN strlen({plain}) = length({plain}) THEN {plain} ELSE nfc_normalize({e}) END"
    if chars & set("\n" + LINE_ENDS):
        e = rf"regexp_replace({e}, ' *\n\s*', chr(10), 'g')" if lines else f"replace({e}, chr(10), ' ')"
    return f"trim(regexp_replace({e}, '  +', ' ', 'g'), ' ' || chr(10))"


def canonicalise(df: DataFrame, text: str, into: str = "canonical", keep: list[str] | None = None) -> DataFrame:
    """``df``'s ``keep`` columns with the canonical form of ``text`` as ``into``.

    Null texts give null; extra columns are dropped before Python sees them, so
    columns of any name may be present in ``df``.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != into]
    tmp = "__text" if "__text" not in keep else "__text_in"
    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(tmp))
    return duckdb_project(slim, {into: lambda chars: canonical_sql(f'"{tmp}"', chars)}, keep, tmp)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training answers and evaluation answers as (key, text), repeats included."""
    a = table(spark, sf_dir, "mds_samples").select(F.col("sample_id").alias("key"), F.col("response_text").alias("text"))
    b = table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("key"), F.col("answer").alias("text"))
    return a.unionByName(b).filter(F.col("key").isNotNull() & F.col("text").isNotNull())


def lookalike_pairs(df: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """Pairs (key_a, key_b) of records whose different texts look the same.

    Works on classes of equal strings: only looks drawn in at least two ways go
    on, different drawings of a look are paired, and the members are joined to
    those pairs. Equal strings never meet, so a group of exact copies costs
    nothing. Blank and null texts look like nothing and give no pair.
    """
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("drawn"))
    canon = canonicalise(slim, "text", "canonical", keep=["key", "drawn"])
    members = cut(canon.filter("canonical <> ''").select("key", "drawn", *key128(F.col("canonical"))).distinct())
    drawings = members.select("k1", "k2", "drawn").distinct()
    several = drawings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    drawings = drawings.join(several, ["k1", "k2"])
    a, b = drawings.withColumnRenamed("drawn", "drawn_a"), drawings.withColumnRenamed("drawn", "drawn_b")
    ways = a.join(b, ["k1", "k2"]).filter("drawn_a < drawn_b")
    left = members.withColumnsRenamed({"key": "left_key", "drawn": "drawn_a"})
    right = members.withColumnsRenamed({"key": "right_key", "drawn": "drawn_b"})
    pairs = ways.join(left, ["k1", "k2", "drawn_a"]).join(right, ["k1", "k2", "drawn_b"])
    return pairs.filter("left_key <> right_key").select(F.least("left_key", "right_key").alias("key_a"), F.greatest("left_key", "right_key").alias("key_b")).distinct()


def lookalike_classes(df: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """(key, class_id, n_links): every record whose look is drawn in several
    ways, with its class and the number of records that draw it differently.

    Keys are counted per drawing and look in two steps, so a look that holds a
    third of all records is spread, and copies are counted, not paired. A key
    with several texts of one look has a row for each.
    """
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("drawn"))
    canon = canonicalise(slim, "text", "canonical", keep=["key", "drawn"])
    members = cut(canon.filter("canonical <> ''").select("key", "drawn", *key128(F.col("canonical"))).distinct())
    drawings = members.groupBy("k1", "k2", "drawn").agg(F.count(F.lit(1)).alias("n_same"))
    looks = drawings.groupBy("k1", "k2").agg(F.sum("n_same").alias("n_all"), F.count(F.lit(1)).alias("ways")).filter("ways > 1")
    links = drawings.join(looks, ["k1", "k2"]).select("k1", "k2", "drawn", (F.col("n_all") - F.col("n_same")).alias("n_links"))
    return members.join(links, ["k1", "k2", "drawn"]).select(F.col("key").alias(key), F.concat(F.lower(F.hex("k1")), F.lower(F.hex("k2"))).alias("class_id"), "n_links")


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_classes(records(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_pairs(records(spark, sf_dir))


def p7_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's canonical text."""
    return canonicalise(records(spark, sf_dir), "text", "canonical", keep=["key"]).distinct()
