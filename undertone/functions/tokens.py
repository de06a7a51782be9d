"""Edit distance and n-grams of token arrays, without Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside ``body``'s own
    lambdas (an expression there would be computed for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def coded(words: Column, vocabulary: Column) -> Column:
    """A string with one private character for each word."""
    return F.array_join(F.transform(words, lambda w: F.decode(F.unhex(F.hex(F.lit(19968) + F.array_position(vocabulary, w))), "UTF-16BE")), "")


def edit_distance(ref: Column, hyp: Column) -> Column:
    """Substitutions, deletions and insertions between two word arrays (up to
    about 20,000 different words a pair). Null counts as empty."""
    none = F.array().cast("array<string>")
    pair = F.struct(F.coalesce(ref, none).alias("a"), F.coalesce(hyp, none).alias("b"))
    return let(pair, lambda p: let(F.array_distinct(F.concat(p["a"], p["b"])), lambda v: F.levenshtein(coded(p["a"], v), coded(p["b"], v))))


def words(c: Column) -> Column:
    """Words between blanks; null and blank texts have none."""
    return F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda w: w != "")


def ngrams(ws: Column, n: int) -> Column:
    """All runs of n words, joined by blanks."""

    def runs(w):
        at = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.array_join(F.slice(w, i, n), " "))

    return let(ws, runs)
