"""Text functions over rows of every script, against Python's own rules."""

import re

import pytest
from pyspark.sql import functions as F

from undertone.functions import text as t
from undertone.plans import catalogue, text_queries

TEXTS = [
    "um 你好 uh thế ah",
    "um the đim chim im lặng dont",
    "éum naïveer uhé um…",
    "It’s five straße – twenty",
    "dont go，Cant you？ ten个 one two",
    "สวัสดี um ครับ ah",
    "ONE（two）won't İ three",
    "plain um dont one",
    "𠀀1 𠀀um 1𠀀 dont𠀀 1 1",
]
edge = r"\b{}\b".format


def squeezed(x):
    return re.sub(r"[ \t\n\v\f\r]+", " ", x).strip(" ")


def replaced(x, pairs, title=False):
    for a, b in pairs:
        x = re.sub(edge(a), b, x)
        x = re.sub(edge(a.capitalize()), b.capitalize(), x) if title else x
    return x


def digits(x):
    return replaced(replaced(x, t.DIGITS), t.CONTRACTIONS)


BRUTE = {
    "normalize_smoke": lambda x: squeezed(re.sub("[^A-Z0-9' ]", " ", x.upper().replace("’", "'"))),
    "normalize_nonspeech": lambda x: squeezed(re.sub(edge("(uh|umm|um|er|ah)"), "", x)),
    "apostrophes": lambda x: replaced(x, t.APOSTROPHES, True),
    "normalize_digits": digits,
}


@pytest.mark.parametrize("name", sorted(BRUTE))
def test_every_script(spark, sf, monkeypatch, name):
    fixture = spark.createDataFrame(list(enumerate(TEXTS)), "sample_id long, x string")
    monkeypatch.setattr(text_queries, "base", lambda *_: fixture)
    got = {r["sample_id"]: r["y"] for r in catalogue.queries()[name](spark, sf).collect()}
    assert got == {k: BRUTE[name](x) for k, x in enumerate(TEXTS)}


@pytest.mark.parametrize("name", sorted(BRUTE))
def test_every_row(spark, sf, name):
    rows = text_queries.base(spark, sf).select("sample_id", "x").collect()
    got = sorted((r["sample_id"] or 0, r["y"]) for r in catalogue.queries()[name](spark, sf).collect())
    assert got == sorted((r["sample_id"] or 0, BRUTE[name](r["x"])) for r in rows)
