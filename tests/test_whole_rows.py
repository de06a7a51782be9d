"""Queries that once took a part of their rows or steps, on small fixtures."""

import pytest
from pyspark.sql import functions as F

from undertone.functions import text as t
from undertone.plans import catalogue, eval_queries, row_queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_cer_of_every_script(spark, sf, monkeypatch):
    pairs = [("zh", "你好世界", "你好"), ("zh", "今天 天气好", "今天天气不好"), ("th", "สวัสดีครับ", "สวัสดครับ"), ("th", "ไป 😀 ไหน", "ไป ไหน"), ("en", "a bc", "a bd")]
    fixture = spark.createDataFrame([("base", *p) for p in pairs], "run string, set_name string, answer string, hyp string")
    monkeypatch.setattr(eval_queries, "predictions", lambda *_: fixture)
    want = {}
    for name, r, h in pairs:
        r, h = "".join(r.split()), "".join(h.split())
        e, n = want.get(name, (0, 0))
        want[name] = (e + distance(r, h), n + len(r))
    got = {r["set_name"]: (r["edits"], r["n_ref"]) for r in catalogue.queries()["cer"](spark, sf).collect()}
    assert got == want


def test_every_line_of_a_transcript(spark, sf, monkeypatch):
    docs = [(1, "a-1 HELLO  THERE\na-2 你好 吗\r\n\n a-3 x \nalone"), (2, "b-1 one"), (3, None)]
    monkeypatch.setattr(row_queries, "table", lambda *_: spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(tuple(r) for r in catalogue.queries()["transcript_lines"](spark, sf).collect())
    assert got == [(1, 1, "a-1", "HELLO  THERE"), (1, 2, "a-2", "你好 吗"), (1, 4, "a-3", "x"), (2, 1, "b-1", "one")]


@pytest.mark.parametrize(
    "given, lang, want",
    [
        ("I dont like #kopi-o_kosong# (SPN)", "en", "<Speaker1>: I don't like kopi o kosong"),
        ("my hand phone #mrt-station#", "ms", "<Speaker1>: my handphone #mrt station#"),
        ("#teh,_tarik# dont", "ms", "<Speaker1>: #teh tarik# dont"),
        ("#1, a-b# c", "ms", "<Speaker1>: #1, a-b# c"),
    ],
)
def test_standardize_whole_chain(spark, given, lang, want):
    df = spark.createDataFrame([(given, "ASR", lang)], "x string, t string, l string")
    assert df.select(t.standardize(F.col("x"), F.col("t"), F.col("l"))).first()[0] == want
