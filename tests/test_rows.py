import numpy as np
import pytest
from pyspark.sql import functions as F

from undertone.functions import arrays as a
from undertone.operators import linalg, rows, validation


def test_rows(spark):
    df = spark.createDataFrame([(1, "ASR", "ms", "given", "x", b"RIFF"), (2, "SQA", None, "ask", "y", b"RIFF"), (3, "ASR", "xx", None, "z", b""), (4, "AC", None, None, None, None)], "i long, task string, l string, g string, ans string, au binary")
    cfg = rows.RowConfig(english_weight=0.0, system="be brief")
    p = df.withColumn("p", rows.random_prompt(F.col("i"), F.col("l"), F.col("task"), F.col("g"), cfg))
    got = {r["i"]: r["p"] for r in p.collect()}
    assert got[1] in rows.PROMPTS["ms"]["asr"] and got[2] == "ask" and got[3] in rows.PROMPTS["en"]["asr"] and got[4] in rows.PROMPTS["en"]["ac"]
    built = rows.build_rows(p, "p", "ans", "au", ["i"], cfg).collect()
    assert sorted(r["_meta"]["i"] for r in built) == [1, 2] and [m["role"] for m in built[0]["messages"]] == ["system", "user", "assistant"]
    with pytest.raises(ValueError):
        rows.RowConfig(prompt_type="other")


def test_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, -4.0, 2.0]), (2, [0.0, 0.0]), (3, None)], "i long, x array<double>")
    x = F.col("x")
    got = {r["i"]: r for r in df.select("i", a.normalized(x).alias("n"), a.standardized(x).alias("s"), a.padded(x, 4).alias("p"), a.with_noise(x, F.reverse(x), F.lit(6.0)).alias("w")).collect()}
    v = np.array([1.0, -4.0, 2.0])
    assert np.allclose(got[1]["n"], v / 4) and np.allclose(got[1]["s"], (v - v.mean()) / v.std()) and got[1]["p"] == [1.0, -4.0, 2.0, 0.0]
    noise = (v[::-1] - v.mean()) / v.std() * np.sqrt((v * v).mean() / 10**0.6)
    assert np.allclose(got[1]["w"], v + noise)
    assert got[2]["n"] == [0.0, 0.0] and got[2]["s"] == [0.0, 0.0] and got[3]["n"] is None


def test_wav(spark):
    tone = [float(np.sin(k / 5)) for k in range(400)]
    df = spark.createDataFrame([(tone,), ([2.0, -2.0],)], "x array<double>").withColumn("w", a.encode_wav(F.col("x"))).withColumn("y", a.decode_wav(F.col("w")))
    got = df.collect()
    assert np.allclose(got[0]["y"], tone, atol=1e-3) and np.allclose(got[1]["y"], [1, -1], atol=1e-3)
    bad = spark.createDataFrame([(bytearray(b"no"),)], "w binary").select(a.decode_wav(F.col("w")).alias("y")).first()
    assert bad["y"] is None


def test_adapters(spark):
    rng = np.random.default_rng(0)
    A, B = rng.normal(size=(3, 2, 5)), rng.normal(size=(3, 4, 2))
    data = [(p, "m", s, i, [float(v) for v in row]) for p in range(3) for s, M in (("A", A[p]), ("B", B[p])) for i, row in enumerate(M)]
    df = spark.createDataFrame(data, "part long, name string, side string, row long, vec array<double>")
    c = linalg.concat_adapters(df, "part", "name", "side", "row", "vec", 3)
    got = np.zeros((4, 5))
    for r in linalg.product(c.filter("side = 'B'"), c.filter("side = 'A'"), "name").collect():
        got[r["i"], r["j"]] = r["v"]
    assert np.allclose(got, np.mean([B[p] @ A[p] for p in range(3)], axis=0))


def test_mix_rules(spark):
    df = spark.createDataFrame([(1, "train", "a", "/a", "ASR", None, None, 1.0), (2, "train", " a ", "/b", "ASR", 1, 2.0, 1.0), (3, "dev", None, "", None, None, None, None)], "spec_id int, split string, name string, path string, task string, choose long, repeat double, weight double")
    got = {tuple(r) for r in validation.mix_violations(df).collect()}
    assert got == {(2, "duplicate name"), (2, "choose and repeat"), (3, "no name"), (3, "no path"), (3, "no task"), (3, "unknown split"), (3, "unusable weight")}
