import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from undertone.functions import arrays as a
from undertone.operators import hooks, metrics as m


def test_train_only(spark):
    df = spark.createDataFrame([(b"ab", "x", "ASR", 1), (None, "y", "ASR", 2), (b"", None, None, 3)], "audio binary, text string, task string, `schema` int")
    hook = lambda b, t, k: (b * 2, t.upper())
    train = hooks.StreamConfig(augment=True, dropout=0.3)
    got = [tuple(r) for r in hooks.with_augment(df, "audio", "text", "task", hook, train).orderBy("schema").collect()]
    assert got == [(b"abab", "X", "ASR", 1), (None, "y", "ASR", 2), (b"", None, None, 3)]
    val = train.for_validation()
    assert (val.shuffle, val.sampling, val.augment, val.dropout, val.seed) == (False, "fixed", False, 0.0, train.seed)
    assert hooks.with_augment(df, "audio", "text", "task", hook, val) is df
    assert hooks.with_transform(df, lambda x: x.filter("`schema` = 1")).count() == 1 and hooks.with_transform(df, None) is df


def test_processors(spark):
    df = spark.range(3)
    hooks.register_processor("odd")(lambda x: x.filter("id % 2 = 1"))
    assert hooks.process(df, "odd").count() == 1 and hooks.process(df, None).count() == 3
    with pytest.raises(ValueError):
        hooks.process(df, "nothing of the kind")


def test_accessors(spark):
    flat = spark.createDataFrame([(b"a", "t")], "audio binary, answer string")
    nested = spark.createDataFrame([(((b"c", "p"),), (b"a",), ("t",))], "context struct<audio:struct<bytes:binary,path:string>>, audio struct<bytes:binary>, answer struct<text:string>")
    bare = spark.createDataFrame([((None,), 1)], "context struct<note:string>, audio int")
    for df, audio, text in ((flat, b"a", "t"), (nested, b"c", "t"), (bare, None, None)):
        assert tuple(df.select(hooks.audio_of(df.schema), hooks.text_of(df.schema, "answer")).first()) == (audio, text)


def test_mix_keys(spark):
    rows = spark.createDataFrame([(1, "a", 5.0), (2, "a", 50.0), (3, "b", 50.0), (4, "c", 1.0), (5, "a", None)], "id long, name string, duration double")
    specs = spark.createDataFrame([("a", 10.0, "none"), ("b", None, None)], "name string, max_seconds double, prompt_type string")
    assert sorted((r["id"], r["prompt_type"]) for r in hooks.mix_keys(rows, specs).collect()) == [(1, "none"), (3, "default"), (4, "default"), (5, "none")]


def test_barrier(spark):
    parts = spark.createDataFrame([(0,), (2,), (2,)], "rank int")
    assert [r[0] for r in hooks.missing_ranks(parts, "rank", 4).orderBy("rank").collect()] == [1, 3]


def tone(f, n=16000):
    return np.sin(2 * np.pi * f * np.arange(n) / a.RATE)


def main_frequency(v):
    return np.argmax(np.abs(np.fft.rfft(v * np.hanning(len(v))))) * a.RATE / len(v)


def test_speed_keeps_pitch_and_pitch_keeps_length(spark):
    df = spark.createDataFrame([(tone(440).tolist(),), (None,), ([],)], "x array<double>")
    got = df.select(a.stretched(F.col("x"), F.lit(1.25)).alias("s"), a.pitched(F.col("x"), F.lit(12.0)).alias("p")).collect()
    assert len(got[0]["s"]) == 12800 and abs(main_frequency(np.array(got[0]["s"])) - 440) < 8
    assert len(got[0]["p"]) == 16000 and abs(main_frequency(np.array(got[0]["p"])) - 880) < 12
    assert got[1]["s"] is None and got[2]["p"] == []


def test_header_duration(spark):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(b"\0" * 4 * 4000)
    df = spark.createDataFrame([(out.getvalue(),), (b"x" * 64000,), (None,)], "b binary")
    assert [r[0] for r in df.select(a.seconds_of(F.col("b"))).collect()] == [0.5, 2.0, 30.0]


def test_background_is_bounded(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(40)] + [(99, None)], "id long, clip array<double>")
    got = {r["id"]: r["background"] for r in a.background_clips(df, "id", "clip", 1, shares=1).collect()}
    assert len(got) == 41 and max(map(len, got.values())) == 8 and sorted(map(len, got.values()))[:2] == [0, 1]
    assert all([float(i)] not in b for i, b in got.items())


def test_average_precision(spark):
    df = spark.createDataFrame([("a", 0.9, True), ("a", 0.8, False), ("a", 0.7, True), ("b", 0.5, True), ("b", 0.5, False), ("c", 0.1, False), (None, 0.1, True), ("a", None, True)], "l string, s double, y boolean")
    assert {r["label"]: round(r["ap"], 6) for r in m.average_precision(df, "l", "s", "y").collect()} == {"a": round((1 + 2 / 3) / 2, 6), "b": 0.5}


def test_switch_error(spark):
    df = spark.createDataFrame([("i 你 like 好", "i 你 hate 好"), ("all english", "x"), (None, None)], "r string, h string")
    got = m.switch_error(df, [], "r", "h").first()
    assert (got["n_switch"], got["n_wrong"]) == (3, 2)
