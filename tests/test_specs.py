import numpy as np
import pytest
from pyspark.sql import functions as F

from undertone.sources import specs, tensors


def test_mix_reports_every_problem():
    good = {"name": "a", "path": "a", "task": "ASR", "language": "en", "weight": 0}
    mix = specs.load_mix({"dataset_basedir": "/b", "train": [good], "validation": [good]}, exists=lambda p: True)
    assert mix["train"][0].path == "/b/a" and mix["train"][0].meta() == {"dataset": "a", "task": "ASR", "language": "en"}
    with pytest.raises(specs.SpecError) as e:
        specs.load_mix({"extra": 1, "train": [good, good, {"name": "c"}, good | {"name": "d", "choose": 1, "repeat": 2, "odd": 0}]}, exists=lambda p: "d" not in p)
    assert e.value.problems == ["unknown key extra", "train[1]: duplicate name a", "train[2]: no path", "train[2]: no task", "train[3]: unknown key odd", "train[3]: choose and repeat"]


def test_suite_tiers(spark):
    data = {
        "roots": {"sea": "/data/sea"},
        "tiers": {"quick": 200, "smoke": 8},
        "datasets": [
            {"name": "x", "path": "sea/x", "task": "ASR", "lang": "en", "metrics": ["wer"]},
            {"name": "y", "path": "ab/y", "task": "SQA", "metrics": ["judge"], "quick": 0, "note": 1},
            {"name": "z", "path": "ab/z", "task": "ST", "quick": {"n": 5, "chunk_s": 20.0}},
        ],
    }
    q = specs.load_suite(data, "quick")
    assert [(s.name, s.n, s.chunk_s) for s in q] == [("x", 200, 30.0), ("z", 5, 20.0)] and q[0].path == "/data/sea/x"
    assert specs.load_suite(data, "smoke")[1].extra == {"note": 1} and len(specs.load_suite(data, "smoke")) == 3
    for bad in (dict(tier="none"), dict(only=["w"])):
        with pytest.raises(specs.SpecError):
            specs.load_suite(data, **bad)
    with pytest.raises(specs.SpecError):
        specs.load_suite({"datasets": [{"name": "x", "path": "x", "task": "ASR", "metric": "wer"}]})
    assert specs.suite_frame(spark, q).filter("tokens_per_s = 15").count() == 2


def test_config():
    got = specs.expand_config({"lr": 0.1, "flag": True, "off": False, "none": None, "l": [1, 2], "d": {"a": 1}, "p": "${HOME_}/x", "seed": 1}, ["--seed", "2"], {"HOME_": "/h"})
    assert got == ["--lr", "0.1", "--flag", "--l", "1", "2", "--d", '{"a": 1}', "--p", "/h/x", "--seed", "2"]
    with pytest.raises(KeyError):
        specs.expand_config({"p": "${NO}"}, [], {})


def test_tensors(spark, tmp_path):
    a = np.arange(6, dtype="f4").reshape(2, 3)
    (tmp_path / "x.safetensors").write_bytes(tensors.encode({"m.A": a, "v": np.ones(2)}))
    got = {(r["name"], r["row"]): r["vec"] for r in tensors.read(spark, str(tmp_path)).collect()}
    assert got == {("m.A", 0): [0, 1, 2], ("m.A", 1): [3, 4, 5], ("v", 0): [1, 1]}
