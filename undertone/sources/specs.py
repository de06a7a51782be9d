"""Mix, suite and settings files (YAML) as checked Python values and tables.

These files are small and read on the driver; ``mix_frame`` and ``suite_frame``
make the tables that queries join.
"""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

SPLITS = ("train", "validation")
SPEC_KEYS = ("name", "path", "task", "choose", "repeat", "weight", "language", "src_lang", "tgt_lang")
# Output tokens of a task, tokens a second of audio, chunk length.
TASK_TOKENS = {"ASR": 384, "ST": 384, "SQA": 512, "SDS": 768, "PQA": 256}
TASK_TOKENS_PER_S = {"ASR": 15, "ST": 15}
TASK_CHUNK_S = {"ASR": 30.0, "ST": 30.0}


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    path: str
    task: str
    choose: int | None = None
    repeat: float | None = None
    weight: float | None = None
    language: str | None = None
    src_lang: str | None = None
    tgt_lang: str | None = None

    def meta(self) -> dict:
        """The values that say something."""
        return {k: v for k, v in {"dataset": self.name, "task": self.task, "language": self.language, "src_lang": self.src_lang, "tgt_lang": self.tgt_lang}.items() if v}


@dataclass(frozen=True)
class EvalSet:
    name: str
    path: str
    task: str
    metrics: tuple[str, ...]
    processor: str = "generic"
    n: int = -1
    max_new_tokens: int = 384
    tokens_per_s: float = 0.0
    lang: str | None = None
    strip_speaker_tags: bool = False
    max_audio_s: float | None = None
    chunk_s: float | None = None
    min_ref_rate: float | None = None
    extra: dict = field(default_factory=dict)


class SpecError(ValueError):
    """All broken rules of a file at once, in ``problems``."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def load_mix(data: dict, exists=os.path.isdir) -> dict[str, list[DatasetSpec]]:
    """Parsed mix, every broken rule reported together."""
    problems = [f"unknown key {k}" for k in data if k not in ("dataset_basedir", *SPLITS)]
    base, out = data.get("dataset_basedir") or "", {}
    for split in SPLITS:
        seen: set[str] = set()
        out[split] = []
        for i, e in enumerate(data.get(split) or []):
            at = f"{split}[{i}]"
            problems += [f"{at}: unknown key {k}" for k in e if k not in SPEC_KEYS]
            lacking = [k for k in ("name", "path", "task") if not e.get(k)]
            problems += [f"{at}: no {k}" for k in lacking]
            if lacking:
                continue
            if e["name"] in seen:
                problems.append(f"{at}: duplicate name {e['name']}")
            seen.add(e["name"])
            if e.get("choose") is not None and e.get("repeat") is not None:
                problems.append(f"{at}: choose and repeat")
            path = os.path.join(base, e["path"])
            if not exists(path):
                problems.append(f"{at}: no folder {path}")
            out[split].append(DatasetSpec(**{k: e.get(k) for k in SPEC_KEYS} | {"path": path}))
    if problems:
        raise SpecError(problems)
    return out


def load_suite(data: dict, tier: str = "quick", only: list[str] | None = None, processor_of=lambda name: None) -> list[EvalSet]:
    """Sets with roots put in for the first part of their paths,
    the tier's number or settings over the set's, tier n = 0 left out, and the
    task's defaults where the set says nothing. ``processor_of`` names the
    processor module of a set that has its own. Unknown keys go to ``extra``."""
    roots, tiers = data.get("roots") or {}, data.get("tiers") or {"quick": 200, "full": -1}
    tokens = TASK_TOKENS | (data.get("max_new_tokens") or {})
    if tier not in tiers:
        raise SpecError([f"unknown tier {tier}"])
    problems, out = [], []
    known = {f for f in EvalSet.__dataclass_fields__ if f != "extra"}
    for e in data.get("datasets") or []:
        if only and e["name"] not in only:
            continue
        over = e.get(tier)
        over = over if isinstance(over, dict) else {} if over is None else {"n": over}
        v = {"n": tiers[tier]} | {k: x for k, x in e.items() if k not in tiers} | over
        if v["n"] == 0:
            continue
        first, _, rest = e["path"].partition("/")
        v["path"] = os.path.join(roots[first], rest) if first in roots else e["path"]
        metrics = v.pop("metric", v.pop("metrics", ()))
        v["metrics"] = (metrics,) if isinstance(metrics, str) else tuple(metrics)
        task = e["task"]
        for k, x in (("processor", processor_of(e["name"]) or "generic"), ("max_new_tokens", tokens.get(task, 384)), ("tokens_per_s", TASK_TOKENS_PER_S.get(task, 0)), ("chunk_s", TASK_CHUNK_S.get(task))):
            v.setdefault(k, x)
        if task == "ASR" and not v.get("lang") and {"wer", "cer"} & set(v["metrics"]):
            problems.append(f"{e['name']}: ASR without lang")
        out.append(EvalSet(**{k: x for k, x in v.items() if k in known}, extra={k: x for k, x in v.items() if k not in known}))
    if only:
        problems += [f"no set {n}" for n in only if n not in {s.name for s in out}]
    if problems:
        raise SpecError(problems)
    return out


def expand_config(config: dict, argv: list[str], environ: dict[str, str]) -> list[str]:
    """C4: settings as arguments before ``argv``; what argv names is left to
    it. Lists repeat values, true is a bare flag, false and null are left out,
    maps become JSON, ${NAME} is taken from the environment (KeyError)."""
    import json
    import re

    named = {a.split("=")[0] for a in argv if a.startswith("--")}
    out: list[str] = []

    def text(v) -> str:
        return re.sub(r"\$\{(\w+)\}", lambda m: environ[m[1]], v) if isinstance(v, str) else json.dumps(v) if isinstance(v, dict) else str(v)

    for k, v in config.items():
        flag = f"--{k}"
        if flag in named or v is None or v is False:
            continue
        out += [flag] if v is True else [flag, *map(text, v)] if isinstance(v, list) else [flag, text(v)]
    return out + argv


def mix_frame(spark: SparkSession, mix: dict[str, list[DatasetSpec]]) -> DataFrame:
    rows = [(i + 1, split, *(getattr(s, k) for k in SPEC_KEYS)) for i, (split, s) in enumerate((sp, s) for sp, ss in mix.items() for s in ss)]
    return spark.createDataFrame(rows, "spec_id int, split string, name string, path string, task string, choose long, repeat double, weight double, language string, src_lang string, tgt_lang string")


def suite_frame(spark: SparkSession, sets: list[EvalSet]) -> DataFrame:
    rows = [tuple(float(v) if k == "tokens_per_s" else list(v) if k == "metrics" else {a: str(b) for a, b in v.items()} if k == "extra" else v for k, v in asdict(s).items()) for s in sets]
    return spark.createDataFrame(rows, "name string, path string, task string, metrics array<string>, processor string, n int, max_new_tokens int, tokens_per_s double, lang string, strip_speaker_tags boolean, max_audio_s double, chunk_s double, min_ref_rate double, extra map<string,string>")
