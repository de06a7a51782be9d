"""Problem 6: speech transcripts into clean speaker turns.

A transcript is cut into stretches at its time stamps and speaker labels. Where
the clock falls by more than RESET_S either a segment starts, which goes on from
the one before, or some stamps are wild, whichever explains the file with less.
Inside a segment an isotonic regression over the file's order gives wild stamps
the time of their place; stretches are put in order of the repaired times, whose
starts and ends it makes monotone. A small grammar removes labels, annotations
and fillers; stretches of one canonical speaker are merged into turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from undertone.llm.arrow import schema_with
from undertone.sources.tables import table

RESET_S = 600.0
#: Wild stamps that a new segment counts as.
RESET_COST = 1.5

_BLANKS = str.maketrans({c: " " for c in "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"} | {c: None for c in "\u00ad\u200b\u200c\u200d\u2060\ufeff"} | {chr(0xFF01 + k): chr(0x21 + k) for k in range(94) if chr(0x21 + k) not in "!,;?"})
_ODD = re.compile("[\u00a0\u1680\u2000-\u200d\u202f\u205f\u2060\u3000\ufeff\u00ad\uff02-\uff0b\uff0d-\uff1a\uff1c-\uff1e\uff20-\uff5e]")

# Words that stand for a speaker, roles, fillers.
NUMBERED = ("speaker", "spk", "s", "说话人")
ROLES = ("host", "guest", "caller", "agent", "interviewer", "student")
FILLERS = ("uh", "um", "umm", "erm", "er", "hmm", "hm", "mm", "mhm")

_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?"
_STAMP = rf"\[{_CLOCK}\]|<t={_CLOCK}>|<t=\d+(?:\.\d+)?>|\(\d+(?:\.\d+)?\s?s\)|\({_CLOCK}\)|{_CLOCK}(?:\s*-->\s*{_CLOCK})?(?=\s)"
_WHO = rf"(?:(?:{'|'.join(NUMBERED)})[ _-]?\d{{1,3}}|{'|'.join(ROLES)}|(?-i:[ABC]))"
_LABEL = rf"<\s?{_WHO}\s?>(?:\s?[:>-])?|\[\s?{_WHO}\s?\](?:\s?[:>-])?|\(\s?{_WHO}\s?\)(?:\s?[:>-])?|{_WHO}\s?(?:[:>]|-(?=\s))"
_MARK = re.compile(rf"(?:(?<=\s)|^)(?:(?P<stamp>{_STAMP})\s*(?P<label>{_LABEL})?|(?P<only>{_LABEL}))", re.I | re.M)
#: A lone letter in brackets is an answer of a choice unless the line is timed.
_LETTER = re.compile(r"^[<\[(]\s?[ABC]\s?[>\])]$")
_KEY = re.compile(rf"({'|'.join(NUMBERED)})[ _-]?(\d+)|({'|'.join(ROLES)})|([ABC])", re.I)
_TIME = re.compile(r"(?:(?:(\d{1,2}):)?(\d{1,2}):)?(\d+)(?:[.,](\d+))?")
_ANNOTATION = re.compile(r"\[[^\[\]]*\]|<[^<>]*>|\*[^*]*\*|♪|\((?:[a-z]{1,10}|[a-z]+ [a-z]+)\)", re.I)
_FILLER = re.compile(rf"(?<![\w'])(?:{'|'.join(FILLERS)})(?![\w'])[,.]?", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w")
#: What a text needs to hold before it is worth cutting.
_HINT = re.compile(rf"(?<!\w)(?:{_LABEL})", re.I)


def _seconds(text: str) -> float:
    h, m, s, f = _TIME.search(text).groups()
    return int(h or 0) * 3600 + int(m or 0) * 60 + int(s) + (float("0." + f) if f else 0.0)


def _speaker(label: str) -> str:
    word, number, role, letter = _KEY.search(label).groups()
    return f"#{int(number)}" if number else role.lower() if role else letter.upper()


def isotonic(values: list[float], weights: list[float] | None = None) -> list[float]:
    """Weighted least-squares non-decreasing fit (pool adjacent violators)."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights or [1.0] * len(values)):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            (b, u, m), (a, t, n) = pools.pop(), pools.pop()
            pools.append([(a * t + b * u) / (t + u), t + u, n + m])
    return [v for v, _, n in pools for _ in range(int(n))]


def segments(stamps: list[float], reset_s: float = RESET_S) -> tuple[list[int], list[bool]]:
    """The file segment of every stamp, and whether the stamp is wild.

    The cheapest reading of the file: a wild stamp costs 1, a new segment
    RESET_COST; kept neighbours of a segment never fall by more than
    ``reset_s``. Of readings that cost the same, the one with fewer segments.
    """
    n = len(stamps)
    if all(b >= a - reset_s for a, b in zip(stamps, stamps[1:])):
        return [0] * n, [False] * n
    reach = int(2 * RESET_COST) + 1  # more wild stamps in a row cost more than two segments
    cost, before = [], []
    for i, s in enumerate(stamps):
        best = (float(i), 0, -1) if i <= reach else (float("inf"), 0, -1)
        for j in range(max(0, i - reach - 1), i):
            fall = s < stamps[j] - reset_s
            best = min(best, (cost[j][0] + (i - j - 1) + RESET_COST * fall, cost[j][1] + fall, j))
        cost.append(best[:2])
        before.append(best[2])
    at = min(range(n), key=lambda i: (cost[i][0] + n - 1 - i, cost[i][1]))
    wild, number = [True] * n, [0] * n
    starts = []
    while at >= 0:
        wild[at] = False
        j = before[at]
        if j >= 0 and stamps[at] < stamps[j] - reset_s:
            starts.append(at)
        at = j
    for start in starts:
        for k in range(start, n):
            number[k] += 1
    return number, wild


def clean(text: str) -> str:
    """An utterance without annotations, fillers and stray blanks."""
    before = None
    while before != text:
        before, text = text, _ANNOTATION.sub(" ", text)
    text = _SPACE.sub(" ", _FILLER.sub(" ", text)).strip()
    return re.sub(r" ([,.;:?!])", r"\1", text)


def stretches(text: str) -> tuple[list[list], bool]:
    """[start, end, speaker or None, raw text] in file order; any label seen."""
    out: list[list] = []
    labelled = False
    at, stamp, label = 0, None, None
    head = True
    for m in _MARK.finditer(text):
        mark = m["label"] or m["only"]
        if m["only"] and _LETTER.match(m["only"]):
            continue
        _push(out, stamp, label, text[at : m.start()], head)
        head = False
        at, stamp, label = m.end(), m["stamp"], mark
        labelled |= bool(mark)
    _push(out, stamp, label, text[at:], head)
    return out, labelled


def _push(out: list, stamp, label, raw: str, head: bool) -> None:
    if head and not raw.strip():
        return
    start = end = None
    if stamp:
        a, _, b = stamp.partition("-->")
        start = _seconds(a)
        end = _seconds(b) if b else None
    out.append([start, end, _speaker(label) if label else None, raw])


def ordered(parts: list[list], reset_s: float = RESET_S) -> list[list]:
    """Stretches in order of the repaired clock, with monotone times.

    A stretch without a stamp stays behind the one before it.
    """
    timed = [p for p in parts if p[0] is not None]
    number, wild = segments([p[0] for p in timed], reset_s)
    offset = high = 0.0
    for k in range(max(number, default=0) + 1):
        own = [i for i, m in enumerate(number) if m == k]
        fitted = isotonic([timed[i][0] for i in own], [1e-9 if wild[i] else 1.0 for i in own]) if any(wild) else [timed[i][0] for i in own]
        for i, fit in zip(own, fitted):
            p = timed[i]
            if wild[i]:  # rounded, as its own weight moves its pool a little
                fit = round(fit, 3)
                p[0], p[1] = fit, None if p[1] is None else fit + max(0.0, min(p[1] - p[0], reset_s))
            p[0] += offset
            p[1] = None if p[1] is None else p[1] + offset
            high = max(high, p[0], p[1] or 0.0)
        offset = high
    keyed: list[tuple[float, int]] = []
    for i, p in enumerate(parts):
        keyed.append((p[0] if p[0] is not None else keyed[-1][0] if keyed else -1.0, i))
    order = [parts[i] for _, i in sorted(keyed)]
    timed = [p for p in order if p[0] is not None]
    if timed:
        flat = isotonic([t for p in timed for t in (p[0], p[0] if p[1] is None else max(p[0], p[1]))])
        for k, p in enumerate(timed):
            p[1] = None if p[1] is None else flat[2 * k + 1]
            p[0] = flat[2 * k]
    return order


def turns(text: str | None) -> list[tuple[int, int, str, float | None, float | None, str]]:
    """(turn_no, speaker_no, speaker, start_s, end_s, text) of a transcript.

    Null, empty and label-free texts have no turns. A stretch before the first
    label goes with the first labelled speaker.
    """
    if not text or not _HINT.search(text):
        if not text or not _ODD.search(text):
            return []
    if _ODD.search(text):
        text = text.translate(_BLANKS)
        if not _HINT.search(text):
            return []
    parts, labelled = stretches(text)
    if not labelled:
        return []
    out: list[list] = []
    numbers: dict[str, int] = {}
    order = ordered(parts)
    speaker = next((p[2] for p in order if p[2]), None)
    for start, end, who, raw in order:
        speaker = who or speaker
        said = clean(raw)
        if not _WORD.search(said):
            continue
        if out and out[-1][2] == speaker:
            out[-1][5] += " " + said
            out[-1][4] = end if end is not None else start if start is not None else out[-1][4]
        else:
            out.append([len(out) + 1, numbers.setdefault(speaker, len(numbers) + 1), speaker, start, end, said])
    return [tuple(t) for t in out]


def speaker_turns(df: DataFrame, key: str, text: str, detail: bool = True) -> DataFrame:
    """Turns of every transcript: one pass over the rows, repeats kept."""
    slim = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t")).filter("key is not null and t is not null")
    extra = {"turn_no": T.IntegerType(), "speaker_no": T.IntegerType()}
    if detail:
        extra |= {"speaker": T.StringType(), "start_s": T.DoubleType(), "end_s": T.DoubleType(), "text": T.StringType()}
    schema = schema_with(slim, ["key"], **extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string()][: len(extra)]
        for batch in batches:
            keys, cols = [], [[] for _ in extra]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for turn in turns(t):
                    keys.append(k)
                    for col, v in zip(cols, turn):
                        col.append(v)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(cols, types))], names=["key", *extra])

    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speaker_turns(table(spark, sf_dir, "mds_samples"), "sample_id", "response_text", detail=False).distinct()


def p6_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speaker_turns(table(spark, sf_dir, "mds_samples"), "sample_id", "response_text").distinct()
