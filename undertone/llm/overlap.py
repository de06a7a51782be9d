"""Problem 4: same or near-same records across splits.

A weighted cosine join between the training texts and the evaluation answers.
The terms of a text are its runs of four to six tokens, their weights the square roots
of the information of the run, so a dot product adds up the information of the
shared runs. An answer of n tokens may differ in e = n / PART of them; an edit
touches at most as many runs, so a match keeps a dot product of at least

    bound = |a|^2 - (the heaviest runs that e edits can touch).

Maximum weight: a text's component of a term is that term's weight or nothing,
so the terms left out of the lists can add their squared weights and no more.
Residual norm: terms are listed from the heaviest down until the squared norm of
the rest falls below the bound; a text that meets no listed term can't reach it.
Lists are keyed by run, length class and stretch of places and joined in one
shuffle whose hot terms are salted. Pairs that meet get their exact dot product
and cosine; those that reach the bound get their edit count.

Answers that carry little information a token (long Thai ones) would list terms
that most texts have. By an estimate of the texts their lists would meet, such
an answer is dealt to blocks of its length class instead: lists of bounded size
in memory, through which the texts of that class pass, with the same dot products
and bounds. Equal texts of either side are one class until the end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from undertone.llm.arrow import cut, duckdb_project, schema_with
from undertone.llm.lookalike import canonical_sql
from undertone.sources.tables import table

LEAST_WORDS, LEAST_CHARS = 5, 10
#: One edit in so many tokens.
PART = 8
#: Tokens of a term in texts of the first, second and all further length
#: classes; a text of the first class has at most SHORT_TEXT tokens.
ORDERS, SHORT_TEXT = (4, 5, 6), 10
#: Slots of a count table (fixed, whatever the data).
SLOTS = 1 << 18
#: Bits of the filter for a listed key, and the largest filter that is sent to
#: the tasks; above it the runs of all texts are shuffled.
FILTER_BITS, FILTER_MAX_BYTES = 12, 64 << 20
#: Share of the texts of its length that an answer's lists may meet.
LISTED_SHARE = 0.005
#: Answers of a block, texts that pass it in one task; a slot of terms is hot with
#: more rows than HOT and HOT_FACTOR times the mean.
BLOCK, BLOCK_TEXTS, HOT, HOT_FACTOR = 4096, 8_000, 1_000_000, 8
PACK_BITS = 16
#: Keys of candidates that a bitmap in the plan stands for.
KEPT_KEYS = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def comparable_sql(column: str, chars: set[str]) -> str:
    """DuckDB expression: lower-case canonical words; annotations, fillers,
    speaker labels, time stamps and punctuation removed."""
    e = canonical_sql(column, chars, lines=False)
    marks = "one"
    if chars & set("[<*("):
        for _ in range(2):
            marks = rf"regexp_replace({marks}, '\[[^\[\]]*\]|<[^<>]*>|\*[^*]*\*|\([A-Za-z]{{1,10}}( [A-Za-z]+)?\)|\([0-9.]+ ?s\)', ' ', 'g')"
    if ":" in chars:
        clock = r"[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?([.,][0-9]+)?"
        marks = rf"regexp_replace({marks}, '{clock}( *--> *{clock})?', ' ', 'g')"
    marks = rf"regexp_replace({marks}, '(?i)\b(speaker|spk|s)[ _-]?[0-9]+ ?[])>:-]*|\([ ]?(speaker|spk|s)[ _-]?[0-9]+ ?\)|说话人 ?[0-9]+|\b(host|guest|caller|agent|interviewer|student) ?[:>]', ' ', 'g')"
    marks = rf"regexp_replace({marks}, '(^|\s)[ABC] ?[:>]', ' ', 'g')"
    # texts that hold no sign of a mark, or no letters of a filler, are spared
    e = rf"list_transform([{e}], lambda one: CASE WHEN regexp_matches(one, '[0-9:>\[<*(]') THEN {marks} ELSE one END)[1]"
    e = f"lower({e})"
    if chars & set("'’`´"):
        e = f"translate({e}, '''’`´', '')"
    e = rf"regexp_replace({e}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')"
    fillers = r"regexp_replace(two, '\b(uh|um|umm|erm|hmm)\b( |$)', '', 'g')"
    return f"trim(list_transform([{e}], lambda two: CASE WHEN regexp_matches(two, 'uh|um|erm|hmm') THEN {fillers} ELSE two END)[1])"


_CHARACTER_RANGE = frozenset(map(chr, [*range(0x0E00, 0x0E80), *range(0x2E80, 0xA000)]))
_CHARACTER = re.compile("[฀-๿⺀-鿿]")
_TOKEN = re.compile("[฀-๿⺀-鿿]|[^฀-๿⺀-鿿 ]+")


def tokens(text: str) -> list[str]:
    """Words; of Chinese and Thai the characters."""
    return _TOKEN.findall(text) if not text.isascii() else text.split(" ") if text else []


def by_character(ts: list[str]) -> bool:
    """Whether most tokens are single Chinese or Thai characters."""
    return 2 * sum(map(_CHARACTER_RANGE.__contains__, ts)) > len(ts)


def counts(ts: list[str]) -> bool:
    """Whether an answer of these tokens is long enough to count."""
    return len(ts) >= LEAST_WORDS and (len(ts) >= LEAST_CHARS or not by_character(ts))


class _Known(dict):
    """Hashes of the tokens met so far."""

    def __missing__(self, token: str) -> int:
        import xxhash

        self[token] = made = xxhash.xxh3_64_intdigest(token)
        return made


class Hasher:
    """64-bit hashes of tokens, kept, and of all runs of a length."""

    def __init__(self):
        self.known = _Known()

    def hashes(self, ts: list[str]) -> np.ndarray:
        if len(self.known) > 500_000:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, ts), np.uint64, len(ts))

    #: Powers of the base and of its inverse, longer as needed.
    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    @classmethod
    def prefix(cls, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of h[i] * base^i and the inverse powers."""
        n = len(h)
        with np.errstate(over="ignore"):
            if len(cls._powers[0]) <= n:
                size = max(1024, 2 * n)
                inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
                cls._powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64))]) for x in (_BASE, inverse))
            powers, back = cls._powers
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers[:n], dtype=np.uint64)])
        return sums, back

    @staticmethod
    def mix(x: np.ndarray, k) -> np.ndarray:
        """Spread the bits of run hashes of length k (a number or an array)."""
        with np.errstate(over="ignore"):
            x = x ^ np.asarray(k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return x ^ (x >> np.uint64(31))

    def runs(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hash of every run of k tokens of one array."""
        sums, back = self.prefix(h)
        with np.errstate(over="ignore"):
            return self.mix((sums[k:] - sums[:-k]) * back[: len(h) - k + 1], k) if len(h) >= k else np.zeros(0, np.uint64)


def laid_out(texts: list[str], hasher: Hasher):
    """Token hashes of all texts in one array, with the texts' tokens, starts
    and the end that holds for each token."""
    split = [tokens(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    stop = np.cumsum(sizes)
    return hasher.hashes([t for ts in split for t in ts]), split, stop - sizes, np.repeat(stop, sizes)


def information(h: np.ndarray, k: int, hasher: Hasher, tables: list[np.ndarray]) -> np.ndarray:
    """Bits of every run of ``k`` tokens of ``h`` by the counts of words, pairs
    and triples: the first token alone, the second after one, others after two."""
    if len(h) < k:
        return np.zeros(0)
    n = [np.maximum(tables[j][(hasher.runs(h, j + 1) % SLOTS).astype(np.int64)], 0.5) for j in range(min(k, 3))]
    bits = [np.log2(max(2.0, float(tables[0].sum())) / n[0])]
    bits += [np.log2(np.maximum((n[j - 1][:-1] + 2.0) / n[j], 1.0)) for j in range(1, len(n))]
    many = len(h) - k + 1
    out = bits[0][:many] + (bits[1][:many] if k > 1 else 0.0)
    if k > 2:
        sums = np.concatenate([[0.0], np.cumsum(bits[2])])
        out = out + sums[k - 2 :][:many] - sums[:many]
    return np.maximum(out, 0.05)


def most_lost(weights: np.ndarray, order: int, edits: int) -> float:
    """The most that ``edits`` edits can take from the squared weights of the
    runs of one text, an edit taking up to ``order`` neighbouring runs."""
    total = np.concatenate([[0.0], np.cumsum(weights)])
    low = np.maximum(np.arange(1, len(total)) - order, 0)
    taken = total[1:] - total[low]
    best = np.zeros(len(total))
    for _ in range(edits):
        np.maximum.accumulate(best[low] + taken, out=best[1:])
    return float(best[-1])


def edit_distance(a: list[str], b: list[str]) -> int:
    """Levenshtein distance of token lists, one bit a token of ``a``."""
    m = len(a)
    if not m:
        return len(b)
    where: dict[str, int] = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for t in b:
        eq = where.get(t, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1 | 1) & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return score


def _normalised(df: DataFrame, key: str, text: str) -> DataFrame:
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("t")).filter("key is not null and t is not null and t <> ''")
    return duckdb_project(slim, {"norm": lambda chars: comparable_sql('"t"', chars)}, ["key"], "t").filter("norm <> ''")


def _count_tables(classes: DataFrame) -> list[np.ndarray]:
    """Counts of words, pairs and triples over all answers, in SLOTS slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        table_ = np.zeros(3 * SLOTS, np.int64)
        for batch in batches:
            h, _, _, end = laid_out(batch.column(0).to_pylist(), hasher)
            for k in range(3):
                r = hasher.runs(h, k + 1)
                r = r[np.arange(len(r)) + k + 1 <= end[: len(r)]]
                table_[k * SLOTS : (k + 1) * SLOTS] += np.bincount((r % SLOTS).astype(np.int64), minlength=SLOTS)
        slots = np.flatnonzero(table_)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(table_[slots])], names=["slot", "c"])

    rows = classes.select("norm").mapInArrow(run, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toPandas()
    every = np.zeros(3 * SLOTS, np.int64)
    every[rows["slot"].to_numpy(np.int64)] = rows["c"].to_numpy(np.int64)
    return [every[k * SLOTS : (k + 1) * SLOTS] for k in range(3)]


def length_class(n):
    """Class of a text's number of tokens: 0 up to SHORT_TEXT, then by doubling;
    n and n +- n / PART lie in at most two neighbouring ones, or in 0 to 2."""
    return np.searchsorted(SHORT_TEXT * (1 << np.arange(40, dtype=np.int64)), np.asarray(n), side="left")


def order_of(cls):
    """Length of the terms of texts in a class. For every answer that may match
    such a text n - order + 1 > order * (n / PART), so a match keeps a term."""
    return np.array(ORDERS)[np.minimum(cls, len(ORDERS) - 1)]


def stretch(cls):
    """Width of the places that count as one in texts of a length class."""
    return SHORT_TEXT * (1 << np.asarray(cls, np.int64)) // 3 + 1


def place_key(cls, place):
    """What a run's hash is mixed with: its text's length class and place."""
    with np.errstate(over="ignore"):
        return (np.asarray(cls).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) + np.asarray(place).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)


class Listed:
    """One answer: its terms for one order, their squared weights, its bound,
    and the terms that are listed (``head``)."""

    def __init__(self, runs: np.ndarray, weights: np.ndarray, order: int, edits: int):
        self.runs, self.weights = runs, weights
        self.norm2 = float(weights.sum())
        self.bound = self.norm2 - most_lost(weights, order, edits)
        heavy = np.argsort(-weights, kind="stable")
        rest = self.norm2 - np.cumsum(weights[heavy])
        # the residual must stay below the bound by more than rounding
        self.head = heavy[: int(np.count_nonzero(rest >= self.bound * (1 - 1e-9))) + 1]

    def share(self, edits: int) -> float:
        """Estimate of the share of texts of its length that its lists meet."""
        return float((2.0 ** -self.weights[self.head]).sum()) * (2 * edits + 1)


def dot(listed: Listed, runs: np.ndarray, edits: int) -> float:
    """Exact dot product of an answer and the runs of a text: the squared
    weights of the answer's terms that the text has within ``edits`` places."""
    order = np.argsort(runs, kind="stable")
    sorted_ = runs[order]
    a, b = np.searchsorted(sorted_, listed.runs, side="left"), np.searchsorted(sorted_, listed.runs, side="right")
    out = 0.0
    for i in np.flatnonzero(b > a).tolist():
        if np.abs(order[a[i] : b[i]] - i).min() <= edits:
            out += listed.weights[i]
    return out


def answers_of(classes: DataFrame) -> tuple[DataFrame, object]:
    """The classes of answers long enough to count, and the broadcast count
    tables (3 x SLOTS numbers, whatever the data).

    A row for each order of terms an answer needs (one or two, the first of them
    marked ``main``): ek, e64, norm, n, main, order, low, chars, sketch, runs and places of the listed terms.
    ``low``: the answer goes through the blocks of its length class.
    """
    shared = classes.sparkSession.sparkContext.broadcast(_count_tables(classes))
    fields = {"e64": T.LongType(), "n": T.IntegerType(), "main": T.BooleanType(), "order": T.IntegerType(), "bound": T.DoubleType(), "low": T.BooleanType(), "chars": T.BooleanType(), "sketch": T.LongType(), "runs": T.ArrayType(T.LongType()), "places": T.ArrayType(T.IntegerType())}
    types = [pa.binary(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.float64(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tables = Hasher(), shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            h, split, start, _ = laid_out(batch.column(1).to_pylist(), hasher)
            lengths = sorted({len(ts) for ts in split})
            needed = {int(order_of(length_class(m))) for n in lengths for m in (n - n // PART, n, n + n // PART)}
            known = {k: (hasher.runs(h, k), information(h, k, hasher, tables)) for k in needed}
            out = []
            for ek, t, ts, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), split, start.tolist()):
                if not counts(ts):
                    continue
                n, edits, chars = len(ts), len(ts) // PART, by_character(ts)
                mark = int(sketch(h[a : a + n], np.zeros(1, np.int64))[0])
                same = (ek, t, int.from_bytes(ek[:8], "little", signed=True), n)
                if not edits:
                    out.append((*same, True, n, 0.0, False, chars, mark, whole(h[a : a + n], hasher).view(np.int64), np.zeros(1, np.int32)))
                    continue
                lists = {}
                for k in sorted({int(order_of(c)) for c in range(int(length_class(n - edits)), int(length_class(n + edits)) + 1)}):
                    runs, weights = (x[a : a + n - k + 1] for x in known[k])
                    lists[k] = Listed(runs, weights, k, edits)
                low = any(x.share(edits) > LISTED_SHARE for x in lists.values())
                for k, x in lists.items():
                    out.append((*same, k == min(lists), k, x.bound, low, chars, mark, x.runs[x.head].view(np.int64), x.head.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["ek", "norm", *fields])

    return classes.select("ek", "norm").mapInArrow(run, schema_with(classes, ["ek", "norm"], **fields)), shared


def inverted_lists(answers: DataFrame) -> DataFrame:
    """(h, e64, where, sketch): every listed term of every answer under each
    length class and stretch of places where a match may have it; ``where`` is
    the answer's length and the term's place in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e64, n, order, mark = (batch.column(c).to_numpy() for c in ("e64", "n", "order", "sketch"))
            places = batch.column("places")
            of = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            runs, at = batch.column("runs").flatten().to_numpy().view(np.uint64), places.flatten().to_numpy().astype(np.int64)
            edits = (n // PART)[of]
            low = length_class(n[of] - edits)
            keys, rows = [runs[edits == 0]], [np.flatnonzero(edits == 0)]
            for more in range(3):
                cls = low + more
                i = np.flatnonzero((edits > 0) & (cls <= length_class(n[of] + edits)) & (order_of(cls) == order[of]))
                wide = stretch(cls[i])
                first, last = np.maximum(0, at[i] - edits[i]) // wide, (at[i] + edits[i]) // wide
                for step in range(int((last - first).max(initial=-1)) + 1):
                    ok = first + step <= last
                    j = i[ok]
                    keys.append(Hasher.mix(runs[j] ^ place_key(cls[j], first[ok] + step), order[of[j]]))
                    rows.append(j)
            h, j = np.concatenate(keys), np.concatenate(rows)
            o = of[j]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e64[o]), pa.array(n[o].astype(np.int64) << 32 | at[j]), pa.array(mark[o])], names=["h", "e64", "where", "sketch"])

    return answers.filter("not low").select("e64", "n", "order", "sketch", "runs", "places").mapInArrow(run, "h long, e64 long, where long, sketch long")


def whole(h: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Key of a text that may differ in no token."""
    return Hasher.mix(hasher.runs(h, len(h)), 1)


def sketch(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64 bits for each text: one for every token, by its hash. An edit takes
    away at most one bit and adds at most one."""
    if not len(h):
        return np.zeros(len(start), np.int64)
    return np.bitwise_or.reduceat(np.uint64(1) << (h >> np.uint64(58)), start).view(np.int64)


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(bits)).astype(np.int64), (Hasher.mix(h, 2) % np.uint64(bits)).astype(np.int64)


def key_filter(lists: DataFrame) -> tuple[int, np.ndarray] | None:
    """Bloom filter (two probes) of the listed keys, FILTER_BITS bits for each
    row; None if it would be larger than FILTER_MAX_BYTES."""
    n = lists.count()
    bits = max(1, -(-n * FILTER_BITS >> PACK_BITS)) << PACK_BITS
    if bits > 8 * FILTER_MAX_BYTES:
        return None

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(np.concatenate(_probes(batch.column(0).to_numpy().view(np.uint64), bits)))
                block, first = np.unique(at >> PACK_BITS, return_index=True)
                offsets = np.split((at & ((1 << PACK_BITS) - 1)).astype("<u2"), first[1:])
                yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array([o.tobytes() for o in offsets], pa.binary())], names=["block", "offsets"])

    def pack(key, batch):
        one = np.zeros(1 << PACK_BITS, np.uint8)
        for o in batch.column("offsets").to_pylist():
            one[np.frombuffer(o, "<u2")] = 1
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(one, bitorder="little").tobytes()]}, schema=pa.schema([("block", pa.int32()), ("bits", pa.binary())]))

    out = np.zeros(bits >> 3, np.uint8)
    step = 1 << (PACK_BITS - 3)
    for r in lists.select("h").mapInArrow(parts, "block int, offsets binary").groupBy("block").applyInArrow(pack, "block int, bits binary").collect():
        out[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return bits, out


def scan(rows: DataFrame, known: tuple[int, np.ndarray] | None, ranges: list[tuple[bool, bool, int, int]]) -> DataFrame:
    """(key, s64, sk, n, sketch, h, at, norm) of every training row: its class,
    the keys of its runs that may be listed with their places, and its text.
    Keys and text stand where its length and script lie in one of ``ranges``
    (low, chars, from, to) of listed and of low answers."""
    shared = rows.sparkSession.sparkContext.broadcast((known, ranges))
    schema = schema_with(rows, ["key"], s64=T.LongType(), sk=T.BinaryType(), n=T.IntegerType(), sketch=T.LongType(), h=T.ArrayType(T.LongType()), at=T.ArrayType(T.IntegerType()), norm=T.StringType())

    def inside(h: np.ndarray) -> np.ndarray:
        i = np.arange(len(h))
        if shared.value[0] is not None:
            bits, filter_ = shared.value[0]
            for at in _probes(h, bits):
                at = at[i]
                i = i[(filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        return i

    fitting: dict[int, list] = {}

    def wanted(text: str, n: int) -> tuple[bool, bool]:
        """Whether listed, and low, answers may match a text of n tokens."""
        if n not in fitting:
            fitting[n] = [{chars for low_, chars, lo, hi in shared.value[1] if low_ == low and lo <= n <= hi} for low in (False, True)]
        if not any(fitting[n]):
            return False, False
        # an edit of a match may change which script has the most
        share = 0.0 if text.isascii() else len(_CHARACTER.findall(text)) / max(1, n)
        return tuple(share > 0.25 and True in kinds or share < 0.75 and False in kinds for kinds in fitting[n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hasher = Hasher()
        for batch in batches:
            if not batch.num_rows:
                continue
            norms = batch.column(1).to_pylist()
            split = [tokens(t) for t in norms]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            listed, low = np.array([wanted(t, len(ts)) for t, ts in zip(norms, split)], bool).T
            # only texts that listed answers may match are hashed
            mine = np.flatnonzero(listed)
            inner = sizes[mine]
            stop = np.cumsum(inner)
            start, end, owner = stop - inner, np.repeat(stop, inner), np.repeat(np.arange(len(mine)), inner)
            h = hasher.hashes([t for i in mine.tolist() for t in split[i]])
            cls = length_class(inner)
            wide, order = stretch(cls), order_of(cls)
            keys, places, owners = [], [], []
            for k in ORDERS:
                if not (order == k).any():
                    continue
                runs = hasher.runs(h, k)
                i = np.flatnonzero((np.arange(len(runs)) + k <= end[: len(runs)]) & (order[owner[: len(runs)]] == k))
                o = owner[i]
                at = i - start[o]
                key = Hasher.mix(runs[i] ^ place_key(cls[o], at // wide[o]), k)
                j = inside(key)
                keys.append(key[j])
                places.append(at[j])
                owners.append(o[j])
            short = np.flatnonzero((inner < PART) & (inner >= LEAST_WORDS))
            if len(short):
                key = np.concatenate([whole(h[start[o] : stop[o]], hasher) for o in short.tolist()])
                j = inside(key)
                keys.append(key[j])
                places.append(np.zeros(len(j), np.int64))
                owners.append(short[j])
            key, at, o = (np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.uint64, keys), (np.int64, places), (np.int64, owners)))
            o = mine[o]
            by = np.argsort(o, kind="stable")
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(o, minlength=len(split)))]).astype(np.int32))
            marks = np.zeros(len(split), np.int64)
            some = np.flatnonzero(inner)
            marks[mine[some]] = sketch(h, start[some])
            digests = [xxhash.xxh3_128_digest(t) for t in norms]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.frombuffer(b"".join(digests), "<i8")[::2]), pa.array(digests, pa.binary()), pa.array(sizes.astype(np.int32)), pa.array(marks), pa.ListArray.from_arrays(offsets, pa.array(key[by].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(at[by].astype(np.int32))), pa.array([t if w else None for t, w in zip(norms, low.tolist())], pa.string())],
                names=["key", "s64", "sk", "n", "sketch", "h", "at", "norm"],
            )

    return rows.mapInArrow(run, schema)


def listed_pairs(scanned: DataFrame, lists: DataFrame) -> DataFrame:
    """(s64, e64): texts and answers that meet in a listed term at places, and
    with lengths and tokens, that a match may have.

    Keys of a slot (of 4,096) that holds more than HOT rows and eight times the
    mean are salted: a text's row goes to one part, the list to all of them.
    """
    packed = F.shiftleft(F.col("n").cast("long"), 32)
    hits = scanned.filter(F.size("h") > 0).select("s64", F.col("sketch").alias("sketch_text"), packed.alias("n"), F.explode(F.arrays_zip("h", "at")).alias("x")).select("s64", "sketch_text", F.col("x.h").alias("h"), F.col("n").bitwiseOR(F.col("x.at").cast("long")).alias("where_text"))
    slot = F.col("h").bitwiseAND(4095).cast("int")
    slots = hits.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("c")).collect()  # 4,096 rows at most
    hot = max(float(HOT), HOT_FACTOR * sum(r["c"] for r in slots) / 4096)
    parts = {r["slot"]: int(-(-r["c"] // hot)) for r in slots if r["c"] > hot}
    if parts:
        salts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), slot), F.lit(1))
        hits = hits.withColumn("salt", F.pmod(F.xxhash64("where_text", "sketch_text", "s64", F.monotonically_increasing_id()), salts).cast("int"))
        lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    n, at, n_text, place = (f(c) for c in ("where", "where_text") for f in (lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)))
    edits = F.floor(n / PART)
    lost, gained = F.bit_count(F.col("sketch").bitwiseAND(F.bitwise_not("sketch_text"))), F.bit_count(F.col("sketch_text").bitwiseAND(F.bitwise_not("sketch")))
    near = (F.abs(place - at) <= edits) & (F.abs(n_text - n) <= edits) & (lost <= edits) & (gained <= edits)
    return hits.join(lists, ["h", "salt"] if parts else ["h"]).filter(near).select("s64", "e64").distinct()


class Judge:
    """Holds texts against answers: token counts, exact dot product, edit count,
    cosine. What an answer needs is kept while texts of the same order come."""

    def __init__(self, tables: list[np.ndarray]):
        self.hasher, self.tables = Hasher(), tables
        self.kept: tuple = (None, None, None)
        self.last: tuple = (None, None)

    def terms(self, ts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
        h = self.hasher.hashes(ts)
        return self.hasher.runs(h, order), information(h, order, self.hasher, self.tables)

    def counted(self, text: list[str]) -> Counter:
        """The token counts of a text, those of the last one kept."""
        if self.last[0] is not text:
            self.last = (text, Counter(text))
        return self.last[1]

    def decide(self, text: list[str], answer: list[str]) -> tuple[int, float] | None:
        """(edits, cosine) of a match, None below the bound or above the edits."""
        n, edits = len(answer), len(answer) // PART
        if abs(len(text) - n) > edits:
            return None
        order = int(order_of(length_class(len(text)))) if edits else n
        if self.kept[0] is not answer:
            self.kept = (answer, Counter(answer), {})
        _, counted, lists = self.kept
        if (counted - self.counted(text)).total() > edits:
            return None
        if order not in lists:
            lists[order] = Listed(*self.terms(answer, order), order, edits)
        listed = lists[order]
        product = dot(listed, self.hasher.runs(self.hasher.hashes(text), order), edits)
        if product < listed.bound * (1 - 1e-9):
            return None
        found = edit_distance(answer, text)
        if found > edits:
            return None
        return found, min(1.0, product / (listed.norm2 * float(self.terms(text, order)[1].sum())) ** 0.5)


MATCH = "sk binary, ek binary, edits int, cosine double"
_MATCH = pa.schema([("sk", pa.binary()), ("ek", pa.binary()), ("edits", pa.int32()), ("cosine", pa.float64())])


def _matches(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [()] * 4, _MATCH)], schema=_MATCH)


def verify(pairs: DataFrame, shared) -> DataFrame:
    """The matches among pairs (sk, text, ek, answer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, last, answer = Judge(shared.value), None, []
        for batch in batches:
            out = []
            for sk, t, ek, a in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if ek != last:  # rows of an answer mostly follow each other
                    last, answer = ek, tokens(a)
                if made := judge.decide(tokens(t), answer):
                    out.append((sk, ek, *made))
            yield from _matches(out).to_batches()

    return pairs.select("sk", "text", "ek", "answer").mapInArrow(run, MATCH)


class Block:
    """The lists of a bounded number of answers (ek, text, bound), for texts of
    a class whose terms have one order."""

    def __init__(self, answers: list[tuple[bytes, str, float]], judge: Judge, order: int):
        self.eks, texts, bounds = zip(*answers)
        self.judge, self.order, self.bound = judge, order, np.array(bounds) * (1 - 1e-9)
        h, self.tokens, start, end = laid_out(list(texts), judge.hasher)
        self.n = np.fromiter(map(len, self.tokens), np.int64, len(texts))
        self.edits = self.n // PART
        runs, weight = judge.hasher.runs(h, order), information(h, order, judge.hasher, judge.tables)
        of = np.repeat(np.arange(len(texts)), self.n)
        inside = np.flatnonzero(np.arange(len(runs)) + order <= end[: len(runs)])
        at = inside - start[of[inside]]
        by = np.lexsort((at, runs[inside]))
        self.runs, number = np.unique(runs[inside][by], return_inverse=True)
        # the lists one behind another, each in order of places
        self.keys = number.astype(np.int64) << 32 | at[by]
        self.who, self.weight = of[inside][by], weight[inside][by]

    def matches(self, texts: list[str]):
        """(text, answer, edits, cosine) of all matches: dot products are added
        up over the lists of a text's runs; what reaches its bound is decided.

        A list is read where the places are near for the answer with the most
        edits, and a term found at two places counts twice, which only lets
        more by.
        """
        h, split, start, end = laid_out(texts, self.judge.hasher)
        runs = self.judge.hasher.runs(h, self.order)
        found = np.searchsorted(self.runs, runs)
        found[found == len(self.runs)] = 0
        hit = np.flatnonzero((self.runs[found] == runs) & (np.arange(len(runs)) + self.order <= end[: len(runs)]))
        cuts = np.searchsorted(hit, start)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        place = hit - np.repeat(start, np.diff(cuts, append=len(hit)))
        reach, lists = int(self.edits.max()), found[hit].astype(np.int64) << 32
        first, last = np.searchsorted(self.keys, lists | np.maximum(place - reach, 0)), np.searchsorted(self.keys, lists | place + reach, side="right")
        many = last - first
        for t, (a, b) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(hit)])):
            m = many[a:b]
            flat = np.repeat(first[a:b] - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
            product = np.bincount(self.who[flat], self.weight[flat], minlength=len(self.n))
            for k in np.flatnonzero((product >= self.bound) & (product > 0) & (np.abs(self.n - sizes[t]) <= self.edits)).tolist():
                if made := self.judge.decide(split[t], self.tokens[k]):
                    yield t, self.eks[k], *made


def block_pairs(scanned: DataFrame, answers: DataFrame, shared) -> DataFrame:
    """The matches of the answers marked ``low``, class by class in blocks.

    A class's answers are dealt to blocks of about BLOCK, its texts to parts of
    about BLOCK_TEXTS; every part meets every block of its class in one task.
    """
    reach = F.floor(F.col("n") / PART)
    low = answers.filter("low").select("ek", "e64", "norm", "bound", "order", F.explode(F.sequence(_class_of(F.col("n") - reach), _class_of(F.col("n") + reach))).alias("cls"))
    # an answer may need terms of two orders, each with its bound
    low = low.filter(F.col("order") == F.element_at(F.lit(list(ORDERS)), F.least(F.col("cls") + 1, F.lit(len(ORDERS)))))
    texts = scanned.filter("norm is not null").groupBy("sk").agg(F.first("norm").alias("norm"), F.first("n").alias("n")).withColumn("cls", _class_of(F.col("n")))
    blocks = low.groupBy("cls").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    parts = texts.groupBy("cls").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("parts"))
    sizes = F.broadcast(blocks.join(parts, "cls"))  # a row a length class
    left = low.join(sizes, "cls").select("cls", F.pmod(F.xxhash64("e64"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "ek", "norm", "bound")
    right = texts.join(sizes, "cls").select("cls", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("sk"), "parts").cast("int").alias("part"), "sk", "norm")

    def run(key, held: pa.Table, texts_: pa.Table) -> pa.Table:
        if not held.num_rows or not texts_.num_rows:
            return _matches([])
        block = Block(list(zip(*(held.column(c).to_pylist() for c in ("ek", "norm", "bound")))), Judge(shared.value), int(order_of(key[0].as_py())))
        out = []
        for part in texts_.to_batches(max_chunksize=2000):
            sks = part.column("sk").to_pylist()
            out += [(sks[t], *m) for t, *m in block.matches(part.column("norm").to_pylist())]
        return _matches(out)

    by = ["cls", "block", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, MATCH)


def _class_of(n):
    """``length_class`` as a column."""
    return F.when(n <= SHORT_TEXT, 0).otherwise(F.ceil(F.log2(n / float(SHORT_TEXT))).cast("int"))


def among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key may be one of ``keys`` (all that are, some
    that are not): up to KEPT_KEYS a bitmap in the plan, above it a join."""
    n = keys.count()
    if n > KEPT_KEYS:
        return df.join(keys.select(F.col("key").alias(key)).distinct(), key, "left_semi")
    bits = 1 << max(3, (32 * n).bit_length())
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    bitmap = np.zeros(bits, np.uint8)
    bitmap[[r[0] for r in keys.select(place("key")).distinct().collect()]] = 1  # KEPT_KEYS numbers at most
    there = lambda at: F.conv(F.hex(F.substring(F.lit(bytearray(np.packbits(bitmap, bitorder="little").tobytes())), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    at = place(F.col(f"`{key}`").cast(keys.schema["key"].dataType))
    return df.filter(F.pmod(F.floor(there(at) / F.pow(F.lit(2), at.bitwiseAND(7))), F.lit(2)) == 1)


def _matched(train: DataFrame, train_key: str, train_text: str, held: DataFrame, held_key: str, held_text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matches of classes (sk, ek, edits, cosine), and the members of both
    sides: (key, sk) and (key, ek)."""
    held_rows = cut(_normalised(held, held_key, held_text).withColumn("ek", F.unhex(F.md5("norm"))))
    answers, shared = answers_of(held_rows.groupBy("ek").agg(F.first("norm").alias("norm")))
    answers = cut(answers)
    lists = inverted_lists(answers)
    reach = F.floor(F.col("n") / PART)
    ranges = [tuple(r) for r in answers.groupBy("low", "chars", _class_of(F.col("n")).alias("c")).agg(F.min(F.col("n") - reach), F.max(F.col("n") + reach)).drop("c").collect()]  # two rows a length class
    scanned = cut(scan(_normalised(train, train_key, train_text), key_filter(lists), ranges))
    pairs = cut(listed_pairs(scanned, lists))
    # the texts of the candidates are normalised again rather than kept for all
    met = pairs.select("s64").distinct()
    classes = cut(among(scanned.select("key", "s64", "sk"), "s64", met.withColumnRenamed("s64", "key")).join(met, "s64").groupBy("s64", "sk").agg(F.min("key").alias("key")))
    texts = _normalised(among(train, train_key, classes.select("key")), train_key, train_text)
    texts = scan(texts, (1 << PACK_BITS, np.zeros(1 << (PACK_BITS - 3), np.uint8)), [(True, c, 0, 1 << 40) for c in (True, False)]).select("sk", F.col("norm").alias("text"))
    texts = texts.join(classes.select("s64", "sk"), "sk").dropDuplicates(["sk"])
    joined = pairs.join(texts, "s64").join(answers.filter("main").select("e64", "ek", F.col("norm").alias("answer")), "e64")
    same = verify(joined, shared)
    if any(low for low, *_ in ranges):
        same = same.unionByName(block_pairs(scanned, answers, shared))
    same = cut(same.groupBy("sk", "ek").agg(F.min("edits").alias("edits"), F.max("cosine").alias("cosine")))
    return same, among(scanned.select("key", "sk"), "sk", same.select(F.col("sk").alias("key")).distinct()), held_rows.select("key", "ek")


def cross_split(train: DataFrame, train_key: str, train_text: str, held: DataFrame, held_key: str, held_text: str) -> DataFrame:
    """(train_key, held_key, edits, cosine) of all records that repeat.

    Texts repeat if they are the same or differ in at most one word in PART of
    the held text, as ``comparable_sql`` and ``tokens`` see them; held texts
    under five words (ten characters) never count. Null and empty texts repeat
    nothing. Several rows of a key count once.
    """
    same, members, held_members = _matched(train, train_key, train_text, held, held_key, held_text)
    out = same.join(members, "sk").withColumnRenamed("key", train_key)
    out = out.join(held_members.withColumnRenamed("key", held_key), "ek")
    return out.groupBy(train_key, held_key).agg(F.min("edits").alias("edits"), F.max("cosine").alias("cosine"))


def linked_classes(train: DataFrame, train_key: str, train_text: str, held: DataFrame, held_key: str, held_text: str) -> DataFrame:
    """(train_key, class_id, n_links): every training record that repeats held
    ones, with the class of its text and the number of records it repeats;
    copies are counted, not paired."""
    same, members, held_members = _matched(train, train_key, train_text, held, held_key, held_text)
    copies = held_members.distinct().groupBy("ek").agg(F.count(F.lit(1)).alias("n"))
    links = same.join(copies, "ek").groupBy("sk").agg(F.sum("n").alias("n_links"))
    return links.join(members.distinct(), "sk").select(F.col("key").alias(train_key), F.lower(F.hex("sk")).alias("class_id"), "n_links")


_SIDES = lambda spark, d: (table(spark, d, "mds_samples"), "sample_id", "response_text", table(spark, d, "eval_items"), "item_id", "answer")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_split(*_SIDES(spark, sf_dir)).select("sample_id", "item_id")


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeating training sample with its class and number of links."""
    return linked_classes(*_SIDES(spark, sf_dir))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated evaluation items and training samples per split and set."""
    items = table(spark, sf_dir, "eval_items").groupBy("item_id").agg(F.first("split").alias("split"), F.first(F.trim("set_name")).alias("set_name"))
    hits = cross_split(*_SIDES(spark, sf_dir)).join(items, "item_id")
    return hits.groupBy("split", "set_name").agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct("sample_id").alias("n_samples"), F.count_if(F.col("edits") == 0).alias("n_same"), F.count_if(F.col("edits") > 0).alias("n_near"))
