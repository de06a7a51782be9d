"""Problem 9: evaluation texts leaking into training text.

The normalised test items become one generalised suffix automaton whose
alphabet are words (characters for items in Chinese). Training tokens are
streamed through it; the longest match that ends at each token tells which
items have a run of the required length there, and which span of the text it
is. Spans over a length limit are removed, texts over a coverage limit dropped.

The automaton is a handful of integer arrays: a state keeps its first
transition in place, only further ones are looked up. It is built once on the
driver from at most BLOCK_CHARS characters of items and broadcast as buffers;
more items make more automata, each of which the normalised texts (written once)
pass.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from undertone.llm.arrow import cut, duckdb_project, schema_with
from undertone.llm.lookalike import canonical_sql
from undertone.sources.tables import table

#: Characters of items in one automaton (some 300 MB in a worker at the most).
BLOCK_CHARS = 4_000_000
WORDS, CHARS = 10, 20
HAN = "[㐀-䶿一-鿿豈-﫿]"


def words_sql(column: str, chars: set[str]) -> str:
    """DuckDB expression: canonical lower-case text, other signs as one space."""
    e = f"lower({canonical_sql(column, chars, lines=False)})"
    if chars & set("'\u2019`\u00b4"):
        e = f"translate({e}, '''\u2019`\u00b4', '')"
    return rf"trim(regexp_replace({e}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))"


class SuffixAutomaton:
    """Generalised suffix automaton over token sequences, in arrays.

    Of every state: length, link, first transition (token, target) and the head
    of a chain of its further ones; those are also in ``more`` under
    state << 32 | token. ``marks`` are the states that prefixes of items end in.
    """

    def __init__(self, least: int):
        self.least, self.vocabulary = least, {}
        self.len, self.link, self.token, self.to, self.head = (array("i", [x]) for x in (0, -1, -1, -1, -1))
        self.edge_token, self.edge_to, self.edge_next = array("i"), array("i"), array("i")
        self.more: dict[int, int] = {}
        self.marks, self.marked = array("i"), array("i")

    def target(self, state: int, token: int) -> int:
        return self.to[state] if self.token[state] == token else self.more.get(state << 32 | token, -1)

    def _point(self, state: int, token: int, to: int) -> None:
        """Set a transition, new or known."""
        if self.token[state] in (-1, token):
            self.token[state], self.to[state] = token, to
            return
        key = state << 32 | token
        if key not in self.more:
            self.edge_token.append(token)
            self.edge_next.append(self.head[state])
            self.edge_to.append(0)
            self.head[state] = len(self.edge_token) - 1
        self.more[key] = to

    def _state(self, length: int, link: int) -> int:
        for column, value in ((self.len, length), (self.link, link), (self.token, -1), (self.to, -1), (self.head, -1)):
            column.append(value)
        return len(self.len) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q])
        if self.token[q] >= 0:
            self._point(clone, self.token[q], self.to[q])
        edge = self.head[q]
        while edge >= 0:
            self._point(clone, self.edge_token[edge], self.more[q << 32 | self.edge_token[edge]])
            edge = self.edge_next[edge]
        self.link[q] = clone
        while p >= 0 and self.target(p, token) == q:
            self._point(p, token, clone)
            p = self.link[p]
        return clone

    def add(self, tokens, number: int) -> None:
        """Add the sequence of item ``number``."""
        last = 0
        for word in tokens:
            token = self.vocabulary.setdefault(word, len(self.vocabulary))
            q = self.target(last, token)
            if q >= 0:
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, q, token)
            else:
                p, cur = last, self._state(self.len[last] + 1, 0)
                while p >= 0 and self.target(p, token) < 0:
                    self._point(p, token, cur)
                    p = self.link[p]
                if p >= 0:
                    q = self.target(p, token)
                    self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, token)
                last = cur
            self.marks.append(last)
            self.marked.append(number)

    def frozen(self) -> tuple:
        """Buffers for a ``Stream``: with every state goes the shortest of its
        suffixes that is long enough, with that suffix the items that hold it."""
        length, link = np.array(self.len, np.int32), np.array(self.link, np.int32)
        up = np.where((link >= 0) & (length[link] >= self.least), link, np.arange(len(length)))
        while (up[up] != up).any():
            up = up[up]
        up[length < self.least] = -1
        holder, item = up[np.array(self.marks, np.int64)], np.array(self.marked, np.int64)
        pairs = np.unique(holder[holder >= 0].astype(np.int64) << 32 | item[holder >= 0])
        keys = np.fromiter(self.more.keys(), np.int64, len(self.more))
        targets = np.fromiter(self.more.values(), np.int32, len(self.more))
        return self.least, list(self.vocabulary), length, link, np.array(self.token, np.int32), np.array(self.to, np.int32), keys, targets, up.astype(np.int32), pairs


class Stream:
    """Streams token sequences through a frozen automaton."""

    def __init__(self, frozen: tuple):
        self.least, words, length, link, token, to, keys, targets, up, pairs = frozen
        self.vocabulary = {w: i for i, w in enumerate(words)}
        self.length, self.link, self.token, self.to, self.up = (array("i", x.tobytes()) for x in (length, link, token, to, up))
        self.more = dict(zip(keys.tolist(), targets.tolist()))
        self.holders, self.items = pairs >> 32, pairs & 0xFFFFFFFF

    def __bool__(self) -> bool:
        return len(self.items) > 0

    def read(self, tokens) -> tuple[set[int], list[list[int]]]:
        """Numbers of the items that share a run of at least ``least`` tokens,
        and the [start, end) spans of such runs, merged where they touch."""
        known, length, link, token, to, more, least = self.vocabulary.get, self.length, self.link, self.token, self.to, self.more, self.least
        met: set[int] = set()
        spans: list[list[int]] = []
        state = run = 0
        for at, word in enumerate(tokens):
            t = known(word)
            if t is None:
                state = run = 0
                continue
            while True:
                q = to[state] if token[state] == t else more.get(state << 32 | t, -1)
                if q >= 0 or not state:
                    break
                state = link[state]
                run = length[state]
            if q < 0:
                run = 0
                continue
            state = q
            run += 1
            if run >= least:
                met.add(self.up[state])
                if spans and at - run + 1 <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], at - run + 1)
                    spans[-1][1] = at + 1
                else:
                    spans.append([at - run + 1, at + 1])
        items: set[int] = set()
        for holder in met:
            a, b = np.searchsorted(self.holders, [holder, holder + 1])
            items.update(self.items[a:b].tolist())
        return items, spans


def _blocks(items: DataFrame, item_key: str, item_text: str, item_lang: str, words: int, chars: int) -> Iterator[tuple[list, tuple, tuple]]:
    """(keys, automaton of words, automaton of characters) of each block of items.

    Items are dealt by hash to as many blocks as their characters need; the
    driver holds one block at a time.
    """
    source = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("t"), (F.lower(F.trim(F.coalesce(F.col(item_lang), F.lit("")))).startswith("zh")).alias("han")).filter("item is not null and t is not null")
    norm = cut(duckdb_project(source, {"norm": lambda signs: words_sql('"t"', signs)}, ["item", "han"], "t").filter("norm <> ''").distinct())
    total = norm.agg(F.sum(F.length("norm"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS))
    for block in range(n):
        rows = norm.filter(F.pmod(F.xxhash64("item", "norm"), F.lit(n)) == block).collect()
        by_word, by_char = SuffixAutomaton(words), SuffixAutomaton(chars)
        for number, r in enumerate(rows):
            if r["han"]:
                by_char.add(r["norm"].replace(" ", ""), number)
            else:
                by_word.add(r["norm"].split(" "), number)
        yield [r["item"] for r in rows], by_word.frozen(), by_char.frozen()


def leaked(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, item_lang: str, words: int = WORDS, chars: int = CHARS) -> DataFrame:
    """(doc_key, item_key) of documents holding a run of an item.

    A run is ``words`` consecutive words, or ``chars`` consecutive characters
    for an item whose language is Chinese; case, punctuation, spacing and
    look-alike characters are ignored. Null and empty texts hold nothing; items
    shorter than a run can't be found. Any number of items goes through in
    blocks of BLOCK_CHARS characters.
    """
    slim = docs.select(F.col(doc_key).alias("doc"), F.col(doc_text).alias("t")).filter("doc is not null and t is not null")
    text = duckdb_project(slim, {"norm": lambda signs: words_sql('"t"', signs)}, ["doc"], "t")
    schema = schema_with(slim, ["doc"], item=items.schema[item_key].dataType)
    blocks = list(_blocks(items, item_key, item_text, item_lang, words, chars))
    if len(blocks) > 1:
        text = cut(text)
    result = None
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            keys, *frozen = shared.value
            by_word, by_char = map(Stream, frozen)
            han = re.compile(HAN)
            for batch in batches:
                docs_out, items_out = [], []
                for doc, norm in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    found = by_word.read(norm.split(" "))[0] if by_word else set()
                    out = {keys[i] for i in found}
                    if by_char and han.search(norm):
                        out.update(keys[i] for i in by_char.read(norm.replace(" ", ""))[0])
                    docs_out += [doc] * len(out)
                    items_out += out
                if docs_out:
                    yield pa.RecordBatch.from_arrays([pa.array(docs_out, batch.schema.field(0).type), pa.array(items_out)], names=["doc", "item"])

        part = text.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result.distinct().select(F.col("doc").alias(doc_key), F.col("item").alias(item_key))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the merged [start, end) spans, one space in place of each."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            out.append(text[at:a])
        at = max(at, b)
    out.append(text[at:])
    return " ".join(x for x in (p.strip() for p in out) if x)


def remove_leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, item_lang: str, max_run: int = WORDS - 1, max_run_chars: int = CHARS - 1, max_coverage: float = 0.5) -> DataFrame:
    """(doc_key, text, n_spans, n_tokens, n_leaked, coverage, kept) of every document.

    Spans of more than ``max_run`` consecutive words (``max_run_chars``
    characters of Chinese items) shared with an item are cut out of the text;
    ``coverage`` is the share of the text's words (or of its characters, if that
    is more) inside such spans, n_tokens and n_leaked count words. A document of
    more than ``max_coverage`` is dropped: its text is null and ``kept`` false.
    Words lie between blanks of the text, so a span begins and ends with such
    words; inside a word of Chinese it begins and ends with characters where
    they map one to one. A null text stays null and is kept. Rows are kept as
    they come, repeated ones included.
    """
    slim = docs.select(F.col(doc_key).alias("doc"), F.col(doc_text).alias("t"))
    pieces = r"""regexp_extract_all("t", '\S+')"""
    parts = duckdb_project(slim, {"norms": lambda signs: f"array_to_string(list_transform({pieces}, lambda x: {words_sql('x', signs)}), chr(1))"}, ["doc", "t"], "t")
    schema = schema_with(slim, ["doc"], text=T.StringType(), n_spans=T.IntegerType(), n_tokens=T.IntegerType(), n_leaked=T.IntegerType(), coverage=T.DoubleType(), kept=T.BooleanType())
    shared = docs.sparkSession.sparkContext.broadcast([b[1:] for b in _blocks(items, item_key, item_text, item_lang, max_run + 1, max_run_chars + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = [tuple(map(Stream, b)) for b in shared.value]
        han, piece = re.compile(HAN), re.compile(r"[^\t\n\f\r ]+")
        for batch in batches:
            rows = [(doc, *_cleaned(t, norms, streams, han, piece, max_coverage)) for doc, t, norms in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames())

    return parts.mapInArrow(run, schema).withColumnRenamed("doc", doc_key)


def _cleaned(t: str | None, norms: str | None, streams: list, han: re.Pattern, piece: re.Pattern, max_coverage: float) -> tuple:
    if t is None:
        return None, 0, 0, 0, 0.0, True
    words, of, characters, places = [], [], [], []
    for at, norm in zip(piece.finditer(t), norms.split("\x01")):
        ws = norm.split(" ") if norm else []
        words += ws
        of += [at.span()] * len(ws)
        if han.search(norm):
            joined = "".join(ws)
            letters = [k for k, ch in enumerate(at[0]) if ch.isalnum()]
            fit = len(letters) == len(joined)
            characters.append(joined)
            places += [(at.start() + k, at.start() + k + 1) for k in letters] if fit else [at.span()] * len(joined)
        else:
            characters += ws
            places += [at.span()] * sum(map(len, ws))
    characters = "".join(characters)
    taken, share, leaked_words = [], 0.0, 0
    for which, (tokens, where) in enumerate(((words, of), (characters, places))):
        if which and not han.search(characters):
            continue
        inside = set()
        for pair in streams:
            if pair[which]:
                for a, b in pair[which].read(tokens)[1]:
                    taken.append((where[a][0], where[b - 1][1]))
                    inside.update(range(a, b))
        share = max(share, len(inside) / max(1, len(tokens)))
        leaked_words = leaked_words if which else len(inside)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    kept = share <= max_coverage
    return (without_spans(t, merged) if merged else t) if kept else None, len(merged), len(words), leaked_words, share, kept


_ARGS = lambda spark, d: (table(spark, d, "documents"), "doc_id", "text", table(spark, d, "heldout_passages"), "passage_id", "text", "lang")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(*_ARGS(spark, sf_dir))


def p9_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaked spans cut out, or dropped."""
    return remove_leaks(*_ARGS(spark, sf_dir))


def p9_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and leaked words of documents that leak word runs."""
    return remove_leaks(*_ARGS(spark, sf_dir)).filter("n_leaked > 0").select("doc_id", "n_tokens", "n_leaked").distinct()


def p9_by_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked test items and documents holding them, per evaluation set."""
    sets = table(spark, sf_dir, "heldout_passages").select("passage_id", "set_name")
    hits = p9_found(spark, sf_dir).join(sets, "passage_id")
    return hits.groupBy("set_name").agg(F.countDistinct("passage_id").alias("n_items"), F.countDistinct("doc_id").alias("n_docs"))
