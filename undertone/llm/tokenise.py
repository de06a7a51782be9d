"""Problem 8: encoding of the corpus with a public byte-level tokenizer.

Encoding is a monoid: a text is cut in halves down to leaves, the leaves are
encoded, and neighbours are joined up the tree. Where two parts meet only a
window round the seam is encoded again; it grows until both its ends lie at
positions where the tokenizer's pre-splitting must break whatever stands
further out, so the tokens outside are those of the whole text. Decoding
concatenates the bytes of the parts up the same tree.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from undertone.llm.arrow import schema_with
from undertone.sources.tables import table

#: Characters of a leaf. Nearly every document is longer, so nearly every one is
#: joined up the tree; the ids do not depend on it.
LEAF_CHARS = 256


def default_path() -> str:
    """Place of the public vocabulary byte_bpe_50k on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class _Kinds(dict):
    """Kind of a character: 0 blank, 1 letter, 2 number, 3 other; learnt once."""

    def __missing__(self, ch: str) -> int:
        kind = 0 if ch.isspace() or ch in "\x1c\x1d\x1e\x1f\x85" else {"L": 1, "N": 2}.get(unicodedata.category(ch)[0], 3)
        self[ch] = kind
        return kind


_KIND = _Kinds()


def _breaks(text: str, i: int) -> bool:
    """Whether pre-splitting breaks before ``text[i]`` whatever surrounds it.

    No pre-token holds a letter or a number followed by another kind, or an
    other sign followed by a blank or a number. An other sign before a letter
    may be a contraction, and a blank may belong to what follows, so these are
    not sure.
    """
    a, b = _KIND[text[i - 1]], _KIND[text[i]]
    return a in (1, 2) and a != b or a == 3 and b in (0, 2)


class TreeEncoder:
    def __init__(self, path: str, pattern: str, leaf: int = LEAF_CHARS):
        self.enc, self.leaf = _encoder(path, pattern), leaf
        self.size = self.enc.decode_single_token_bytes

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.enc.encode_ordinary(text)
        return self._tree(text, 0, len(text))

    def _tree(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self.enc.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self._tree(text, lo, mid), self._tree(text, mid, hi))

    def join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[lo:hi] from those of its halves at ``mid``."""
        reach, a, b = 16, lo, hi
        while True:
            start, stop = max(lo, mid - reach), min(hi, mid + reach)
            a = next((i for i in range(mid - 1, start, -1) if _breaks(text, i)), lo if start == lo else -1)
            b = next((i for i in range(mid + 1, stop) if _breaks(text, i)), hi if stop == hi else -1)
            if a >= 0 and b >= 0:
                break
            reach *= 2
        keep = self._cut(left, len(text[a:mid].encode()), from_end=True)
        skip = self._cut(right, len(text[mid:b].encode()), from_end=False)
        return left[:keep] + self.enc.encode_ordinary(text[a:b]) + right[skip:]

    def _cut(self, ids: list[int], n: int, from_end: bool) -> int:
        """Index that leaves ``n`` bytes of ``ids`` on the seam's side."""
        i = len(ids) if from_end else 0
        while n > 0:
            if from_end:
                i -= 1
                n -= len(self.size(ids[i]))
            else:
                n -= len(self.size(ids[i]))
                i += 1
        if n:
            raise AssertionError("a seam window ends inside a token")
        return i

    def decode(self, ids: list[int]) -> str:
        def tree(lo: int, hi: int) -> bytes:
            if hi - lo <= self.leaf:
                return b"".join(map(self.size, ids[lo:hi]))
            mid = (lo + hi) // 2
            return tree(lo, mid) + tree(mid, hi)

        return tree(0, len(ids)).decode("utf-8", "replace")


def encode_column(df: DataFrame, text: str, key: str, path: str | None = None, leaf: int = LEAF_CHARS) -> DataFrame:
    """(key, ids): the token ids of every text, without special tokens.

    A null text has null ids, an empty text an empty list; strings of special
    tokens inside a text are ordinary text. One pass, no shuffle.
    """
    import public_tokenizers

    path, pattern = path or default_path(), public_tokenizers.PATTERN
    slim = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("__text" if key != "__text" else "__text_"))
    schema = schema_with(slim, [key], ids=T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        coder = TreeEncoder(path, pattern, leaf)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [None if t is None else coder.encode(t) for t in texts]
            sizes = np.fromiter((0 if x is None else len(x) for x in ids), np.int32, len(ids))
            offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
            flat = np.empty(int(offsets[-1]), np.int32)
            for k, x in enumerate(ids):
                if x:
                    flat[offsets[k] : offsets[k + 1]] = x
            mask = pa.array([x is None for x in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=mask)], names=[key, "ids"])

    return slim.mapInArrow(run, schema)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_column(table(spark, sf_dir, "documents"), "text", "doc_id")


def p8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, texts and mean tokens a text by source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = encode_column(docs.withColumn("k", F.struct("doc_id", "source")), "text", "k")
    return sized.groupBy(F.col("k.source").alias("source")).agg(F.count("ids").alias("n_texts"), F.coalesce(F.sum(F.when(F.col("ids").isNotNull(), F.size("ids"))), F.lit(0)).cast("long").alias("n_tokens"))
