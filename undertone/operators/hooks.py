"""Extension points of rows, streams and evaluation, and what only training does."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


@dataclass(frozen=True)
class StreamConfig:
    """How a stream of samples is drawn."""

    shuffle: bool = True
    sampling: str = "balanced"
    seed: int = 9176
    augment: bool = False
    dropout: float = 0.0

    def for_validation(self) -> StreamConfig:
        """In order, fixed sampling, nothing changed or dropped."""
        return dataclasses.replace(self, shuffle=False, sampling="fixed", augment=False, dropout=0.0)


def register_processor(name: str):
    """A processor plug-in: a function of the loaded rows of a set."""

    def add(f):
        PROCESSORS[name] = f
        return f

    return add


@register_processor("none")
@register_processor("base")
def _as_loaded(df: DataFrame) -> DataFrame:
    return df


def process(df: DataFrame, name: str | None) -> DataFrame:
    """Rows of a set through its processor; an unknown name is an error."""
    try:
        return PROCESSORS[name or "none"](df)
    except KeyError:
        raise ValueError(f"unknown processor {name}; known: {sorted(PROCESSORS)}") from None


def with_transform(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The stream's ``transform`` hook over all rows as a DataFrame step."""
    return df if transform is None else transform(df)


def with_augment(df: DataFrame, audio: str, text: str, task: str, augment: Callable[[bytes, str, str], tuple[bytes, str]] | None, config: StreamConfig) -> DataFrame:
    """The ``augment(bytes, text, task)`` hook in Arrow batches: new audio and
    text; only in training, and only for rows with audio. Nulls stay as they are
    where the hook isn't called; other columns of any name pass through."""
    if augment is None or not config.augment:
        return df
    at = [df.columns.index(c) for c in (audio, text, task)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(a, t) if not a else augment(a, t, k) for a, t, k in zip(*(b.column(i).to_pylist() for i in at))]
            columns = list(b.columns)
            columns[at[0]] = pa.array([m[0] for m in made], b.schema.field(at[0]).type)
            columns[at[1]] = pa.array([m[1] for m in made], b.schema.field(at[1]).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]))


def text_of(schema: T.StructType, name: str) -> Column:
    """A text that is a column or a ``text`` field of one; null without."""
    kind = {f.name: f.dataType for f in schema.fields}.get(name)
    if isinstance(kind, T.StructType):
        return F.col(f"`{name}`.text") if "text" in kind.names else F.lit(None).cast("string")
    return F.lit(None).cast("string") if kind is None else F.col(f"`{name}`")


def audio_of(schema: T.StructType) -> Column:
    """Audio bytes of nested or flat rows: ``context.audio`` before
    ``audio``, each as bytes or a struct with ``bytes``."""

    def find(kind: T.DataType | None, path: str) -> Column | None:
        if isinstance(kind, T.BinaryType):
            return F.col(path)
        if isinstance(kind, T.StructType) and "bytes" in kind.names:
            return F.col(f"{path}.bytes")
        return None

    kinds = {f.name: f.dataType for f in schema.fields}
    context = kinds.get("context")
    nested = find({f.name: f.dataType for f in context.fields}.get("audio"), "context.audio") if isinstance(context, T.StructType) else None
    places = [c for c in (nested, find(kinds.get("audio"), "audio")) if c is not None]
    return F.coalesce(*places) if places else F.lit(None).cast("binary")


def mix_keys(rows: DataFrame, specs: DataFrame, name: str = "name", seconds: str = "duration") -> DataFrame:
    """``prompt_type`` and ``max_seconds`` of the mix entry on its rows.

    Rows longer than their entry's limit go; a null limit or duration limits
    nothing, a null or unlisted prompt type is the default.
    """
    keys = specs.groupBy(name).agg(F.min("max_seconds").alias("__max"), F.min("prompt_type").alias("prompt_type"))
    j = rows.drop("prompt_type").join(keys, name, "left")
    return j.filter(F.coalesce(F.col(seconds) <= F.col("__max"), F.lit(True))).withColumn("prompt_type", F.coalesce("prompt_type", F.lit("default"))).drop("__max")


def missing_ranks(parts: DataFrame, rank: str, world: int) -> DataFrame:
    """The barrier before a merge: ranks of ``world`` that left no part yet."""
    return parts.sparkSession.range(world).select(F.col("id").cast("int").alias("rank")).join(parts.select(F.col(rank).cast("int").alias("rank")).distinct(), "rank", "left_anti")
