"""Arrow-side helpers: DuckDB expressions over Arrow batches, id columns."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def _connection():
    """One embedded DuckDB per Python worker, single-threaded and bounded."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "200MB", "preserve_insertion_order": "true"})
    return con


def schema_with(df: DataFrame, keep: list[str], **extra: T.DataType) -> T.StructType:
    """The fields ``keep`` of ``df`` and ``extra`` ones, all of them nullable."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return T.StructType([T.StructField(c, types[c], True) for c in keep] + [T.StructField(c, t, True) for c, t in extra.items()])


def duckdb_project(df: DataFrame, exprs: dict[str, Callable[[set[str]], str]], keep: list[str], text: str) -> DataFrame:
    """Evaluate DuckDB string expressions over every Arrow batch of ``df``.

    An expression is made for each batch from the set of characters that the
    batch's column ``text`` holds, so tables and steps for characters that are
    not there are left out. The embedded engine sees the batch as the relation
    ``batch``; columns in ``keep`` pass through. No shuffle, no row leaves its
    partition.
    """
    schema = schema_with(df, keep, **{n: T.StringType() for n in exprs})
    at = df.columns.index(text)
    columns = ", ".join(f'"{c}"' for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connection()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chars = set().union(*(t for t in batch.column(at).to_pylist() if t))
            con.register("batch", pa.Table.from_batches([batch]))
            made = ", ".join(f'{e(chars)} AS "{n}"' for n, e in exprs.items())
            out = con.sql(f"SELECT {columns + ', ' if columns else ''}{made} FROM batch").to_arrow_table()
            con.unregister("batch")
            yield from out.combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder and read from there.

    For results that several later steps read. The folder is the session's
    spark.checkpoint.dir; only a local session without one (as in tests) gets
    its own, on a cluster a missing folder is an error.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="undertone_checkpoint_"))
    return df.checkpoint()


def fits(df: DataFrame, limit: int, columns: list[str]) -> list | None:
    """The rows of ``df`` if there are at most ``limit`` of them, else None.

    Reads ``limit + 1`` rows at most, so the driver never holds more.
    """
    rows = df.select(*columns).limit(limit + 1).collect()
    return None if len(rows) > limit else rows


def key128(col) -> list:
    """Two independent 64-bit hashes of a column, as columns k1 and k2."""
    return [F.xxhash64(col).alias("k1"), F.xxhash64(F.lit("second"), col).alias("k2")]
