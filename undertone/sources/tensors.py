"""Adapter tensors in safetensors files as rows (name, row, vec).

A file is a header length (64-bit little-endian), a JSON header with type,
shape and byte range of every tensor, and the bytes.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

KINDS = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4"}


def encode(tensors: dict[str, np.ndarray]) -> bytes:
    head, parts, at = {}, [], 0
    for name, t in tensors.items():
        raw = np.ascontiguousarray(t, "<f4").tobytes()
        head[name] = {"dtype": "F32", "shape": list(t.shape), "data_offsets": [at, at + len(raw)]}
        parts.append(raw)
        at += len(raw)
    h = json.dumps(head).encode()
    return struct.pack("<Q", len(h)) + h + b"".join(parts)


def decode(data: bytes) -> Iterator[tuple[str, int, np.ndarray]]:
    """(name, row, values) of every matrix; a vector is one row. bfloat16 is
    widened; other kinds raise ValueError."""
    n = struct.unpack_from("<Q", data)[0]
    for name, t in json.loads(data[8 : 8 + n]).items():
        if name == "__metadata__":
            continue
        a, b = (8 + n + x for x in t["data_offsets"])
        if t["dtype"] == "BF16":
            v = (np.frombuffer(data[a:b], "<u2").astype("<u4") << 16).view("<f4")
        elif t["dtype"] in KINDS:
            v = np.frombuffer(data[a:b], KINDS[t["dtype"]])
        else:
            raise ValueError(f"{name}: kind {t['dtype']}")
        shape = t["shape"] or [1]
        for i, row in enumerate(v.astype(float).reshape(shape[0] if len(shape) > 1 else 1, -1)):
            yield name, i, row


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, row, vec) of all files under ``path``, one task a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = list(decode(data))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows)), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))], names=["file", "name", "row", "vec"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.safetensors").load(path)
    return files.select(F.col("path"), "content").mapInArrow(run, "file string, name string, row long, vec array<double>")
