"""Shards of binary samples: codec, batch source and stream source.

Layout of a shard: a count n, n + 1 absolute offsets (32-bit little-endian),
then the samples; a sample is the 32-bit sizes of its variable-width columns
followed by the columns' bytes in order. Columns with a size in the index have
no size in the sample. Shards may be zstd-compressed.

``register(spark)`` makes the format "mds" available:
``spark.read.format("mds").option("columns", "task,language").load(dir)``.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, DataSourceStreamReader
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

FIXED = {"int": "<q", "int32": "<i", "int64": "<q", "uint32": "<I", "float32": "<f", "float64": "<d"}
TYPES = {"str": StringType(), "json": StringType(), "bytes": BinaryType()} | {k: LongType() for k in ("int", "int32", "int64", "uint32")} | {k: DoubleType() for k in ("float32", "float64")}


def decode_sample(data: bytes, names: list[str], encodings: list[str], sizes: list[int | None], want: set[str] | None = None) -> dict:
    """One sample; columns outside ``want`` are skipped unread."""
    variable = [i for i, s in enumerate(sizes) if s is None]
    head = struct.unpack_from(f"<{len(variable)}I", data)
    at, width = 4 * len(variable), dict(zip(variable, head))
    out = {}
    for i, (name, enc) in enumerate(zip(names, encodings)):
        n = sizes[i] if sizes[i] is not None else width[i]
        if want is None or name in want:
            raw = data[at : at + n]
            if len(raw) != n:
                raise EOFError(f"column {name} has {len(raw)} of {n} bytes")
            if enc in ("str", "json"):
                out[name] = raw.decode("utf-8")
            elif enc == "bytes":
                out[name] = raw
            elif enc in FIXED:
                out[name] = struct.unpack(FIXED[enc], raw)[0]
            else:
                raise ValueError(f"unknown encoding {enc}")
        at += n
    return out


def encode_sample(values: dict, names: list[str], encodings: list[str], sizes: list[int | None]) -> bytes:
    parts, head = [], []
    for name, enc, size in zip(names, encodings, sizes):
        v = values[name]
        raw = v.encode("utf-8") if enc in ("str", "json") else bytes(v) if enc == "bytes" else struct.pack(FIXED[enc], v)
        if size is None:
            head.append(len(raw))
        parts.append(raw)
    return struct.pack(f"<{len(head)}I", *head) + b"".join(parts)


def write_shards(folder: str, rows: list[dict], names: list[str], encodings: list[str], per_shard: int, zstd: bool = False) -> None:
    """Shards and index of a small list of rows (for tests and fixtures)."""
    import zstandard

    os.makedirs(folder, exist_ok=True)
    sizes = [struct.calcsize(FIXED[e]) if e in FIXED else None for e in encodings]
    entries = []
    for k in range(0, len(rows), per_shard):
        part = [encode_sample(r, names, encodings, sizes) for r in rows[k : k + per_shard]]
        offsets, at = [], 4 + 4 * (len(part) + 1)
        for p in [*part, b""]:
            offsets.append(at)
            at += len(p)
        raw = struct.pack(f"<{len(offsets) + 1}I", len(part), *offsets) + b"".join(part)
        name = f"shard.{len(entries):05d}.mds"
        entry = {"samples": len(part), "column_names": names, "column_encodings": encodings, "column_sizes": sizes, "raw_data": {"basename": name}, "zip_data": None}
        if zstd:
            name += ".zstd"
            entry["zip_data"] = {"basename": name}
            raw = zstandard.ZstdCompressor().compress(raw)
        with open(os.path.join(folder, name), "wb") as f:
            f.write(raw)
        entries.append(entry)
    with open(os.path.join(folder, "index.json"), "w") as f:
        json.dump({"shards": entries, "version": 2}, f)


def index_folders(path: str) -> list[str]:
    """Folders with an index: the path itself, or its sub-folders by length of
    name and name."""
    if os.path.exists(os.path.join(path, "index.json")):
        return [path]
    subs = [s for s in os.listdir(path) if os.path.exists(os.path.join(path, s, "index.json"))]
    return [os.path.join(path, s) for s in sorted(subs, key=lambda s: (len(s), s))]


def load_index(folder: str) -> list[dict]:
    with open(os.path.join(folder, "index.json")) as f:
        return json.load(f)["shards"]


def read_shard(folder: str, entry: dict, want: set[str] | None, first: int = 0, limit: int | None = None) -> Iterator[dict]:
    """Samples of a shard from ``first`` on; a compressed shard is read as a
    stream that stops after ``limit`` samples."""
    zipped = (entry.get("zip_data") or {}).get("basename")
    path = os.path.join(folder, zipped or entry["raw_data"]["basename"])
    sizes = entry.get("column_sizes") or [None] * len(entry["column_names"])
    with open(path, "rb") as f:
        if zipped:
            import zstandard

            f = zstandard.ZstdDecompressor().stream_reader(f)

        def exactly(n: int) -> bytes:
            out = b""
            while len(out) < n:
                more = f.read(n - len(out))
                if not more:
                    raise EOFError(f"{path}: {len(out)} of {n} bytes")
                out += more
            return out

        n = struct.unpack("<I", exactly(4))[0]
        offsets = struct.unpack(f"<{n + 1}I", exactly(4 * (n + 1)))
        stop = n if limit is None else min(n, first + limit)
        first = min(first, n)
        if zipped:  # a compressed stream is passed over, a raw shard is entered at its offset
            at = offsets[0]
            while at < offsets[first]:
                at += len(exactly(min(1 << 20, offsets[first] - at)))
        else:
            f.seek(offsets[first])
        for i in range(first, stop):
            yield decode_sample(exactly(offsets[i + 1] - offsets[i]), entry["column_names"], entry["column_encodings"], sizes, want)


class ShardPartition(InputPartition):
    def __init__(self, folder: str, entry: dict, number: int):
        super().__init__(number)
        self.folder, self.entry, self.number = folder, entry, number


class ShardReader(DataSourceReader):
    """One task a shard; only the wanted columns are decoded."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.limit = int(options["limit"]) if "limit" in options else None

    def partitions(self):
        every = [(f, e) for f in index_folders(self.path) for e in load_index(f)]
        return [ShardPartition(f, e, i) for i, (f, e) in enumerate(every)]

    def read(self, partition):
        names = [f.name for f in self.schema.fields if f.name not in ("shard", "row")]
        for i, sample in enumerate(read_shard(partition.folder, partition.entry, set(names), 0, self.limit)):
            yield (*[sample.get(n) for n in names], partition.number, i)


class ShardRange(InputPartition):
    def __init__(self, folder: str, entry: dict, number: int, first: int, limit: int):
        super().__init__(number)
        self.folder, self.entry, self.number, self.first, self.limit = folder, entry, number, first, limit


class ShardStream(DataSourceStreamReader):
    """Shards as a stream; the offset is (shard, row), so a query goes on exactly
    where its checkpoint says.

    A batch takes all shards that are there; executors read it in ranges of
    ``batch`` rows, each from its offset in the shard. Only the index is read on
    the driver.
    """

    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema, self.batch = options["path"], schema, int(options.get("batch", "1000"))

    def initialOffset(self) -> dict:
        return {"shard": 0, "row": 0}

    def _every(self) -> list[tuple[str, dict]]:
        return [(f, e) for f in index_folders(self.path) for e in load_index(f)]

    def latestOffset(self) -> dict:
        return {"shard": len(self._every()), "row": 0}

    def partitions(self, start: dict, end: dict) -> list[ShardRange]:
        out = []
        for number, (folder, entry) in enumerate(self._every()):
            first = start["row"] if number == start["shard"] else 0
            stop = end["row"] if number == end["shard"] else entry["samples"]
            if start["shard"] <= number <= end["shard"]:
                out += [ShardRange(folder, entry, number, at, min(self.batch, stop - at)) for at in range(first, stop, self.batch)]
        return out

    def read(self, partition: ShardRange):
        names = [f.name for f in self.schema.fields if f.name not in ("shard", "row")]
        for i, sample in enumerate(read_shard(partition.folder, partition.entry, set(names), partition.first, partition.limit)):
            yield (*[sample.get(n) for n in names], partition.number, partition.first + i)

    def commit(self, end: dict) -> None:
        pass


class MdsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mds"

    def schema(self) -> StructType:
        """All columns of all shards (a shard without one gives null), with the
        shard's number and the row in it."""
        want = [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else None
        kinds: dict[str, set[str]] = {}
        for folder in index_folders(self.options["path"]):
            for e in load_index(folder):
                for n, k in zip(e["column_names"], e["column_encodings"]):
                    kinds.setdefault(n, set()).add(k)
        for n, k in kinds.items():
            if any(x not in TYPES for x in k):
                raise ValueError(f"unknown encoding of {n}: {sorted(k)}")
        fields = [StructField(n, TYPES[next(iter(kinds[n]))], True) for n in (want or kinds) if n in kinds]
        return StructType([*fields, StructField("shard", LongType()), StructField("row", LongType())])

    def reader(self, schema: StructType):
        return ShardReader(self.options, schema)

    def streamReader(self, schema: StructType):
        return ShardStream(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MdsSource)
