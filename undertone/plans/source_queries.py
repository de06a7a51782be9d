"""Sources: the binary sample codec over records (inventory 2.1)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from undertone.plans.base import query
from undertone.sources.tables import table


@query("mds_decode", "SELECT record_id, CASE WHEN rtrim(payload) LIKE '%}' THEN 'ok' ELSE 'null or cut' END AS state, octet_length(encode(coalesce(payload, '')))::bigint AS n_bytes, record_id * 2 AS twice FROM shard_records")
def mds_decode(spark, d):
    """Records through the sample layout and back: a text column, a
    bytes column and a fixed-width one."""
    names, kinds, sizes = ["payload", "raw", "twice"], ["str", "bytes", "int"], [None, None, 8]
    r = table(spark, d, "shard_records").select("record_id", F.coalesce("payload", F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from undertone.sources.mds import decode_sample, encode_sample

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            back = [decode_sample(encode_sample({"payload": t, "raw": t.encode(), "twice": 2 * i}, names, kinds, sizes), names, kinds, sizes) for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x["payload"] for x in back]), pa.array([len(x["raw"]) for x in back], pa.int64()), pa.array([x["twice"] for x in back], pa.int64())], names=["record_id", "payload", "n_bytes", "twice"])

    out = r.mapInArrow(run, "record_id long, payload string, n_bytes long, twice long")
    return out.select("record_id", F.when(F.rtrim("payload").endswith("}"), "ok").otherwise("null or cut").alias("state"), "n_bytes", "twice")
