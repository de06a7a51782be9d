import pytest
from pyspark.sql import functions as F

from undertone.sources import mds
from undertone.streaming import progress

ROWS = [{"text": f"t{i} 你", "audio": bytes([i]), "n": i * 10} for i in range(7)]


@pytest.fixture
def folder(tmp_path):
    mds.write_shards(str(tmp_path / "2"), ROWS, ["text", "audio", "n"], ["str", "bytes", "int"], 3, zstd=True)
    mds.write_shards(str(tmp_path / "10"), [{"text": "z", "audio": b""}], ["text", "audio"], ["str", "bytes"], 3)
    return str(tmp_path)


def test_scan_prunes_and_merges(spark, folder):
    mds.register(spark)
    df = spark.read.format("mds").load(folder)
    got = df.orderBy("shard", "row").collect()
    assert [(r["text"], r["n"]) for r in got] == [(r["text"], r["n"]) for r in ROWS] + [("z", None)]
    slim = spark.read.format("mds").option("columns", "n").load(folder)
    assert slim.columns == ["n", "shard", "row"] and slim.agg(F.sum("n")).first()[0] == 210
    assert spark.read.format("mds").option("limit", "1").load(folder).count() == 4


def test_folders_and_errors(tmp_path, folder):
    assert [f.rsplit("/", 1)[1] for f in mds.index_folders(folder)] == ["2", "10"]
    with pytest.raises(EOFError):
        mds.decode_sample(mds.encode_sample({"a": "xyz"}, ["a"], ["str"], [None])[:-1], ["a"], ["str"], [None])
    with pytest.raises(ValueError):
        mds.decode_sample(b"\x01\x00\x00\x00x", ["a"], ["pkl"], [None])


def test_ranges_of_a_shard(folder):
    s = mds.ShardStream({"path": folder, "batch": "2"}, mds.MdsSource({"path": folder}).schema())
    seen = lambda a, b: [r[0] for p in s.partitions(a, b) for r in s.read(p)]
    assert s.latestOffset() == {"shard": 4, "row": 0}
    assert seen(s.initialOffset(), s.latestOffset()) == [r["text"] for r in ROWS] + ["z"]
    assert seen({"shard": 0, "row": 1}, {"shard": 1, "row": 1}) == ["t1 你", "t2 你", "t3 你"]
    assert [p.limit for p in s.partitions({"shard": 0, "row": 0}, {"shard": 1, "row": 0})] == [2, 1]


def test_raw_shards_are_entered_at_offsets(tmp_path):
    mds.write_shards(str(tmp_path / "raw"), ROWS, ["text", "audio", "n"], ["str", "bytes", "int"], 7)
    (entry,) = mds.load_index(str(tmp_path / "raw"))
    assert [r["text"] for r in mds.read_shard(str(tmp_path / "raw"), entry, None, 5, 9)] == ["t5 你", "t6 你"]
    assert list(mds.read_shard(str(tmp_path / "raw"), entry, None, 7, 9)) == []


def test_stream_resumes(spark, folder, tmp_path):
    """A query that is started again reads the new shards only."""
    mds.register(spark)

    def run():
        q = spark.readStream.format("mds").option("path", folder).option("batch", "2").load().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = sorted([r["text"] for r in ROWS] + ["z"])
    assert run() == first and run() == first
    mds.write_shards(f"{folder}/300", [{"text": "later", "audio": b""}], ["text", "audio"], ["str", "bytes"], 3)
    assert run() == sorted([*first, "later"])


def test_predictions_fold_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    make = lambda rows: spark.createDataFrame(rows, "idx long, chunk int, text string")
    make([(1, 0, "a"), (1, 0, "a"), (2, 0, "b")]).coalesce(1).write.parquet(src)
    for extra in ([(2, 0, "again"), (3, 0, "c")], []):
        progress.fold_predictions(progress.epoch_stream(spark, src, make([]).schema), ["idx", "chunk"], out, ck).awaitTermination()
        if extra:
            make(extra).coalesce(1).write.mode("append").parquet(src)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/batch=*").select("idx", "text").collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_final_file_is_whole_and_ordered(spark, tmp_path):
    parts, final = str(tmp_path / "parts"), str(tmp_path / "final")
    for k, rows in enumerate(([(3, 0, "c"), (1, 0, "a")], [(2, 0, "b")])):
        spark.createDataFrame(rows, "idx long, chunk int, text string").write.parquet(f"{parts}/batch={k}")
    progress.finalise(spark, parts, final, ["idx", "chunk"])
    assert [r["text"] for r in spark.read.parquet(final).collect()] == ["a", "b", "c"]
    import os

    assert not os.path.exists(parts) and not os.path.exists(final + ".tmp")
