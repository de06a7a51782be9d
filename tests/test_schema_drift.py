import datetime as dt

from undertone.operators import schema_drift as sd

SCHEMA = "shard_id long, dataset string, subdir string, shard_no int, column_names array<string>, column_encodings array<string>, written_at timestamp, indexed_at timestamp"


def day(k):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=9 * k)


def index(spark, lists, dataset="d"):
    rows = [(i + 1, dataset, "0", i, n, e, day(i), day(i)) for i, (n, e) in enumerate(lists)]
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return {tuple(r) for r in sd.changes(df).collect()}


def test_kinds_of_change(spark):
    df = index(
        spark,
        [
            (["a", "b"], ["str", "str"]),
            ([" A ", "c"], ["str", "str"]),
            (["c", "a"], ["str", "str"]),
            (["c", "a", "n"], ["int", "str", "int"]),
            (["c", "a"], ["int", "str"]),
            (["x", "y"], ["int", "bytes"]),
            ([], []),
        ],
    )
    assert found(df) == {(2, "b", "renamed"), (4, "c", "retyped"), (4, "n", "added"), (5, "n", "removed"), (6, "c", "renamed"), (6, "a", "removed"), (6, "y", "added"), (7, "x", "removed"), (7, "y", "removed")}


def test_deliveries_order_and_nulls(spark):
    df = index(spark, [(["a"], ["str"]), (["a", "b"], ["str", "str"])])
    again = df.unionByName(df.filter("shard_id = 2")).unionByName(spark.createDataFrame([(None, "d", "0", 0, ["z"], ["str"], day(0), day(0)), (9, None, None, None, None, None, None, None)], SCHEMA))
    assert found(again) == {(2, "b", "added")}
    assert found(df.limit(0)) == set()


def test_blocks_do_not_matter(spark):
    lists = [(["a", "b"] if k % 5 else ["a"], ["str", "int"] if k % 5 else ["str"]) for k in range(23)]
    df = index(spark, lists)
    whole, size = found(df), sd.BLOCK
    try:
        sd.BLOCK = 4
        assert found(df) == whole and len(whole) > 6
        spans = sd.lifespans(df).filter("name = 'b'").orderBy("lifespan_no").collect()
    finally:
        sd.BLOCK = size
    assert [(r["first_seq"], r["last_seq"]) for r in spans] == [(2, 5), (7, 10), (12, 15), (17, 20), (22, 23)]


def test_one_table(spark):
    rows = [(1, 1, '{"Target_Text": "x", "sr": "16000", "zzz": 1}'), (2, 1, '{"answer_text": {"value": "y"}, "duration": "no"}'), (3, 1, '{"answer_text": "cut'), (4, 1, None), (5, 1, ""), (6, None, '{"Language": "", " language": "zh", "LANGUAGE": "en"}'), (7, 77, '{"lang": "ms", "language": null}'), (8, 1, '{"Zzz": "1", "zzz": "2", "a": "b"}')]
    ix = index(spark, [(["zzz", "target_text"], ["int", "str"])])
    got = {r["record_id"]: r for r in sd.one_table(spark.createDataFrame(rows, "record_id long, shard_id long, payload string"), ix).collect()}
    assert (got[1]["answer_text"], got[1]["sample_rate"], got[1]["other"]) == ("x", 16000, {"zzz": "1"})
    assert (got[2]["answer_text"], got[2]["duration"]) == ("y", None)
    assert [got[k]["readable"] for k in range(1, 6)] == [True, True, False, False, False]
    assert got[6]["language"] == "zh" and got[7]["language"] == "ms" and got[8]["other"] == {"zzz": "1", "a": "b"}
    assert len(got) == 8
    empty = sd.one_table(spark.createDataFrame([], "record_id long, shard_id long, payload string"), ix.limit(0))
    assert empty.count() == 0
