from pyspark.sql import functions as F

from undertone.functions.keyed import hashed, key
from undertone.operators import ranking, sampling


def rows(spark, sizes):
    return spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i long")


def test_draw_counts(spark):
    r = rows(spark, {"a": 10, "b": 7, "c": 3, "d": 2})
    want = spark.createDataFrame([("a", 4), ("b", 17), ("c", 0), ("d", None), ("none", 5)], "g string, n long")
    got = sampling.draw(r, want, "g", "i", 1, 0)
    n = {x["g"]: (x["n"], x["k"], x["c"]) for x in got.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("i").alias("k"), F.max("copy").alias("c")).collect()}
    assert n == {"a": (4, 4, 0), "b": (17, 7, 2)}


def test_epochs_differ_and_fixed_do_not(spark):
    r, want = rows(spark, {"a": 50}), spark.createDataFrame([("a", 10)], "g string, n long")
    take = lambda e: {x["i"] for x in sampling.draw(r, want, "g", "i", 42, e).collect()}
    assert take(0) != take(1)
    assert take(None) == take(None) == take(0)


def test_positions_are_ranks_whatever_the_partitions(spark):
    r = rows(spark, {"a": 40, "b": 40}).withColumn("h", hashed(key("x", F.col("g"), F.col("i") % 7)))
    a = ranking.positions(r.repartition(1), "h", ["i"], ["g"], bits=2)
    b = ranking.positions(r.repartition(9), "h", ["i"], ["g"], bits=12)
    assert sorted(map(tuple, a.select("g", "i", "position").collect())) == sorted(map(tuple, b.select("g", "i", "position").collect()))
    assert sorted(x["position"] for x in a.filter("g = 'a'").collect()) == list(range(40))


def test_ranks_cover(spark):
    r = rows(spark, {"a": 22}).withColumn("copy", F.lit(0))
    o = sampling.epoch_order(r, "g", "i", 1, 0)
    p = sampling.ranked(o, 4, 22).collect()
    assert len(p) == 20 and len({x["i"] for x in p}) == 20
    assert {sum(x["rank"] == k for x in p) for k in range(4)} == {5}


def test_resume_gives_the_same_batches(spark):
    o = sampling.epoch_order(rows(spark, {"a": 30}).withColumn("copy", F.lit(0)), "g", "i", 1, 0)
    whole = {x["i"]: x["batch"] for x in sampling.batches(o, 4, 30).collect()}
    tail = {x["i"]: x["batch"] for x in sampling.batches(o, 4, 30, 8).collect()}
    assert {i: b + 2 for i, b in tail.items()} == {i: b for i, b in whole.items() if b >= 2} or len(tail) == 20


def test_replacement_goes_round(spark):
    r = spark.createDataFrame([(i, i in (3, 4, 9)) for i in range(10)], "p long, bad boolean")
    for block in (2, 4, 100):
        got = {x["p"]: x["served"] for x in sampling.replacements(r, "p", F.col("bad"), tries=3, block=max(block, 4)).collect()}
        assert got == {0: 0, 1: 1, 2: 2, 3: 5, 4: 5, 5: 5, 6: 6, 7: 7, 8: 8, 9: 0}


def test_replacement_gives_up(spark):
    r = spark.createDataFrame([(i, True) for i in range(5)], "p long, bad boolean")
    assert {x["served"] for x in sampling.replacements(r, "p", F.col("bad"), tries=3).collect()} == {None}


def test_unimax_spends_the_budget(spark):
    c = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000)], "g string, n long")
    got = {x["g"]: x["allotted"] for x in sampling.unimax(c, "g", "n", 600.0, 2.0).collect()}
    assert got == {"a": 20.0, "b": 200.0, "c": 380.0}


def test_median_of_hot_group(spark):
    r = spark.createDataFrame([("a", float(v)) for v in [5, 1, 4, 2]] + [("b", 7.5)] + [("c", None)], "g string, v double")
    assert {x["g"]: x["median"] for x in ranking.median(r, ["g"], "v").collect()} == {"a": 3.0, "b": 7.5}


def test_empty(spark):
    r, want = rows(spark, {}), spark.createDataFrame([("a", 3)], "g string, n long")
    assert sampling.draw(r, want, "g", "i", 1, 0).count() == 0
