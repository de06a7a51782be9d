import math

from pyspark.sql import functions as F

from undertone.operators import evalflow as ev, metrics as m


def test_error_rate_edges(spark):
    df = spark.createDataFrame([("a b c", "a x c"), ("a b", ""), ("", "x"), (None, None), ("a a b", "a b")], "r string, h string")
    got = m.wer(df, [], "r", "h").first()
    assert (got["edits"], got["n_ref"]) == (1 + 2 + 1, 8)
    assert m.wer(df.filter("r = ''"), [], "r", "h").first()["value"] in (None, math.inf)


def test_cer_and_mer(spark):
    df = spark.createDataFrame([("你好吗 ok then", "你好啊 ok")], "r string, h string")
    assert (m.cer(df, [], "r", "h").first()["edits"], m.mer(df, [], "r", "h").first()["edits"]) == (5, 2)


def test_bleu_perfect_and_short(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat today"), (2, "a b c d e")], "k long, r string")
    w = F.split("r", " ")
    assert abs(m.bleu(df, [], F.array(w), w).first()["value"] - 100) < 1e-9
    assert m.bleu(df, [], F.array(w), F.slice(w, 1, 3)).first()["value"] == 0.0


def test_registry():
    assert not m.REGISTRY["wer"].higher_is_better and m.REGISTRY["bleu"].higher_is_better


def test_token_f1(spark):
    df = spark.createDataFrame([("a b b", "b b c"), ("", ""), ("a", "")], "r string, h string")
    got = [r[0] for r in df.select(m.token_f1(F.col("r"), F.col("h"))).collect()]
    assert got == [2 * 2 / 6, 1.0, 0.0]


def test_chunks(spark):
    df = spark.createDataFrame([(1, 30.4, 10.0), (2, 31.5, 10.0), (3, 5.0, 10.0), (4, 50.0, None)], "i long, s double, c double")
    got = {}
    for r in ev.chunk_plan(df, "s", F.col("c")).orderBy("i", "chunk").collect():
        got.setdefault(r["i"], []).append((r["start_s"], r["end_s"]))
    assert got == {1: [(0.0, 10.0), (10.0, 20.0), (20.0, 30.4)], 2: [(0.0, 10.0), (10.0, 20.0), (20.0, 30.0), (30.0, 31.5)], 3: [(0.0, 5.0)], 4: [(0.0, 50.0)]}


def test_batches_match_the_rule(spark):
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate([500, 300, 100, 90, 80, 70, 60, 50, 40])], "i long, s double")
    got = ev.greedy_batches(ev.deal(df, "s", "i", 1), "s", "place", 3, 200.0).orderBy("place").collect()
    assert [r["batch"] for r in got] == [0, 1, 2, 2, 3, 3, 4, 4, 4]


def test_last_wins_and_merge(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", None), (2, "d", None)], "k long, v string, t long")
    assert {(r["k"], r["v"]) for r in ev.last_wins(df, ["k"], "t").collect()} == {(1, "b"), (2, "d")}
    p = spark.createDataFrame([(1, 1, " y ", "stop"), (1, 0, "x", "length"), (1, 2, "", "stop"), (2, 0, "z", "stop")], "k long, c int, t string, f string")
    assert {tuple(r) for r in ev.merge_chunks(p, ["k"], "c", "t", "f").collect()} == {(1, "x y", "length", 3), (2, "z", "stop", 1)}


def test_islands(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a")], "g long, p long, w string")
    assert [r["island"] for r in ev.islands(df, ["g"], "p", "w").orderBy("p").collect()] == [1, 1, 2, 2, 3]


def test_run_order(spark):
    df = spark.createDataFrame([(r,) for r in ("zeta", "checkpoint-100", "base", "checkpoint-20", "alpha")], "r string")
    assert [x["r"] for x in df.orderBy(*ev.run_order(F.col("r"))).collect()] == ["base", "checkpoint-20", "checkpoint-100", "alpha", "zeta"]


def test_bleu_of_several_references(spark):
    """Against a plain count: clipping by the largest count over references and
    the closest reference length."""
    import math
    from collections import Counter

    rows = [("the the cat sat on", ["the cat sat on the mat", "the the dog sat"]), ("a b c d e", ["a b c d e f"]), ("", ["x y"])]
    df = spark.createDataFrame([(h, r) for h, r in rows], "h string, r array<string>")
    tok = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    got = m.bleu(df, [], F.transform("r", tok), tok(F.col("h"))).first()
    hits, total, rl, hl = [0] * 5, [0] * 5, 0, 0
    for h, rs in rows:
        h, rs = h.split(), [r.split() for r in rs]
        rl += min((abs(len(r) - len(h)), len(r)) for r in rs)[1]
        hl += len(h)
        for n in range(1, 5):
            grams = lambda t: Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))  # noqa: B023, E731
            most = Counter()
            for r in rs:
                most |= grams(r)
            hits[n] += sum((grams(h) & most).values())
            total[n] += sum(grams(h).values())
    want = 100 * min(1, math.exp(1 - rl / hl)) * math.exp(sum(math.log(hits[n] / total[n]) for n in range(1, 5)) / 4)
    assert (got["ref_len"], got["hyp_len"]) == (rl, hl) and abs(got["value"] - want) < 1e-9


def test_bleu_tokens(spark):
    df = spark.createDataFrame([("你好, world.",), (None,)], "x string")
    assert [r[0] for r in df.select(m.bleu_tokens(F.col("x"), "zh")).collect()] == [["你", "好", ",", "world", "."], []]


def test_chrf_against_plain_counts(spark):
    from collections import Counter

    rows = [("the cat sat", "the cat sit"), ("你好 世界", "你好 世"), ("", "x"), ("abc", None)]
    got = m.chrf(spark.createDataFrame(rows, "r string, h string"), [], "r", "h").first()["value"]
    ps, rs = [], []
    for unit, top in ((lambda x: list("".join((x or "").split())), 6), (lambda x: (x or "").split(), 2)):
        for n in range(1, top + 1):
            grams = lambda t: Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))  # noqa: B023, E731
            hits = sum(sum((grams(unit(r)) & grams(unit(h))).values()) for r, h in rows)
            nh, nr = (sum(sum(grams(unit(x[k])).values()) for x in rows) for k in (1, 0))
            if nh and nr:
                ps.append(hits / nh)
                rs.append(hits / nr)
    p, r = sum(ps) / len(ps), sum(rs) / len(rs)
    assert abs(got - 100 * 5 * p * r / (4 * p + r)) < 1e-9
