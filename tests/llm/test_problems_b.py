"""Problems 3, 4, 6, 10."""

import random

import pytest
from pyspark.sql import functions as F

from undertone.llm import language as lg, overlap as ov, personal as pi, transcripts as tr


# --- 3: languages
@pytest.fixture(scope="module")
def fitted(spark, sf):
    samples = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/mds_samples.parquet")
    return lg.fit(lg.sample_for_fit(samples, "response_text", lg.label(F.col("language")), 200))


def test_labels(spark):
    given = ["en", " EN ", "en-SG", "eng", "English", "zho", "msa", "tl-PH", "fil", "CodeSwitch", "n/a", "", None, "UNK", "und", "fr"]
    df = spark.createDataFrame([(g,) for g in given], "x string")
    assert [r[0] for r in df.select(lg.label(F.col("x"))).collect()] == ["en"] * 5 + ["zh", "ms", "tl", "tl", "codeswitch", None, None, None, None, None, "fr"]


def test_held_out_accuracy(spark, fitted):
    held = spark.read.parquet("/root/testdata/sf0.001/heldout_passages.parquet").select(F.col("passage_id").alias("k"), "text", "lang")
    got = lg.passages(held, "k", "text", fitted).groupBy("k").agg(F.max_by("language", "words").alias("g"))
    rate = held.join(got, "k").agg(F.avg((F.col("lang") == F.col("g")).cast("int"))).first()[0]
    assert rate >= 0.98


def test_mixed_passages_and_edges(spark, fitted):
    texts = [
        (1, "Speaker 1: The gardener rented the headset outside the station. Pengerusi hendak menukar jambatan yang buruk di pejabat pos minggu hadapan."),
        (2, "[laughs] um (uh) <unk>"),
        (3, None),
        (4, ""),
        (5, "她昨天下午在河边清洗了手机因为工资太干净"),
        (6, "12 34 5678"),
        (7, "The tenant never checked that gentle loan under the flyover. Lotus Plaza. " * 500),
    ]
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in texts], "key long, t string, language string, words int")
    got = {}
    for r in lg.passages(df, "key", "t", fitted).orderBy("key", "passage_no").collect():
        assert 0.5 <= r["confidence"] <= 1
        got.setdefault(r["key"], []).append(r["language"])
    assert got == {1: ["en", "ms"], 5: ["zh"], 7: ["en"]}


def test_fit_without_rows():
    prototypes, scale = lg.fit([])
    assert lg.Labeller(prototypes, scale).batch([None, "", "some words here now"])[0] == []


# --- 4: overlap
def test_edit_distance():
    def plain(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            c = [i]
            for j, y in enumerate(b, 1):
                c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
            p = c
        return p[-1]

    rnd = random.Random(0)
    for _ in range(1500):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 14))] for _ in range(2))
        assert ov.edit_distance(a, b) == plain(a, b)


def edited(rnd, ts, k, pool):
    ts = list(ts)
    for _ in range(k):
        i = rnd.randrange(len(ts))
        kind = rnd.randrange(3)
        if kind == 0:
            ts[i] = rnd.choice(pool)
        elif kind == 1:
            ts.insert(i, rnd.choice(pool))
        elif len(ts) > 1:
            del ts[i]
    return ts


def test_bound_and_lists_hold():
    """Within the edits a text keeps the bound and meets a listed term."""
    import numpy as np

    rnd = random.Random(4)
    tables = [np.random.default_rng(k).integers(0, 50, ov.SLOTS) for k in range(3)]
    hasher = ov.Hasher()
    for _ in range(600):
        pool = [f"w{i}" for i in range(rnd.choice([3, 40]))]
        answer = [rnd.choice(pool) for _ in range(rnd.randint(5, 90))]
        edits = len(answer) // ov.PART
        text = edited(rnd, answer, rnd.randint(0, edits), pool)
        order = int(ov.order_of(ov.length_class(len(text)))) if edits else len(answer)
        h, t = hasher.hashes(answer), hasher.hashes(text)
        listed = ov.Listed(hasher.runs(h, order), ov.information(h, order, hasher, tables), order, edits)
        runs = hasher.runs(t, order)
        assert 0 < listed.bound <= ov.dot(listed, runs, edits) * (1 + 1e-9)
        assert any(abs(at - k) <= edits and runs[k] == listed.runs[at] for at in listed.head.tolist() for k in range(len(runs)))
        rest = np.delete(listed.weights, listed.head).sum()
        assert rest < listed.bound
        lost = bin(int(ov.sketch(h, np.zeros(1, int))[0]) & ~int(ov.sketch(t, np.zeros(1, int))[0]) & (1 << 64) - 1).count("1")
        assert lost <= edits


def test_most_lost():
    import itertools

    import numpy as np

    rnd = np.random.default_rng(2)
    for _ in range(60):
        w, order, edits = rnd.random(rnd.integers(1, 9)), int(rnd.integers(1, 4)), int(rnd.integers(0, 4))
        most = max(sum(w[i] for i in set().union(*(range(max(0, e - order + 1), min(len(w), e + 1)) for e in at))) for at in itertools.product(range(len(w) + order - 1), repeat=edits))
        assert abs(ov.most_lost(w, order, edits) - most) < 1e-9


@pytest.mark.parametrize("way", ["filter and lists", "no filter", "salted", "blocks"])
def test_join_against_brute_force(spark, monkeypatch, way):
    monkeypatch.setattr(ov, "FILTER_MAX_BYTES", 0 if way == "no filter" else ov.FILTER_MAX_BYTES)
    monkeypatch.setattr(ov, "KEPT_KEYS", 0 if way == "no filter" else ov.KEPT_KEYS)
    monkeypatch.setattr(ov, "HOT", 1 if way == "salted" else ov.HOT)
    monkeypatch.setattr(ov, "HOT_FACTOR", 0 if way == "salted" else ov.HOT_FACTOR)
    monkeypatch.setattr(ov, "LISTED_SHARE", {"blocks": 0.0, "filter and lists": 1e9}.get(way, ov.LISTED_SHARE))
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    thai = [chr(0x0E01 + i) for i in range(40)]
    held, train = [], []
    for i in range(60):
        ts = [rnd.choice(words) for _ in range(rnd.randint(3, 40))]
        held.append((1000 + i, " ".join(ts)))
        for k in (0, len(ts) // 8, len(ts) // 8 + 1):
            train.append((len(train), ", ".join(edited(rnd, ts, k, words)).upper()))
    for i in range(15):
        ts = [rnd.choice(thai) for _ in range(rnd.randint(8, 150))]
        held.append((2000 + i, "".join(ts)))
        for k in (0, len(ts) // 8, len(ts) // 8 + 3):
            train.append((len(train), " ".join(edited(rnd, ts, k, thai))))
    train += [(9001, None), (9002, ""), (9003, "um (uh) <unk>"), (0, train[0][1])]
    held += [(3001, None), (3002, ""), (3003, "one two three four")]
    t = spark.createDataFrame(train, "key long, norm string")
    h = spark.createDataFrame(held, "key long, norm string")
    got = {(r["key_t"], r["key_h"]) for r in ov.cross_split(t.withColumnRenamed("key", "key_t"), "key_t", "norm", h.withColumnRenamed("key", "key_h"), "key_h", "norm").collect()}
    want = set()
    for hk, ht in held:
        a = ov.tokens((ht or "").lower())
        if not ov.counts(a):
            continue
        for tk, tt in train:
            b = ov.tokens(" ".join((tt or "").lower().replace(",", " ").split()))
            if ov.edit_distance(a, b) * ov.PART <= len(a):
                want.add((tk, hk))
    assert got == want and len(want) > 100


def test_low_answers_in_several_blocks(spark):
    rnd = random.Random(9)
    thai = [chr(0x0E01 + i) for i in range(12)]
    held = [(i, "".join(rnd.choice(thai) for _ in range(120))) for i in range(12)]
    train = [(100 + i, t[:50] + t[55:]) for i, t in held]
    size = ov.BLOCK
    try:
        ov.BLOCK = 5
        got = {tuple(r)[:2] for r in ov.cross_split(spark.createDataFrame(train, "k long, t string"), "k", "t", spark.createDataFrame(held, "h long, t string"), "h", "t").collect()}
    finally:
        ov.BLOCK = size
    assert got == {(100 + i, i) for i in range(12)}


def test_links_of_copies(spark):
    """Copies are counted, not paired; a third of all rows is one text."""
    a = "the quick brown fox jumps over it"
    t = spark.createDataFrame([(i, a) for i in range(500)] + [(900, "nothing of the kind at all here")], "k long, t string")
    h = spark.createDataFrame([(i, a) for i in range(400)], "h long, t string")
    got = ov.linked_classes(t, "k", "t", h, "h", "t").collect()
    assert len(got) == 500 and {r["n_links"] for r in got} == {400} and len({r["class_id"] for r in got}) == 1


def test_noise_is_ignored(spark):
    a = "the quick brown fox jumps over it"
    t = spark.createDataFrame([(1, "[00:01] Speaker 1: The quick, uh brоwn (um) fox jumps [laughs] over it."), (2, "<Speaker2>: the quick brown fox jumps over"), (3, "A: THE QUICK BROWN FOX JUMPS OVER IT")], "k long, t string")
    got = {tuple(r)[:2] for r in ov.cross_split(t, "k", "t", spark.createDataFrame([(9, a)], "h long, t string"), "h", "t").collect()}
    assert got == {(1, 9), (3, 9)}
    assert ov.cross_split(t.limit(0), "k", "t", spark.createDataFrame([], "h long, t string"), "h", "t").count() == 0


# --- 6: transcripts
TURNS = [
    ("Speaker 1: hello there\nspk2: hi (um)\nS1 : bye", [1, 2, 1]),
    ("[00:09] A: later\n[00:03] B> first", [1, 2]),
    ("Host: one GUEST: two host: three", [1, 2, 1]),
    ("[S1] (uh) [laughs]\n[S2] words", [1]),
    ("Spk 01 - a\n<SPN>\nspeaker_1: b", [1]),
    ("说话人1： 你好 说话人2： 好", [1, 2]),
    ("(12.5s) <Speaker 1 >: x (13.0s) um (14.1s) y z (15s) Speaker 2: w", [1, 2]),
    ("00:07 --> 00:08 A: x\n00:09 --> 00:11 without label\n00:12 --> 00:13 B: y", [1, 2]),
    ("(A)", []),
    ("The answer: B", []),
    ("no labels here", []),
    ("", []),
    (None, []),
    ("Agenda: nothing", []),
    ("Host - hello there\nGuest - hi", [1, 2]),
    ("Speaker 1: um\nSpeaker 2: *coughs*", []),
]


@pytest.mark.parametrize("k", range(len(TURNS)))
def test_turns(k):
    text, want = TURNS[k]
    assert [t[1] for t in tr.turns(text)] == want
    assert [t[0] for t in tr.turns(text)] == list(range(1, len(want) + 1))


def test_order_and_clean():
    got = tr.turns("[00:20] B: second um, part [laughs]\n[00:05] A: first <unk> part")
    assert [(t[2], t[5]) for t in got] == [("A", "first part"), ("B", "second part")]
    times = [t[3] for t in got]
    assert times == sorted(times)


def test_clock_reset():
    parts, _ = tr.stretches("[20:00] A: x\n[20:10] B: y\n[00:05] A: z")
    assert [p[2] for p in tr.ordered(parts)] == ["A", "B", "A"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("[00:00:01] A: a [00:20:00] B: b [00:00:05] A: c [00:00:09] B: d", [("A", 1.0), ("B", 5.0), ("A", 5.0), ("B", 9.0)]),
        ("[00:05] A: a [15:00] B: b [30:00] A: c [00:06] B: d [15:00] A: e [30:00] B: f", [("A", 5.0), ("B", 900.0), ("A", 1800.0), ("B", 1806.0), ("A", 2700.0), ("B", 3600.0)]),
        ("[00:30:00] A: a [00:00:01] B: b [00:30:05] A: c", [("A", 1800.0), ("B", 1800.0), ("A", 1805.0)]),
        ("[00:20] A: a [00:10] B: b", [("B", 10.0), ("A", 20.0)]),
    ],
)
def test_wild_stamps_and_segments(text, want):
    assert [(t[2], round(t[3], 3)) for t in tr.turns(text)] == want


def test_segments_of_a_long_file():
    stamps = [float(k) for k in range(3000)] + [float(k) for k in range(3000)]
    stamps[50] = 90000.0
    number, wild = tr.segments(stamps)
    assert number == [0] * 3000 + [1] * 3000 and [k for k, w in enumerate(wild) if w] == [50]


def test_isotonic():
    assert tr.isotonic([1, 3, 2, 4]) == [1, 2.5, 2.5, 4] and tr.isotonic([]) == []


def test_turns_long_and_frame(spark):
    df = spark.createDataFrame([(1, "\n".join(f"S{1 + k % 2}: word {k}" for k in range(5000)), 3), (2, None, 3), (None, "S1: x", 3)], "sample_id long, response_text string, turn_no int")
    assert tr.speaker_turns(df, "sample_id", "response_text").count() == 5000


# --- 10: personal information
NAMES = [("Benan", "given"), ("Dawn", "given"), ("Mark", "given"), ("Favoor", "family"), ("Stone", "family")]
TEXTS = [
    ("write to a.b+c@kopi-post.example or x_1＠uni.brass.test.", ["email", "email"]),
    ("jo (at) lantern.test, jo [at] lantern [dot] test, jo underscore x1 at lantern dot test", ["email"] * 3),
    ("Call +65 5433 4721, 006550461075, (+60) 10-555 9746, (555) 014-4521, 5867-8697, 5531 1865, ＋６５ ５８８２ ６１８３", ["phone"] * 7),
    ("five two double four one seven six four", ["phone"]),
    ("Ratio 16:9, order 4471-22, batch 3 of 12. Room 12-05 until 2025-11-03, 81,900,000 rows, TKT-20394, v3, lr 2e-5 @ step 640", []),
    ("X0870406G x 1929 182 f 151388-99-8262 9988772194859499 W13246075", ["id_number"] * 5),
    ("Block 250A, LOTUS PLAZA LANE, unit 2-47 and 528 Windmill Rise, Singapore 091529; No. 544, Jalan Teratai Dua; 我住在望海巷43号21楼。", ["street_address"] * 4),
    ("near Lotus Plaza Lane; Chunk 39 of the court recording", []),
    ("We met Benan Favoor, Favoor, Dawn, Mdm Xyzzy and Dawn binti Stone", ["person_name"] * 4),
    ("Mark the box at dawn. Hope for the best.", []),
    ("my name is nobody important; name: jolon suloVoor", ["person_name"]),
    ("我叫骆凌霄。我们在等柳知夏女士。表格由Benan Favoor签名", ["person_name"] * 3),
    ("mail dawn.stone@corp.test", ["email"]),
    ("", []),
]


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_found(k):
    text, want = TEXTS[k]
    finder = pi.Finder(NAMES)
    got = finder.find(text)
    assert sorted(s[2] for s in got) == sorted(want), [(text[a:b], c) for a, b, c in got]


def test_rewriting_keeps_the_rest_and_coreference():
    text = "Benan Favoor wrote to Dawn Stone. Call 5867-8697 or 5867 8697. My name is BENAN FAVOOR; a@b.test."
    spans = pi.Finder(NAMES).find(text)
    out = pi.rewrite(text, spans, b"k", True)
    assert out == "<person_name_1> wrote to <person_name_2>. Call <phone_1> or <phone_1>. My name is <person_name_1>; <email_1>."
    new = pi.rewrite(text, spans, b"k", False)
    assert new == pi.rewrite(text, spans, b"k", False) != pi.rewrite(text, spans, b"other", False)
    words = new.split(" wrote to ")
    first, second = words[0], words[1].split(". Call ")[0]
    assert first != second and first.upper() in new and "Benan" not in new
    a, b = new.split("Call ")[1].split(". ")[0].split(" or ")
    assert a.replace("-", "") == b.replace(" ", "") and a != "5867-8697"


def test_surrogates_match_kind_and_format():
    for kind, text in (("phone", "＋６５ ５８８２ ６１８３"), ("phone", "five one two four six seven eight"), ("id_number", "x 1929 182 f"), ("email", "A at b dot test"), ("person_name", "Favoor, Benan"), ("person_name", "骆凌霄"), ("street_address", "望海巷43号")):
        new = pi.surrogate(b"key", kind, text)
        assert new != text
        if kind in ("phone", "id_number") and not text[0].isalpha():
            assert len(new) == len(text)
    assert pi.surrogate(b"k", "person_name", "Mdm Stone").startswith("Mdm ") and "," in pi.surrogate(b"k", "person_name", "Favoor, Benan")


def test_mentions_frame(spark):
    names = spark.createDataFrame(NAMES, "name_part string, kind string")
    df = spark.createDataFrame([(1, "a@b.test a@b.test", 7), (2, None, 7), (3, "", 7)], "doc_id long, text string, start int")
    got = [tuple(r) for r in pi.mentions(df, "doc_id", "text", names, "s").select("doc_id", "kind", "occurrence_no").collect()]
    assert got == [(1, "email", 1), (1, "email", 2)]
    assert [r["text"] for r in pi.replaced(df, "doc_id", "text", names, "s", True).orderBy("doc_id").collect()] == ["<email_1> <email_1>", None, ""]
    assert pi.mentions(df.limit(0), "doc_id", "text", names.limit(0), "s").count() == 0


def swapped(text, names=NAMES, key=b"k"):
    spans = pi.Finder(names).find(text)
    return [text[a:b] for a, b, _ in spans], pi.replacements(text, spans, key, False)


def test_phone_formats_agree():
    old, new = swapped("9123 4567, +65 9123 4567, 00659123-4567, nine one two three four five six seven, +60 10-555 9746, 010-555 9746")
    assert len(old) == 6
    digits = [pi.spoken_digits(n) for n in new]
    assert digits[1] == "65" + digits[0] and digits[2] == "0065" + digits[0] and digits[3] == digits[0]
    assert new[1].startswith("+65 ") and new[4].startswith("+60 ") and digits[4][2:] == digits[5][1:] != digits[0]
    assert digits[0] != "91234567" and [len(a) for a in old[:3]] == [len(a) for a in new[:3]]


def test_five_hundred_names_stay_five_hundred():
    names = [(f"Gi{chr(97 + i)}{chr(97 + j)}n", "given") for i in range(25) for j in range(20)] + [("Stone", "family")]
    text = ". ".join(f"{g} Stone" for g, k in names if k == "given")
    old, new = swapped(text, names)
    assert len(old) == len(set(old)) == 500 == len(set(new)) and len({n.split()[1] for n in new}) == 1


@pytest.mark.parametrize(
    "text, shape",
    [
        ("My name is Ahmad bin Ali.", r"[A-Z]\w+ bin [A-Z]\w+"),
        ("Mr Dawn Stone", r"Mr [A-Z]\w+ [A-Z]\w+"),
        ("MY NAME IS MDM STONE", r"MDM [A-Z]+"),
        ("Favoor, Benan", r"[A-Z]\w+, [A-Z]\w+"),
        ("Block 12, Clementi Road, #05-12 Singapore 123456", r"Block [1-9]\d, [A-Z]\w+ Road, #\d\d-[1-9]\d Singapore [1-9]\d{5}"),
        ("No. 43, Jalan Teratai Dua", r"No\. [1-9]\d, Jalan [A-Z]\w+ Dua"),
        ("望海巷43号21楼", r"[一-鿿]{2}巷[1-9]\d号[1-9]\d楼"),
        ("john.smith2@corp.gov.sg", r"[a-z]+\.[a-z]+\d@[a-z]+\.gov\.sg"),
        ("jo underscore x1 at lantern dot test", r"[a-z]+ underscore [a-z]+\d at [a-z]+ dot test"),
        ("X0870406G", r"[A-Z]\d{7}[A-Z]"),
        ("我叫骆凌霄。", r"[一-鿿]{3}"),
        ("Call 9123\u200b 45\u00ad67", r"9\d{3} \d{4}"),
        ("a\u200bb@x\u2060y.test", r"[a-z]+@[a-z]+\.test"),
        ("x" * 200 + "@corp.test", r"[a-z]+@[a-z]+\.test"),
    ],
)
def test_format_is_kept(text, shape):
    import re

    old, new = swapped(text)
    assert len(old) == 1 and re.fullmatch(shape, new[0]) and new[0] != old[0], (old, new)
    assert swapped("Elsewhere: " + text)[1] == new and swapped(text, key=b"other")[1] != new


def test_gender_and_coreference():
    old, new = swapped("Mdm Dawn Stone met Mark Favoor. Dawn Stone and Mdm Stone left; STONE, DAWN stayed.")
    assert [n.lower().replace("mdm ", "") for n in (new[0], new[2])] == [new[2].lower()] * 2
    assert new[3].split()[1] == new[0].split()[2] and new[0].split()[1].endswith(pi.ENDS["f"])
    assert not swapped("Mark Favoor")[1][0].split()[0].endswith(("ine", "elle"))


def test_cipher_is_a_permutation():
    for n in (1, 2, 3):
        every = [f"{k:0{n}d}" for k in range(10**n)]
        assert sorted(pi.enciphered(b"k", x, "t") for x in every) == every
    figures = [str(k) for k in range(10, 100)]
    assert sorted(pi._figures(b"k", x, "t", 0) for x in figures) == figures


def test_a_surrogate_is_no_other_entity():
    first = swapped("9123 4567")[1][0]
    old, new = swapped(f"9123 4567 and {first}")
    assert len(old) == 2 and len(set(new)) == 2 and not set(new) & set(old)
