import pytest
from pyspark.sql import functions as F

from undertone.functions import numbers as n, text as t

CASES = [
    (t.remove_no_sound, "a (SPN) b<unk>c (ppo]\nd", "a bc (ppo] d"),
    (t.remove_no_sound, "<spn> 你好 (laugh>", "你好"),
    (t.squeeze_han, "你 好 ab 吗 a", "你好 ab 吗 a"),
    (t.squeeze_thai, "สวัส ดี ab", "สวัสดี ab"),
    (t.apostrophes, "I dont know, Cant you? wonton", "I don't know, Can't you? wonton"),
    (t.remove_hash, "#a b#c", "a b c"),
    (t.lower_keep_speaker, "<SPEAKER1>: HALO", "<Speaker1>: halo"),
    (t.add_speaker, "hi", "<Speaker1>: hi"),
    (t.add_speaker, "<Speaker2>: hi", "<Speaker2>: hi"),
    (t.unwrap_language, "<malay>apa ini: note</malay> (err) [Um]ok", "apa ini ok"),
    (t.punctuation_tags, "HELLO <COMMA> YOU<SIL> THERE <PERIOD>", "HELLO , YOU THERE ."),
    (t.digit_words, "20 dogs don't eat 1 or 21", "twenty dogs do not eat one or 21"),
    (t.remove_bracketed, "a (noise) b", "a  b"),
    (lambda c: t.remove_bracketed(c, True), "a (noise) (um) b", "a (noise)  b"),
    (lambda c: t.remove_bracketed(c, True), "a <x> b <y> c", "a  c"),
    (lambda c: t.language_tag(c, F.lit("codeswitch")), "hi 你好", "<speech_language: English,Chinese>hi 你好"),
    (lambda c: t.language_tag(c, F.lit("xx"), False), "hi", "<unused18>hi"),
    (lambda c: t.language_tag(c, F.lit("yue"), False), "hi", "<unused12><unused15>hi"),
    (t.remove_non_speech, "um I uh see umbrella", "I see umbrella"),
    (t.space_out, "你好ab", "你 好 ab"),
    (t.spelling, "the colour of tyre", "the color of tire"),
    (t.smoke, "It’s 5, ok", "IT'S 5 OK"),
    (t.strip_speaker_tags, "< Speaker 1 , f >: hi <speaker2> yo", "hi  yo"),
    (t.punct_in_tags, "#kopi-o_kosong# a-b", "#kopi o kosong# a-b"),
    (t.spelling, "organising neighbours travelled to the centres of dialogue hour", "organizing neighbors traveled to the centers of dialog hour"),
    (n.english_text, "Dr Lee hadn't, um, paid 1,000 (uh) it's been y'all's $ 5 %", "doctor lee had not paid 1000 it has been you all is 5"),
    (n.basic_composed, "Ｈｉ [x] ﬁne… é", "hi fine é"),
    (lambda c: n.basic_composed(c, diacritics=False), "Café Ｈｉ", "cafe hi"),
    (lambda c: n.basic_composed(c, letters=True), "ab", "a b"),
    (t.fillers, "[Uh-umm] well um, ok um-no 【uh】 ((x))", "(uh-um) well (um) ok um-no (uh) (x)"),
    (lambda c: t.correct_words(c, [("kopi o", "kopi-o")], [("hand phone", "handphone")]), "my hand phone #kopi o#", "my handphone #kopi o#"),
    (n.number_words, "two hundred and five dollars", "$205"),
    (n.number_words, "minus twenty one point five percent", "-21.5%"),
    (n.number_words, "one oh one and double five", "101 and 55"),
    (n.number_words, "the twenty first of three thousand", "the 21st of 3000"),
    (n.number_words, "one day", "one day"),
    (n.number_words, "sixes and the nineteen sixties", "6s and the 1960s"),
    (n.number_words, "the hundredth of two millionth", "the 100th of 2000000th"),
    (n.number_words, "twenty dollars and seven cents", "$20.07"),
    (n.number_words, "two and a half million and plus five", "2500000 and +5"),
    (n.number_words, "one decillion per cent or forty five percent", "1000000000000000000000000000000000% or 45%"),
    (n.number_words, "3 s of 20 thousand at 1.5 million", "3s of 20000 at 1500000"),
    (n.number_words, "minus sign and per day", "minus sign and per day"),
    (n.number_words, "one twenty five", "125"),
    (n.without_diacritics, "Œuvre naïve ß", "OEuvre naive ss"),
    (n.english_text, "I'm [laughs] twenty, isn't it colour?", "i am 20 is not it color"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_truth(spark, k):
    f, given, want = CASES[k]
    df = spark.createDataFrame([(given,), (None,), ("",)], "x string")
    got = [r["y"] for r in df.select(f(F.col("x")).alias("y")).collect()]
    assert got[0] == want and got[1] is None, got


@pytest.mark.parametrize("f", [t.remove_no_sound, t.squeeze_han, t.remove_hash, t.add_speaker])
def test_idempotent(spark, f):
    df = spark.createDataFrame([("a (SPN) # 你 好 <unk>",), ("",)], "x string").select(f(F.col("x")).alias("y"))
    assert [r["y"] for r in df.collect()] == [r["z"] for r in df.select(f(F.col("y")).alias("z")).collect()]


def test_case_and_scripts(spark):
    df = spark.createDataFrame([("ABC 1",), ("abc",), ("你好",), ("12",), ("Chào bạn",)], "x string")
    got = [(r["u"], r["l"], list(r["s"])) for r in df.select(t.all_upper(F.col("x")).alias("u"), t.all_lower(F.col("x")).alias("l"), t.scripts(F.col("x")).alias("s")).collect()]
    assert got == [(True, False, []), (False, True, []), (False, False, ["zh"]), (False, False, []), (False, False, ["vi"])]


def test_standardize(spark):
    df = spark.createDataFrame([("KAMI (SPN) PERGI", "ASR", "id"), ("as it is (SPN)", "ST", "en"), (None, "ASR", "en")], "x string, t string, l string")
    got = [r[0] for r in df.select(t.standardize(F.col("x"), F.col("t"), F.col("l"))).collect()]
    assert got == ["<Speaker1>: kami pergi", "as it is (SPN)", None]
