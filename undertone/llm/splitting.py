"""Problem 5: splitting oversized items at natural boundaries.

One rule cuts texts and recordings: a regular expression whose alternatives
are ordered by the strength of the boundary consumes up to the limit, the last
one takes the limit itself, and consecutive pieces overlap by a lookback.

A recording becomes a timeline, one character per half millisecond (so the
middle of a pause given in whole milliseconds is a character), which has a mark
at the middle of every usable pause. At 2,000 characters a second it is a
sixteenth of the recording's own bytes; it lives inside one row and is never
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from undertone.sources.tables import table

TICKS = 2000
MIN_PAUSE_MS = 200
MAX_SETS = 100_000


def duration_seconds() -> Column:
    return F.when(F.col("duration") > 0, F.col("duration")).otherwise(F.col("n_bytes") / 32000.0)


def oversized(items: DataFrame, sets: DataFrame) -> DataFrame:
    """Kept items longer than their set's chunk: one row per item.

    A re-delivered item counts once (the last loaded). Items without a usable
    duration, of an unknown set, longer than max_audio_s, or of a set that is
    never cut are left out.
    """
    if sets.limit(MAX_SETS + 1).count() > MAX_SETS:
        raise ValueError(f"more than {MAX_SETS} evaluation sets")
    one = items.groupBy("item_id").agg(F.max_by(F.struct("set_name", "duration", "n_bytes"), F.coalesce(F.col("loaded_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))).alias("r")).select("item_id", "r.*")
    s = sets.groupBy(F.trim("name").alias("set_name")).agg(F.first(F.struct("chunk_s", "max_audio_s", F.coalesce("overlap_s", F.lit(0.0)).alias("overlap_s"))).alias("s")).select("set_name", "s.*")
    j = one.withColumn("set_name", F.trim("set_name")).join(F.broadcast(s), "set_name").withColumn("seconds", duration_seconds())
    return j.filter("item_id is not null and seconds > 0 and chunk_s > 0 and seconds > chunk_s and (max_audio_s is null or seconds <= max_audio_s)")


def pieces(items: DataFrame, pauses: DataFrame) -> DataFrame:
    """Items of ``oversized`` with ``parts``: array of (stretch, natural).

    ``parts`` are the regex matches over the timeline that starts at the
    overlap: a virtual cut there makes the first piece start at 0, and every
    match consumes at most chunk - overlap from the cut before. Alternatives in
    order: the rest if it fits, the farthest pause within reach, the limit. A
    set whose overlap is not below its chunk can't advance and is cut without
    overlap.
    """
    ticks = lambda c: F.round(F.col(c) * TICKS).cast("long")
    usable = pauses.filter(f"item_id is not null and start_ms > 0 and end_ms is not null and end_ms - start_ms >= {MIN_PAUSE_MS}")
    middles = usable.select("item_id", (F.col("start_ms") + F.col("end_ms")).cast("long").alias("at"), "end_ms").distinct()
    base = items.select("item_id", "seconds", ticks("chunk_s").alias("chunk"), F.when(F.col("overlap_s") < F.col("chunk_s"), ticks("overlap_s")).otherwise(0).alias("overlap"))
    joined = base.join(middles, "item_id", "left")
    at = F.when((F.col("end_ms") < F.col("seconds") * 1000) & (F.col("at") > F.col("overlap")), F.col("at"))
    per = joined.groupBy("item_id", "seconds", "chunk", "overlap").agg(F.array_sort(F.collect_set(at)).alias("at"))
    # Decimal seconds: 30.01 * 2000 must not become 60020.000000000004
    per = per.withColumn("length", F.ceil(F.round(F.col("seconds") * TICKS, 4)) - F.col("overlap"))
    marks = F.concat(F.array("overlap"), F.col("at"))
    stretch = F.transform(F.col("at"), lambda x, i: F.concat(F.repeat(F.lit("."), (x - F.element_at(marks, i + 1) - 1).cast("int")), F.lit("P")))
    last = F.element_at(marks, -1) - F.col("overlap")
    line = F.concat(F.array_join(stretch, ""), F.repeat(F.lit("."), (F.col("length") - last).cast("int")))
    reach = (F.col("chunk") - F.col("overlap")).cast("string")
    less = (F.col("chunk") - F.col("overlap") - 1).cast("string")
    pattern = F.concat(F.lit("(.{1,"), reach, F.lit("}$|.{0,"), less, F.lit("}P|.{"), reach, F.lit("})"))
    return per.withColumn("parts", F.regexp_extract_all(line, pattern, F.lit(1))).select("item_id", "chunk", "overlap", F.transform("parts", lambda p: F.struct(F.length(p).alias("ticks"), p.endswith("P").alias("natural"))).alias("parts"))


def cuts(parts: DataFrame) -> DataFrame:
    """(item_id, piece_no, start_s, end_s, natural_end) of every piece."""
    ends = F.transform("parts", lambda p, i: F.aggregate(F.slice(F.col("parts"), 1, i + 1), F.col("overlap").cast("long"), lambda a, q: a + q["ticks"]))
    x = parts.withColumn("ends", ends).select("item_id", "overlap", F.posexplode(F.arrays_zip("parts", "ends")).alias("i", "p"))
    end = F.col("p.ends")
    start = end - F.col("p.parts.ticks") - F.col("overlap")
    return x.select("item_id", (F.col("i") + 1).alias("piece_no"), (F.greatest(start, F.lit(0)) / TICKS).alias("start_s"), (end / TICKS).alias("end_s"), F.col("p.parts.natural").alias("natural_end"))


def _item_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(oversized(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "eval_sets")), table(spark, sf_dir, "item_pauses"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.slice(F.col("parts"), 1, F.size("parts") - 1)
    kind = F.when(F.forall(inner, lambda p: p["natural"]), "natural").otherwise("forced")
    return _item_parts(spark, sf_dir).select("item_id", kind.alias("cut_kind"))


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts(_item_parts(spark, sf_dir))


def text_pieces(df: DataFrame, text: str, limit: int, overlap: int = 0) -> DataFrame:
    """``df`` with array column ``pieces`` of (start, end, piece) of ``text``.

    Boundaries from strong to weak: the end of the text, a blank line, a line,
    a sentence, a clause, a word, any character; each consumes as much as fits.
    A boundary in the first half of the limit is used only where the second half
    has none of any strength, so a piece is not cut tiny for a strong boundary
    near its start, and no word is cut while its window holds a boundary.
    Pieces overlap by ``overlap`` code points (below the limit). Null gives
    null, an empty text no pieces.
    """
    if not 0 <= overlap < limit:
        raise ValueError("0 <= overlap < limit")
    n = limit - overlap
    half = n // 2
    strong = [r"\n\s*\n", r"\n", r"[.!?。！？]+[\"'”’)]*\s*", r"[,;:，；：、]\s*", r"\s"]
    alternatives = [r"(?s:.{1,%d})\z" % n]
    for least, most in ((max(half, 1), n), (1, max(half - 1, 1))):
        alternatives += [r"(?s:.{%d,%d})(?<=%s)" % (least, most, s.replace("+", "{1,8}").replace("*", "{0,8}")) for s in strong]
    alternatives += [r"(?s:.{%d})" % n]
    body = F.expr(f"substring(`{text}`, {overlap + 1})")
    parts = F.regexp_extract_all(body, F.lit("(" + "|".join(alternatives) + ")"), F.lit(1))
    ends = F.aggregate(parts, F.array().cast("array<int>"), lambda a, p: F.concat(a, F.array(F.length(p) + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(overlap)))))
    whole = F.when(F.length(text) <= overlap, F.when(F.length(text) > 0, F.array(F.length(text))).otherwise(F.array().cast("array<int>"))).otherwise(ends)
    make = F.transform(F.col("__ends"), lambda e, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.element_at("__ends", F.greatest(i, F.lit(1))) - overlap).alias("start"), e.alias("end")))
    out = df.withColumn("__ends", F.when(F.col(text).isNotNull(), whole)).withColumn("__spans", make)
    return out.withColumn("pieces", F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]).alias("piece")))).drop("__ends", "__spans")


def p5_text_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in pieces of at most 1,000 code points, overlapping by 100."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = text_pieces(docs, "text", 1000, 100)
    return cut.select("doc_id", F.posexplode("pieces").alias("i", "p")).select("doc_id", (F.col("i") + 1).alias("piece_no"), F.col("p.start").alias("start"), F.col("p.end").alias("end"), F.length("p.piece").alias("n_chars"))
