"""Schemas that drift between files.

A catalogue of column lifespans: the column lists of all shards are exploded
into (producer, sequence number, field, type); islands of consecutive sequence
numbers per producer, field and type are the lifespans; their starts and ends
are the change log. An alias table turns the catalogue into casts that bring
every record into one table.

A producer (dataset and folder) may hold a third of all shards, so nothing is
windowed over a whole producer: sequence numbers come from counts per day plus
a rank inside the day, and the look at the neighbour from windows over blocks
of sequence numbers that carry their neighbours' edge rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from undertone.functions.tokens import let
from undertone.sources.tables import table

BLOCK = 1024
PRODUCER = ["dataset", "subdir"]

# Other names of one field, and the type it has in the one table.
ALIASES = [
    ("context_audio", "string", ["context_audio", "audio"]),
    ("instruction_text", "string", ["instruction_text", "prompt", "query_text"]),
    ("answer_text", "string", ["answer_text", "response_text", "target_text"]),
    ("context_text", "string", ["context_text", "transcript", "source_text"]),
    ("language", "string", ["language", "lang", "locale"]),
    ("src_lang", "string", ["src_lang", "source_language"]),
    ("tgt_lang", "string", ["tgt_lang", "target_language"]),
    ("task", "string", ["task", "task_type"]),
    ("answer_audio", "string", ["answer_audio"]),
    ("instruction_audio", "string", ["instruction_audio"]),
    ("duration", "double", ["duration", "audio_duration"]),
    ("sample_rate", "bigint", ["sample_rate", "sr"]),
    ("channel", "string", ["channel"]),
    ("quality", "double", ["quality"]),
    ("snr_db", "double", ["snr_db"]),
    ("n_words", "bigint", ["n_words"]),
    ("speaker_count", "bigint", ["speaker_count"]),
    ("is_synthetic", "bigint", ["is_synthetic"]),
]


def _name(c: Column) -> Column:
    return F.lower(F.trim(c))


def shards(index: DataFrame) -> DataFrame:
    """One row per shard: its last indexed entry, names trimmed, null-safe.

    Null column lists count as empty; a null shard_id is no shard.
    """
    latest = index.filter("shard_id is not null").groupBy("shard_id").agg(
        F.max_by(F.struct("dataset", "subdir", "shard_no", "written_at", "column_names", "column_encodings"), F.coalesce(F.col("indexed_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))).alias("r")
    )
    return latest.select(
        F.coalesce(F.trim("r.dataset"), F.lit("")).alias("dataset"),
        F.coalesce(F.trim("r.subdir"), F.lit("")).alias("subdir"),
        "shard_id",
        F.col("r.shard_no").alias("shard_no"),
        F.col("r.written_at").alias("written_at"),
        F.transform(F.coalesce("r.column_names", F.array().cast("array<string>")), _name).alias("names"),
        F.coalesce("r.column_encodings", F.array().cast("array<string>")).alias("types"),
    )


def sequenced(shard: DataFrame) -> DataFrame:
    """``seq``: the place of each shard in its producer's order of writing.

    Order: written_at (null first), shard_no, shard_id. Shards are counted per
    producer and day, the counts are summed over the days, and only the shards
    of one day are ranked together.
    """
    day = shard.withColumn("day", F.to_date("written_at"))
    counts = day.groupBy(*PRODUCER, "day").agg(F.count(F.lit(1)).alias("n"))
    over = W.partitionBy(*PRODUCER).orderBy(F.asc_nulls_first("day"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("n_shards", F.sum("n").over(W.partitionBy(*PRODUCER)))
    a, b = day.alias("a"), counts.alias("b")
    same = F.col("a.dataset").eqNullSafe(F.col("b.dataset")) & F.col("a.subdir").eqNullSafe(F.col("b.subdir")) & F.col("a.day").eqNullSafe(F.col("b.day"))
    j = a.join(b, same).select("a.*", "b.before", "b.n_shards")
    rank = F.row_number().over(W.partitionBy(*PRODUCER, "day").orderBy(F.asc_nulls_first("written_at"), F.asc_nulls_first("shard_no"), "shard_id"))
    return j.withColumn("seq", F.col("before") + rank).drop("before", "day")


def fields(shard: DataFrame) -> DataFrame:
    """One row per shard and column: name, type and place in the list."""
    e = shard.select(*PRODUCER, "seq", "n_shards", "shard_id", F.size("names").alias("width"), "names", F.posexplode("names").alias("pos", "name"), "types")
    return e.select(*PRODUCER, "seq", "n_shards", "shard_id", "width", "pos", "name", F.coalesce(F.get("types", F.col("pos")), F.lit("")).alias("type"))


def islands(field: DataFrame) -> DataFrame:
    """``fields`` with ``starts`` and ``ends``: no same field and type just
    before or after. Blocks of BLOCK sequence numbers are windowed apart; the
    first and last rows of a block are also given to its neighbours as context.
    """
    one = field.dropDuplicates([*PRODUCER, "seq", "name", "type"])
    place = F.pmod("seq", F.lit(BLOCK))
    own = F.floor(F.col("seq") / BLOCK)
    blocks = F.when(place == BLOCK - 1, F.array(own, own + 1)).when(place == 0, F.array(own, own - 1)).otherwise(F.array(own))
    spread = one.withColumn("block", F.explode(blocks)).withColumn("context", F.col("block") != own)
    w = W.partitionBy(*PRODUCER, "name", "type", "block").orderBy("seq")
    marked = spread.withColumn("starts", ~F.coalesce(F.lag("seq").over(w) == F.col("seq") - 1, F.lit(False))).withColumn("ends", ~F.coalesce(F.lead("seq").over(w) == F.col("seq") + 1, F.lit(False)))
    return marked.filter(~F.col("context")).drop("context", "block")


def lifespans(index: DataFrame) -> DataFrame:
    """Starts and ends of every producer, field and type: one row per lifespan."""
    marked = islands(fields(sequenced(shards(index))))
    edge = lambda flag, alias: marked.filter(flag).select(*PRODUCER, "name", "type", F.col("seq").alias(alias))
    keys = [*PRODUCER, "name", "type"]
    w = W.partitionBy(*keys)
    first = edge("starts", "first_seq").withColumn("k", F.row_number().over(w.orderBy("first_seq")))
    last = edge("ends", "last_seq").withColumn("k", F.row_number().over(w.orderBy("last_seq")))
    return first.join(last, [*keys, "k"]).withColumnRenamed("k", "lifespan_no")


def changes(index: DataFrame) -> DataFrame:
    """(shard_id, column_name, change_kind) of each shard against the one
    written just before it in the same dataset and subdir.

    Built from the log of starts (at their shard) and ends (at the next shard).
    Of the events at one shard: a name that ends and starts is retyped; if both
    column lists are equally long, an end and a start at the same place with
    the same encoding are a renaming (under the old name) when each name is
    absent from the other list; other starts are added, other ends removed.
    The first shard of a producer has no changes.
    """
    marked = islands(fields(sequenced(shards(index))))
    begun = marked.filter("starts and seq > 1").select(*PRODUCER, "seq", F.struct("name", "type", "pos", "width").alias("s"), F.lit(None).cast("struct<name:string,type:string,pos:int,width:int>").alias("e"))
    ended = marked.filter("ends and seq < n_shards").select(*PRODUCER, (F.col("seq") + 1).alias("seq"), F.lit(None).cast("struct<name:string,type:string,pos:int,width:int>").alias("s"), F.struct("name", "type", "pos", "width").alias("e"))
    log = begun.unionByName(ended).groupBy(*PRODUCER, "seq").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    s_names, e_names = F.transform("s", lambda x: x["name"]), F.transform("e", lambda x: x["name"])
    both = F.array_intersect(s_names, e_names)
    new = F.filter("s", lambda x: ~F.array_contains(F.col("both"), x["name"]))
    old = F.filter("e", lambda x: ~F.array_contains(F.col("both"), x["name"]))
    renames = lambda a, b: (a["pos"] == b["pos"]) & (a["type"] == b["type"]) & (a["width"] == b["width"])
    ev = log.withColumn("both", both).withColumn("new", new).withColumn("old", old)
    # A name that kept its type beside another entry of that name is in both lists.
    shard = sequenced(shards(index)).select(*PRODUCER, "seq", "shard_id", "names")
    before = shard.select(*PRODUCER, (F.col("seq") + 1).alias("seq"), F.col("names").alias("names_before"))
    ev = ev.join(shard, [*PRODUCER, "seq"]).join(before, [*PRODUCER, "seq"])
    ev = ev.withColumn("new", F.filter("new", lambda x: ~F.array_contains("names_before", x["name"]))).withColumn("old", F.filter("old", lambda x: ~F.array_contains("names", x["name"])))
    longest = F.size("names") == F.size("names_before")
    renamed = F.filter("old", lambda o: longest & F.exists("new", lambda n: renames(n, o)))
    to = F.filter("new", lambda n: longest & F.exists("old", lambda o: renames(n, o)))
    kind = lambda arr, k: F.transform(arr, lambda x: F.struct(x["name"].alias("column_name"), F.lit(k).alias("change_kind")))
    retyped = F.transform("both", lambda n: F.struct(n.alias("column_name"), F.lit("retyped").alias("change_kind")))
    out = F.concat(retyped, kind(renamed, "renamed"), kind(F.array_except("old", renamed), "removed"), kind(F.array_except("new", to), "added"))
    return ev.select("shard_id", F.explode(out).alias("c")).select("shard_id", "c.column_name", "c.change_kind").distinct()


def casts(index: DataFrame) -> DataFrame:
    """(field, name, type, cast_to, n_producers): the cast of every field and
    type met, generated from the alias table; unknown names keep a string."""
    spark = index.sparkSession
    alias = spark.createDataFrame([(n, f, t) for f, t, names in ALIASES for n in names], "name string, field string, cast_to string")
    seen = fields(sequenced(shards(index))).groupBy("name", "type").agg(F.countDistinct(*PRODUCER).alias("n_producers"))
    j = seen.join(F.broadcast(alias), "name", "left")
    return j.select(F.coalesce("field", "name").alias("field"), "name", "type", F.coalesce("cast_to", F.lit("string")).alias("cast_to"), "n_producers")


def _entries(payload: str) -> Column:
    """A payload's entries, one a name in lower case without blanks: of several
    ways of writing a name the first with a value that is not empty counts."""
    kind = "array<struct<key:string,value:string>>"

    def one(e):
        value = F.coalesce(F.get_json_object(e["value"], "$.value"), e["value"])
        return F.struct(_name(e["key"]).alias("key"), F.nullif(value, F.lit("")).alias("value"))

    def merged(every):
        names = F.array_distinct(F.transform(every, lambda e: e["key"]))
        first = lambda n: F.get(F.filter(every, lambda e: (e["key"] == n) & e["value"].isNotNull()), F.lit(0))["value"]
        return F.transform(names, lambda n: F.struct(n.alias("key"), first(n).alias("value")))

    raw = F.map_entries(F.from_json(F.col(payload), "map<string,string>"))
    return F.when(F.rtrim(F.col(payload)).endswith("}"), let(F.transform(raw, one).cast(kind), merged))


def shard_casts(index: DataFrame) -> DataFrame:
    """(shard_id, field_of): for the columns a shard lists the field that the
    generated casts give their name and type."""
    of = casts(index).select("name", "type", "field")
    f = fields(sequenced(shards(index))).select("shard_id", "name", "type").distinct()
    return f.join(of, ["name", "type"]).groupBy("shard_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("name", "field")))).alias("field_of"))


def one_table(records: DataFrame, index: DataFrame, payload: str = "payload") -> DataFrame:
    """All records in the fields of the alias table.

    A payload is read as entries with lower-case, trimmed names, of which each
    counts once (the first that is not empty). A name's field is the one the
    generated casts give it for the record's shard, for a name its shard doesn't
    list that of the alias table. A field takes its first name with a non-empty
    value, in the order of the alias table, cast to the field's type (null if it
    can't be). A value given as an object of one value counts as that value.
    Null and cut-off payloads give a row of nulls with ``readable`` false; names
    outside the alias table are kept in ``other``. Records of unknown or null
    shards are kept.
    """
    ids = [c for c in records.columns if c in ("record_id", "shard_id")]
    m = records.select(*ids, _entries(payload).alias("__e")).join(shard_casts(index), "shard_id", "left") if "shard_id" in ids else records.select(*ids, _entries(payload).alias("__e"), F.lit(None).cast("map<string,string>").alias("field_of"))
    known = F.create_map(*[F.lit(x) for f, _, names in ALIASES for n in names for x in (n, f)])
    field = lambda e: F.coalesce(F.try_element_at("field_of", e["key"]), F.try_element_at(known, e["key"]), e["key"])
    placed = F.transform("__e", lambda e: F.struct(field(e).alias("field"), e["key"].alias("key"), e["value"].alias("value")))
    m = m.withColumn("__p", placed)

    def value(f: str, kind: str, names: list[str]) -> Column:
        order = F.array(*[F.lit(n) for n in names])
        mine = F.filter("__p", lambda e: (e["field"] == f) & e["value"].isNotNull())
        ranked = F.array_sort(F.transform(mine, lambda e: F.struct(F.array_position(order, e["key"]).alias("at"), e["value"].alias("value"))))
        return F.get(ranked, F.lit(0))["value"].try_cast(kind).alias(f)

    fields_ = [f for f, _, _ in ALIASES]
    rest = F.map_from_entries(F.transform(F.filter("__p", lambda e: ~e["field"].isin(fields_)), lambda e: F.struct(e["key"], e["value"])))
    return m.select(*ids, F.col("__e").isNotNull().alias("readable"), *[value(*a) for a in ALIASES], rest.alias("other"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(table(spark, sf_dir, "shard_index"))


def p2_lifespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifespans(table(spark, sf_dir, "shard_index"))


def p2_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casts(table(spark, sf_dir, "shard_index"))


def p2_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_table(table(spark, sf_dir, "shard_records"), table(spark, sf_dir, "shard_index"))
