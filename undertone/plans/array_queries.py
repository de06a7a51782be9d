"""Waveform arrays and linear algebra over embeddings (inventory 2.11, 2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from undertone.functions import arrays as a
from undertone.functions.keyed import hashed, key
from undertone.functions.tokens import let
from undertone.operators import linalg
from undertone.plans.base import query
from undertone.plans.sampling_queries import H
from undertone.sources.tables import table

X = "e AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::double) AS x FROM embeddings)"


def vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))


def checksum(c):
    """Sum of values weighted by their place, to compare arrays across engines."""
    return F.round(F.aggregate(F.transform(c, lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v), 5)


SUM = "round(list_sum(list_transform({}, lambda v, i: v * i)), 5)"
STD = "list_transform({x}, lambda v: (v - list_avg({x})) / list_stddev_pop({x}))"


@query("vec_normalize", f"WITH {X} SELECT vec_id, {SUM.format('list_transform(x, lambda v: v / list_max(list_transform(x, lambda w: abs(w))))')} AS s FROM e")
def vec_normalize(spark, d):
    """X1."""
    return vectors(spark, d).select("vec_id", checksum(a.normalized(F.col("x"))).alias("s"))


@query("vec_standardize", f"WITH {X}, m AS (SELECT *, list_avg(x) AS mu, list_stddev_pop(x) AS sd FROM e) SELECT vec_id, round(round(list_sum(list_transform(x, lambda v, i: (v - mu) / sd * i)), 5), 3) AS s FROM m")
def vec_standardize(spark, d):
    """X2."""
    return vectors(spark, d).select("vec_id", F.round(checksum(a.standardized(F.col("x"))), 3).alias("s"))


@query("vec_pad", f"WITH {X} SELECT vec_id, 80 AS n, {SUM.format('x')} AS s FROM e")
def vec_pad(spark, d):
    """Zero padding."""
    p = vectors(spark, d).withColumn("p", a.padded(F.col("x"), 80))
    return p.select("vec_id", F.size("p").alias("n"), checksum(F.col("p")).alias("s"))


@query("snr_mix", f"WITH {X}, m AS (SELECT *, list_reverse(x) AS nz, list_sum(list_transform(x, lambda v: v * v)) / len(x) AS p, list_avg(x) AS mu, list_stddev_pop(x) AS sd FROM e) SELECT vec_id, round(round(list_sum(list_transform(x, lambda v, i: (v + sqrt(p / power(10, 10.0 / 10.0)) * (nz[i] - mu) / sd) * i)), 5), 3) AS s FROM m")
def snr_mix(spark, d):
    """Noise at 10 dB."""
    return vectors(spark, d).select("vec_id", F.round(checksum(a.with_noise(F.col("x"), F.reverse("x"), F.lit(10.0))), 3).alias("s"))


@query("noise_gate", f"WITH {X} SELECT vec_id, {H.format(chr(39) + 'noise:' + chr(39) + ' || vec_id')} / 1152921504606846976.0 < 0.5 AS noisy, round(5 + 15 * ({H.format(chr(39) + 'snr:' + chr(39) + ' || vec_id')} / 1152921504606846976.0), 6) AS snr FROM e")
def noise_gate(spark, d):
    """Keyed choice whether, and at which ratio, noise is added."""
    from undertone.functions.keyed import uniform

    return table(spark, d, "embeddings").select("vec_id", (uniform(key("noise", F.col("vec_id"))) < 0.5).alias("noisy"), F.round(5 + 15 * uniform(key("snr", F.col("vec_id"))), 6).alias("snr"))


@query("crowd_mix", f"WITH {X}, w AS (SELECT vec_id, x, list_reverse(x) AS y, ({H.format(chr(39) + 'a:' + chr(39) + ' || vec_id')} % 64)::int AS s1, ({H.format(chr(39) + 'b:' + chr(39) + ' || vec_id')} % 64)::int AS s2 FROM e), c AS (SELECT vec_id, list_transform(range(32), lambda i: x[((s1 + i) % 64 + 1)::int]) AS p, list_transform(range(32), lambda i: y[((s2 + i) % 64 + 1)::int]) AS q FROM w), k AS (SELECT *, list_max(list_transform(p, lambda v: abs(v))) AS mp, list_max(list_transform(q, lambda v: abs(v))) AS mq FROM c) SELECT vec_id, round(round(list_sum(list_transform(p, lambda v, i: (v / mp + q[i] / mq) * i)), 5), 3) AS s FROM k")
def crowd_mix(spark, d):
    """Keyed windows of two repeated clips, normalised and summed."""
    start = lambda k: F.pmod(hashed(key(k, F.col("vec_id"))), F.lit(64)).cast("int")
    v = vectors(spark, d).withColumn("clips", F.array("x", F.reverse("x"))).withColumn("starts", F.array(start("a"), start("b")))
    return v.select("vec_id", F.round(checksum(a.windows_sum(F.col("clips"), F.col("starts"), 32)), 3).alias("s"))


@query("peak_guard", f"WITH {X}, g AS (SELECT vec_id, list_transform(x, lambda v: v * 4) AS y FROM e) SELECT vec_id, {SUM.format('CASE WHEN list_max(list_transform(y, lambda w: abs(w))) > 1 THEN list_transform(y, lambda v: v / list_max(list_transform(y, lambda w: abs(w)))) ELSE y END')} AS s FROM g")
def peak_guard(spark, d):
    """K7."""
    return vectors(spark, d).select("vec_id", checksum(a.peak_guard(F.transform("x", lambda v: v * 4))).alias("s"))


def summed(y):
    """Length and checksum of an effect's values, and their peak."""
    return F.size(y).alias("n"), F.round(checksum(y), 6).alias("s"), F.round(a.peak(y), 6).alias("peak")


@query("rir_effect")
def rir_effect(spark, d):
    """X5."""
    return vectors(spark, d).select("vec_id", a.room(F.col("x"), F.col("vec_id")).alias("y")).select("vec_id", *summed(F.col("y")))


@query("speed_effect")
def speed_effect(spark, d):
    """X6."""
    return vectors(spark, d).select("vec_id", a.stretched(F.col("x"), F.lit(1.1)).alias("y")).select("vec_id", *summed(F.col("y")))


@query("pitch_effect")
def pitch_effect(spark, d):
    """X7."""
    return vectors(spark, d).select("vec_id", a.pitched(F.col("x"), F.lit(2.0)).alias("y")).select("vec_id", *summed(F.col("y")))


@query("single_effect")
def single_effect(spark, d):
    """Keyed choice of one effect; an effect runs on its own rows only."""
    k = F.pmod(hashed(key("effect", F.col("vec_id"))), F.lit(10))
    v = vectors(spark, d).withColumn("effect", F.when(k < 3, "speed").when(k < 6, "rir").when(k < 8, "pitch").otherwise("still"))
    x, of = F.col("x"), lambda name: F.when(F.col("effect") == name, F.col("x"))
    y = F.coalesce(a.room(of("rir"), F.col("vec_id")), a.stretched(of("speed"), F.lit(1.1)), a.pitched(of("pitch"), F.lit(-1.0)), x)
    return v.select("vec_id", "effect", y.alias("y")).select("vec_id", "effect", *summed(F.col("y")))


@query("crowd_clips")
def crowd_clips(spark, d):
    """Crowd noise from two of the eight clips before a row in a keyed
    order; rows without two have none."""
    v = a.background_clips(vectors(spark, d), "vec_id", "x", 9176)
    start = lambda k: F.pmod(hashed(key(k, F.col("vec_id"))), F.lit(64)).cast("int")
    crowd = F.when(F.size("background") > 1, a.windows_sum(F.slice("background", 1, 2), F.array(start("a"), start("b")), 32))
    return v.select("vec_id", F.size("background").alias("n_clips"), F.round(checksum(crowd), 3).alias("s"))


@query("augment_batch")
def augment_batch(spark, d):
    """Effect, crowd from a keyed pair, then noise at a keyed ratio."""
    from undertone.functions.keyed import uniform

    x = F.col("x")

    def noisy(y):
        noise = F.slice(F.concat(F.reverse(x), F.reverse(x)), 1, F.size(y))
        return F.when(uniform(key("p", F.col("vec_id"))) < 0.8, a.with_noise(y, noise, 5 + 15 * uniform(key("snr", F.col("vec_id"))))).otherwise(y)

    moved = vectors(spark, d).select("vec_id", "x", a.stretched(x, 0.9 + 0.2 * uniform(key("rate", F.col("vec_id")))).alias("y"))
    done = moved.select("vec_id", let(noisy(F.col("y")), a.peak_guard).alias("y"))
    return done.select("vec_id", F.size("y").alias("n"), F.round(a.peak(F.col("y")), 4).alias("peak"))


@query("wav_roundtrip")
def wav_roundtrip(spark, d):
    """Samples through WAV bytes and back."""
    v = vectors(spark, d).withColumn("w", a.encode_wav(F.col("x"))).withColumn("y", a.decode_wav(F.col("w")))
    return v.select("vec_id", F.size("y").alias("n"), F.round(a.seconds_of(F.col("w")), 6).alias("seconds"))


@query("adapter_mean", "SELECT label, round(sum(m * i), 5) AS s FROM (SELECT label, i, avg(v) AS m FROM (SELECT label, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label")
def adapter_mean(spark, d):
    """L1."""
    m = linalg.mean_vectors(vectors(spark, d), ["label"], "x")
    return m.select("label", checksum(F.col("x")).alias("s"))


def parts(spark, d):
    """Modules of 80 vectors each: four adapters of rank 4, A (4 x 16) and B
    (16 x 4); a part that the last module lacks counts as zeros."""
    v = vectors(spark, d).withColumn("name", F.concat(F.lit("m"), F.floor(F.col("vec_id") / 80).cast("string"))).withColumn("part", F.floor(F.col("vec_id") % 80 / 20)).withColumn("r", F.col("vec_id") % 20)
    a_ = v.filter("r < 4").select("part", "name", F.lit("A").alias("side"), F.col("r").alias("row"), F.slice("x", 1, 16).alias("vec"))
    b_ = v.filter("r >= 4").select("part", "name", F.lit("B").alias("side"), (F.col("r") - 4).alias("row"), F.slice("x", 17, 4).alias("vec"))
    return a_.unionByName(b_)


@query("adapter_concat_check", "SELECT DISTINCT 'm' || (vec_id // 80) AS name, true AS exact FROM embeddings")
def adapter_concat_check(spark, d):
    """L2, L3: the joined factors give the mean of the products."""
    p = parts(spark, d)
    c = linalg.concat_adapters(p, "part", "name", "side", "row", "vec", 4)
    joined = linalg.product(c.filter("side = 'B'"), c.filter("side = 'A'"), "name")
    each = p.select("part", F.concat_ws("/", "name", "part").alias("name"), "side", F.col("row").alias("i"), F.posexplode("vec").alias("j", "v"))
    single = linalg.product(each.filter("side = 'B'"), each.filter("side = 'A'"), "name")
    mean = single.groupBy(F.split_part("name", F.lit("/"), F.lit(1)).alias("name"), "i", "j").agg((F.sum("v") / 4).alias("v"))
    return linalg.relative_error(joined, mean, "name").select("name", (F.col("error") < 2e-2).alias("exact"))


@query("adapter_compat", "SELECT label AS name, count(DISTINCT len(embedding)) AS n_shapes, count(DISTINCT vec_id % 4) AS n_parts FROM embeddings GROUP BY label HAVING count(DISTINCT len(embedding)) <> 1 OR count(DISTINCT vec_id % 4) <> 4")
def adapter_compat(spark, d):
    """L4: names whose shape differs or that a part lacks."""
    e = table(spark, d, "embeddings").select((F.col("vec_id") % 4).alias("part"), F.col("label").alias("name"), F.size("embedding").alias("shape"))
    return linalg.incompatible(e, "part", "name", "shape")
