"""Document fingerprints by consistent weighted sampling, with DataFrame operations only.

The terms of a text are its words (lower-cased, between spaces and control white space), weighted by
how often they occur. For every sample k and term, hashes give r and c (gamma distributed, shape 2)
and beta (uniform). With t = floor(ln(weight) / r + beta), the term's value is
ln c - r * (t - beta + 1); the sample is the pair (term, t) of the smallest value. Two texts agree
on a sample with the probability of their generalised Jaccard similarity, sum of minima over sum
of maxima of the weights, so the share of equal samples estimates it.

A value and a hash of its pair are packed into one long, so a fingerprint is a row of minima: each
document's words are counted and its samples found in the partition that already holds the
document; only texts are shuffled, once, and the next document's first half.

Texts without words (null or empty) have the zero fingerprint and are alike. Rows without id are
left out; of rows repeated under one id, one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskflow.llm.common import stored

SAMPLES = 32


def _uniform(h: Column, shift: int) -> Column:
    """A number in (0, 1) from 16 bits of a hash."""
    bits = F.shiftrightunsigned(h, shift) if shift else h
    return (bits.bitwiseAND(F.lit(0xFFFF)) + F.lit(0.5)) * F.lit(2.0**-16)


def _packed(term: Column, log_weight: Column, k: int) -> Column:
    h, g = F.xxhash64(term, F.lit(k)), F.xxhash64(term, F.lit(-1 - k))
    r = -F.log(_uniform(h, 0) * _uniform(h, 16))  # gamma of shape 2: the sum of two exponentials
    c = -F.log(_uniform(h, 32) * _uniform(h, 48))
    beta = _uniform(g, 0)
    t = F.floor(log_weight / r + beta)
    value = F.log(c) - r * (t - beta + 1)
    pair = F.shiftrightunsigned(g, 20).bitwiseXOR(t * F.lit(40503)).bitwiseAND(F.lit(0xFFFF))
    # Values lie between -1000 and 10; 30 bits below the point keep their order.
    return F.shiftleft(((value + 1024) * float(1 << 30)).cast("long"), 16).bitwiseOR(pair)


def samples(texts: DataFrame, keys: list[str], number: int = SAMPLES) -> DataFrame:
    """Columns ``keys`` and sig (array of int): the samples of every text that has words.

    No shuffle if ``texts`` is partitioned by some of the keys.
    """
    words = F.split(F.lower(F.col("text")), "[\\x20\\x09-\\x0D]+")
    terms = texts.select(*keys, F.explode(words).alias("w")).where("w <> ''").select(*keys, F.xxhash64("w").alias("term"))
    weighted = terms.groupBy(*keys, "term").agg(F.log(F.count("*").cast("double")).alias("lw"))
    least = [F.min(_packed(F.col("term"), F.col("lw"), k)).alias(f"m{k}") for k in range(number)]
    found = weighted.groupBy(*keys).agg(*least)
    return found.select(*keys, F.array(*[F.col(f"m{k}").bitwiseAND(F.lit(0xFFFF)).cast("int") for k in range(number)]).alias("sig"))


def next_ids(docs: DataFrame) -> DataFrame:
    """Columns doc_id, n_chars, next_id (the following id; the first one's after the last).

    Ids are range-partitioned; only one row per partition meets in one place.
    """
    ids = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    ids = ids.where("doc_id is not null").dropDuplicates(["doc_id"]).repartitionByRange("doc_id")
    ids = stored(ids.withColumn("part", F.spark_partition_id()), "fingerprint-ids")
    parts = ids.groupBy("part").agg(F.min("doc_id").alias("first"))
    whole = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = parts.select(
        F.col("part").alias("of"),
        F.coalesce(F.lead("first").over(Window.partitionBy(F.lit(1)).orderBy("part")), F.min("first").over(whole)).alias("after"),
    )
    inside = Window.partitionBy("part").orderBy("doc_id")
    led = ids.withColumn("inner_next", F.lead("doc_id").over(inside))
    led = led.join(after, led["part"] == after["of"])
    return led.select("doc_id", "n_chars", F.coalesce("inner_next", "after").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """Columns doc_id, next_id, n_chars, text, edited: the last half replaced by the first half (as
    many code points) of the next document."""
    once = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
    once = once.dropDuplicates(["doc_id"])
    order = stored(next_ids(docs), "fingerprint-order")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    following = once.select(F.col("doc_id").alias("follower"), F.col("text").alias("next_text"))
    starts = order.join(following, order["next_id"] == following["follower"]).select(
        F.col("doc_id").alias("before"), "next_id", "n_chars", F.col("next_text").substr(F.lit(1), half).alias("start")
    )
    both = once.join(starts, once["doc_id"] == starts["before"])
    kept = F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half)
    return both.select("doc_id", "next_id", "n_chars", "text", F.concat(kept, "start").alias("edited"))


def hex_string(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda v: F.lower(F.lpad(F.hex(v), 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return equal / F.size(a).cast("double")


def report(docs: DataFrame, number: int = SAMPLES) -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = edited_texts(docs.select("doc_id", "text"))
    versions = F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("text").alias("t")), F.struct(F.lit(1).alias("v"), F.col("edited").alias("t"))))
    long = texts.select("doc_id", versions.alias("x")).select("doc_id", F.col("x.v").alias("version"), F.col("x.t").alias("text"))
    sigs = samples(long, ["doc_id", "version"], number)
    sigs = sigs.groupBy("doc_id").agg(
        F.max(F.when(F.col("version") == 0, F.col("sig"))).alias("own"), F.max(F.when(F.col("version") == 1, F.col("sig"))).alias("changed")
    )
    base = texts.select("doc_id", "next_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"))
    none = F.array_repeat(F.lit(0), number)
    found = base.join(sigs.withColumnRenamed("doc_id", "sig_id"), F.col("doc_id") == F.col("sig_id"), "left").select(
        "doc_id", "next_id", "n_chars", "edited_sha256", F.coalesce("own", none).alias("own"), F.coalesce("changed", none).alias("changed")
    )
    found = stored(found, "fingerprints")
    others = found.select(F.col("doc_id").alias("other_id"), F.col("own").alias("other"))
    joined = found.join(others, found["next_id"] == others["other_id"])
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_string(F.col("own")).alias("fingerprint"),
        hex_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )
