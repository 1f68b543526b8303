"""Shared pieces: text splitting on UTF-8 bytes, stable hashes, stored tables, label choice."""

from __future__ import annotations

from collections.abc import Callable

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.prefilter import keep_possible
from riskflow.session import scratch_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Upper-case ASCII to lower case; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: As LOWER, and every ASCII byte that is no letter or digit becomes a space.
LOWER_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def space_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between spaces and control white space (0x09-0x0D)."""
    return text.translate(LOWER).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters and digits and of bytes above 0x7F."""
    return text.translate(LOWER_ALNUM).split() if text else []


class HashCache(dict):
    """Word to a stable 64-bit hash; forgets everything when it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000) -> None:
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


#: Files of an exchange go when its query has ended, not when the driver collects its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives the
    loss of executors, and keeps later passes from computing it again. With ``tidy`` the exchanges
    that made it leave no files behind."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(TIDY)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: Column, parts: int, out: int) -> Column:
    """True where crc32 of the key as text has remainder ``out``; a null key never has."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == out, F.lit(False))


def chosen_labels(labels: DataFrame, column: str, rows: int | None = None, where: Column | None = None) -> DataFrame:
    """All labelled ids, one row per id; with ``rows``, that many in a fixed pseudo-random order.

    Rows without id or label are left out; an id labelled twice takes its largest label. Without
    ``rows`` the result grows with the labels. It is stored, so that its size is known to joins.
    """
    known = labels.select(
        F.col("doc_id").alias("label_id"), F.col(column).cast("int").alias("label")
    ).where("label_id is not null and label is not null")
    if where is not None:
        known = known.where(where)
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    if rows is not None:
        known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    return stored(known, f"labels-{column}")


def labelled(docs: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the documents that ``labels`` (label_id, label; an id once) names, and ``label``.

    A bitmap of the ids drops other documents before the exchange, so only labelled texts are moved;
    the join is the same at every size, so the share of the corpus it moves is too.
    """
    rows = docs.select(F.col("doc_id").alias("label_id"), *columns)
    if rows.schema["label_id"].dataType == labels.schema["label_id"].dataType:  # else equal ids may hash apart
        rows = keep_possible(rows, "label_id", labels)
    return rows.join(labels.hint("shuffle_hash"), "label_id").select(*columns, "label")


def per_text(docs: DataFrame, name: str, function: Callable, schema: str) -> DataFrame:
    """Add column ``name``: an Arrow function of the text as bytes. Only the text goes to Python."""
    udf = F.arrow_udf(function, returnType=schema)
    return docs.withColumn(name, udf(F.col("text").cast("binary")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
