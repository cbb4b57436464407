"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.session import checkpoint_dir

#: Shuffle files of a finished write go at once; what later steps need is in the written table.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

MASK64 = (1 << 64) - 1


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def stored(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder (Parquet, with the writer's ``options``) and read back.

    Cuts the lineage: whatever is lost later is read again from the files,
    which every executor reaches.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    with shuffles_released(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate = f"__{name}"
        while candidate.lower() in taken:
            candidate = f"_{candidate}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def set_apart(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with its columns of these ``names`` (case-insensitive) called ``input_<name>`` (or ``input_input_...``)."""
    taken, wanted, out = {c.lower() for c in df.columns}, {n.lower() for n in names}, []
    for c in df.columns:
        new = c
        while new.lower() in wanted or (new != c and new.lower() in taken):
            new = f"input_{new}"
        taken.add(new.lower())
        out.append(new)
    return df.toDF(*out)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix64(x: int) -> int:
    """One splitmix64 step: a well spread 64-bit value for ``x``."""
    x = (x + 0x9E3779B97F4A7C15) & MASK64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK64
    return x ^ (x >> 31)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer), picked by a hash of ``key``; reruns agree."""
    n = df.count()
    if n <= rows:
        return df
    grain = 1 << 30
    return df.filter(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(grain)) < int(grain * (rows / n)))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int) -> DataFrame:
    """id, text, y of a bounded sample of labelled documents outside the held-out remainder.

    The label is 0 or 1; rows with another, without a document or with two
    different labels are left out.  The sample of ids is of a fixed size at most, so it is broadcast.
    An id may have many rows: where the sampled ids have more than twice
    ``rows`` in all, rows are sampled by a hash of id and text, and equal rows count once.
    """
    y = F.col(label).cast("int")
    usable = labels.filter(F.col("doc_id").isNotNull() & y.isin(0, 1) & (remainder(F.col("doc_id"), divisor) != held_out))
    single = usable.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min(y).alias("y"), F.max(y).alias("y2"))
    single = single.filter(F.col("y") == F.col("y2")).select("label_id", "y")
    sample = bounded_sample(stored(single, "labels"), F.col("label_id"), rows)
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = plain.join(F.broadcast(sample), F.col("id") == F.col("label_id")).select("id", "text", "y")
    if found.select("id").count() <= 2 * rows:
        return found
    return bounded_sample(stored(found.distinct(), "labelled"), F.struct("id", "text"), rows)
