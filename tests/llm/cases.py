"""Small document tables with the odd cases every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
CLASHING = ("id", "h", "fp", "size", "rank", "copies", "score", "shard", "slot", "key", "cell", "block", "spans", "uid", "doc", "y", "label_id", "kept_id", "__h", "__copies")


def document_frame(spark, rows, extra=False):
    """rows: (doc_id, text[, lang[, source]]); ``extra`` adds columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def odd_texts():
    rng = random.Random(4)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(60_000))
    return [
        (1, "one two three four five six seven"), (2, None), (3, ""), (4, "   \n\t "), (5, "x"), (6, long),
        (7, "one two three four five six seven"), (None, "text without an id at all"), (None, None),
        (8, "repeated row here"), (8, "repeated row here"), (9, "é" * 300), (10, "中文 \U0001f600 mixed"),
    ]
