"""The registered queries of this subpackage: thin callers of the operators."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.llm import align, ann, bytebpe, chat, decontaminate, langid, merkle, mixing, quality, sharding, simhash, substring, toxicity
from accrualkit.llm.common import documents, remainder, stored, table

SHARDS = 8
#: A conversation of control strings, beside the table's own.
CONTROL_ID = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"
CONTROL_TURNS = [{"role": role, "content": CONTROL_TEXT} for role in ("user", "assistant")]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text", "source").alias("h"),
        "source", mixing.word_count(F.col("text")).alias("size"),
    )
    return mixing.mix(rows).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    score = quality.scorer(quality.train(docs, table(spark, sf_dir, "labels"), "quality", 4, 2))
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.turns_from_table(table(spark, sf_dir, "conversations"))
    extra = chat.turns_from_json(
        spark.createDataFrame([(CONTROL_ID, json.dumps({"messages": CONTROL_TURNS}))], "id long, record string"), "id", "record"
    ).drop("layout")
    pieces = stored(chat.format_turns(turns.unionByName(extra)), "formatted")
    return chat.read_back(pieces).withColumnRenamed("conv", "conv_id")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), 3) == 1
    predict = langid.predictor(langid.train(docs.filter(~held_out)))
    named = docs.select("doc_id", held_out.alias("held_out"), predict(F.col("text")).alias("p"))
    return named.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    score = toxicity.scorer(toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", 5, 0))
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(documents(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", *sharding.shard_sizes(F.col("text")))
    placed = sharding.shard(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ann.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = ann.search(rows, rows.filter(F.col("id") % 50 == 0))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op11_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bytebpe.coded(documents(spark, sf_dir), F.col("text"), [F.col("doc_id")], ranks, public_tokenizers.PATTERN)
    return both.select(
        "doc_id", bytebpe.id_count(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_, pieces = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = align.align(documents(spark, sf_dir), F.col("text"), [F.col("doc_id")], bytes_, pieces, digest=True)
    return rows.withColumnRenamed("grouping", "groups_sha256")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    leaf = merkle.leaf_digest(*fields(F.col("n_chars")))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_digest(*fields(F.col("n_chars") + 1)))
    tree = merkle.manifest(documents(spark, sf_dir), F.col("lang"), [F.col("doc_id")], leaf, [F.col("doc_id"), tampered.alias("tampered")])
    proven = tree.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_chat": op3_chat,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_substring": op8_substring,
    "op9_sharding": op9_sharding,
    "op10_ann": op10_ann,
    "op11_bytebpe": op11_bytebpe,
    "op12_align": op12_align,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op3_chat": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT {CONTROL_ID}, 0, 'user', '{CONTROL_TEXT}'
            UNION ALL SELECT {CONTROL_ID}, 1, 'assistant', '{CONTROL_TEXT}'
        ), escaped AS (
            SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length('### ') + length(role) + length(':') + 1 + length(body) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op5_decontamination": r"""
        WITH items AS (
            SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark
        ), sized AS (
            SELECT item_id, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
        ), item_shingles AS (
            SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
        ), words AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents
        ), doc_shingles AS (
            SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM words, (SELECT DISTINCT k FROM sized) ks WHERE len(w) >= k)
        ), sizes AS (
            SELECT item_id, count(*) AS shingles FROM item_shingles GROUP BY item_id
        )
        SELECT doc_id, item_id, count(*) AS shared, any_value(shingles) AS shingles,
            count(*) / any_value(shingles) AS containment
        FROM doc_shingles JOIN item_shingles USING (k, s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(shingles)
    """,
    "op13_merkle": r"""
        WITH RECURSIVE fields AS (
            SELECT *,
                list_reduce([4294967295::UBIGINT] || flatten([
                    [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(doc_id::VARCHAR, '')
                ]), lambda crc, b: xor(xor(crc, b) >> 1, (xor(crc, b) % 2) * 3988292384::UBIGINT)) AS crc,
                concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-')) AS head,
                coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM documents
        ), hashed AS (
            SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0
                    THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS tampered
            FROM fields
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
            FROM hashed
        ), nodes(lang, level, idx, n, digest) AS (
            SELECT lang, 0, idx, n, leaf FROM leaves
            UNION ALL
            SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
            FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n
        ), subroots AS (
            SELECT lang, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), tops(level, idx, n, digest) AS (
            SELECT 0, idx, n, digest FROM subroots
            UNION ALL
            SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
            FROM tops WHERE n > 1 GROUP BY level, idx // 2, n
        ), steps AS (
            SELECT w.lang, w.idx, w.at AS level, (w.idx >> w.at) % 2 AS own, s.digest AS sibling
            FROM (SELECT l.lang, l.idx, unnest(range(r.height)) AS at FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang) w
            LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.at AND s.idx = xor(w.idx >> w.at, 1)
        ), heights AS (SELECT max(level) AS height FROM tops),
        upper_steps AS (
            SELECT w.lang, w.height + w.at AS level, (w.idx >> w.at) % 2 AS own, t.digest AS sibling
            FROM (SELECT r.lang, r.idx, r.height, unnest(range(h.height)) AS at FROM subroots r, heights h) w
            LEFT JOIN tops t ON t.level = w.at AND t.idx = xor(w.idx >> w.at, 1)
        ), paths AS (
            SELECT * FROM steps
            UNION ALL
            SELECT l.lang, l.idx, u.level, u.own, u.sibling FROM leaves l JOIN upper_steps u ON l.lang IS NOT DISTINCT FROM u.lang
        ), proofs AS (
            SELECT lang, idx, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY level)) AS proof_sha256 FROM paths GROUP BY lang, idx
        ), folds(lang, idx, level, digest) AS (
            SELECT lang, idx, 0, coalesce(tampered, leaf) FROM leaves
            UNION ALL
            SELECT f.lang, f.idx, f.level + 1,
                sha256(CASE WHEN p.own = 0 THEN f.digest || coalesce(p.sibling, '') ELSE p.sibling || f.digest END)
            FROM folds f JOIN paths p ON f.lang IS NOT DISTINCT FROM p.lang AND f.idx = p.idx AND f.level = p.level
        ), ends AS (
            SELECT lang, idx, arg_max(digest, level) AS folded_root FROM folds GROUP BY lang, idx
        )
        SELECT l.doc_id, l.leaf, r.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
            coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
            e.folded_root = (SELECT digest FROM tops WHERE n = 1) AS verified
        FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
        LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.idx = l.idx
        JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.idx = l.idx
    """,
}
