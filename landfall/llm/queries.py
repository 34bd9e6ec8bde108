"""The corpus operators as registered queries, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.bpe import encode_decode
from landfall.llm.exact_dedup import exact_dedup
from landfall.llm.language_id import evidence_of_documents, evidence_of_pages, identify
from landfall.llm.line_dedup import line_dedup
from landfall.llm.lm_scoring import lm_scoring
from landfall.llm.packing import pack_documents
from landfall.llm.periodic_runs import collapse_runs, planted
from landfall.llm.quality_rules import quality_rules
from landfall.llm.sharding import shards_in_shared_folder
from landfall.llm.simhash import simhash_groups
from landfall.llm.substring_dedup import substring_dedup
from landfall.llm.toxicity import toxicity
from landfall.llm.vector_codes import vector_codes

SEQUENCE = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (declared language, source as host) and every page (markup, address, host)."""
    own = F.coalesce(F.col("doc_id"), F.lit(-1).cast("long"))
    of_docs = evidence_of_documents(documents(spark, sf_dir), own)
    of_pages = evidence_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    # Even keys are documents, odd ones pages: both learn from each other's votes.
    rows = of_docs.withColumn("row_key", 2 * F.col("row_key")).unionByName(of_pages.withColumn("row_key", 2 * F.col("row_key") + 1))
    found = identify(rows)
    is_page = F.col("row_key").bitwiseAND(1) == 1
    key = F.shiftright("row_key", 1)
    return found.select(
        F.when(~is_page & (key >= 0), key).alias("doc_id"), F.when(is_page, key).alias("page_id"),
        "declared", "lang", "confidence", "n_grams", "kept",
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(documents(spark, sf_dir), 5)
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    """The packing's digest: pieces with a checksum in place of their ids."""
    done = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE, 0)
    return done.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the written shards, read back; law: row counts one apart at most."""
    done = shards_in_shared_folder(documents(spark, sf_dir), 16)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return done.select(
        "row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return encode_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, digests=True)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(documents(spark, sf_dir), 13)
    return done.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(documents(spark, sf_dir), 4, 4)
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring(documents(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_runs(documents(spark, sf_dir), arranged=planted).drop("collapsed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_toxicity": op11_toxicity,
    "op12_vector_codes": op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
}


def _lloyd_sql(rounds: int) -> str:
    """Product codes in SQL: all distances, in as many rounds; for small tables."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
        away{turn} AS MATERIALIZED (
            SELECT row_key, part, entry, sum((p.x - e.x) * (p.x - e.x)) AS distance
            FROM points p JOIN entries{turn} e USING (part, place) GROUP BY row_key, part, entry
        ), nearest{turn} AS MATERIALIZED (
            SELECT row_key, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance
            FROM away{turn} GROUP BY row_key, part
        )""")
        if turn < rounds:
            steps.append(f"""
        entries{turn + 1} AS MATERIALIZED (
            SELECT part, entry, place, coalesce(mean, x) AS x
            FROM entries{turn} LEFT JOIN (
                SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS mean
                FROM points JOIN nearest{turn} USING (row_key, part) GROUP BY part, entry, place
            ) USING (part, entry, place)
        )""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS row_key, vec_id, label,
                   [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), points AS MATERIALIZED (
            SELECT row_key, (i // (n // 4))::INT AS part, (i % (n // 4))::INT AS place, x
            FROM (SELECT row_key, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS i FROM kept)
        ), entries0 AS MATERIALIZED (
            SELECT part, row_key AS entry, place, x FROM points WHERE row_key < 256
        ), {",".join(steps)}, coded AS (
            SELECT row_key, string_agg(lower(printf('%02X', entry::INT)), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
            FROM nearest{rounds} GROUP BY row_key
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM entries{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (row_key)
    """


ORACLES = {
    "op3_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, source, j, line, trim(line, E' \t\n\x0b\x0c\r') AS bare
            FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), E'\n')) AS line,
                         generate_subscripts(string_split(coalesce(text, ''), E'\n'), 1) AS j FROM documents)
        ), spread AS (
            SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 5
        ), judged AS (
            SELECT lines.*, bare IN (SELECT bare FROM spread) AS gone FROM lines
        )
        SELECT doc_id, count(*) FILTER (bare <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(line, E'\n' ORDER BY j) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op1_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)
    """,
    "op8_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, i, words[i:i + 12] AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)
        ), firsts AS (
            SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w
        ), gone AS (
            SELECT DISTINCT doc_id, i + k AS j
            FROM windows JOIN firsts USING (w), (SELECT unnest(range(0, 13)) AS k)
            WHERE first_id < doc_id
        ), kept AS (
            SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY j) AS t
            FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM split)
            ANTI JOIN gone USING (doc_id, j)
            GROUP BY doc_id
        )
        SELECT split.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM split LEFT JOIN kept ON kept.doc_id = split.doc_id
    """,
    "op12_vector_codes": _lloyd_sql(4),
}
