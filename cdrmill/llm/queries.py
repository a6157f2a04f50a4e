"""The registered queries: each operator over its whole table, digests of its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, forest, latent, lines, ppm, repair, shards, token_files, topk, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM f
    """
)
def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.warc_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.remove_repeats(table(spark, sf_dir, "documents"), whole_lines=True)
    return cut.select("doc_id", "text", "removed", "n_units", "n_removed")


@query()
def op3_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 5
    """
)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query()
def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), shards=8)


@query()
def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents"))


def toxicity_machine(docs: DataFrame, labels: DataFrame) -> toxicity.Machine:
    """Learns from the labels that are not held out."""
    return toxicity.learn(docs, labels, crc_of_id() % 3 != 1)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity_machine(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, machine).select(
        "doc_id",
        (crc_of_id() % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = bpe.round_trip(table(spark, sf_dir, "documents"))
    return told.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.token_round_trip(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ppm.score_texts(docs.withColumn("train", crc_of_id() % 7 != 2))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align.align_tokens(table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


@query(
    r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
    ), e AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body,
               replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS head
        FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                           FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length('### ' || head || ': ' || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """
)
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_example(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(rows))


@query()
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))))
