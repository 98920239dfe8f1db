"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navrecon.llm import (common, dac, exact_dedup, language, line_dedup, mixing, near_dedup, negatives, packing, secrets,
                           sharding, topk, toxicity, vector_codes)
from navrecon.session import fresh_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_shortest_pack_first(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    return packing.pack(common.table(spark, folder, "documents"), WORDS, 2048)


def op2_polynomial_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact_dedup.exact_groups(common.table(spark, folder, "documents"))


def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return near_dedup.near_groups(common.table(spark, folder, "documents"))


def op4_addressable_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written as directly addressable codes and read back."""
    path = fresh_dir(spark, "token-ids")
    dac.write_ids(common.table(spark, folder, "documents"), path, WORDS)
    docs = dac.read_documents(spark, path)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_owned_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, with ownership over the corpus."""
    found = secrets.find_secrets(common.table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.spans_text(F.col("secrets"), secrets.BASE), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("secrets")).alias("spans"), "n_owned", "n_copied",
                        "n_live_all", "n_copied_all")


def op6_balanced_propagation(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7, equal texts together as far as the balance of rows allows."""
    placed = sharding.assign_shards(common.table(spark, folder, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "linked")


def op7_shared_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document after lines that others hold were dropped."""
    kept = line_dedup.dedup_lines(common.table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_histogram_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all vectors for every query vector."""
    vectors = common.table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def op9_temperature_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as often as the mixture asks, with their place in it."""
    mixed = mixing.mix_sources(common.table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "source_weight", "mix_copy", "mix_block", "mix_at")


def op10_chain_field(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, common.table(spark, folder, "labels"))
    told = toxicity.score_documents(docs, model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return told.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"),
                       (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
                       F.size("toxic_spans").alias("n_spans"))


def op11_vertical_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, where every seventh has another label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(common.table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, by models of the three quarters that are not held out."""
    docs = common.table(spark, folder, "documents").select("doc_id", "text", "lang")
    quarter = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    told = language.identify(docs.select("doc_id", "text"), language.train(docs, quarter != 2))
    return told.select("doc_id", F.coalesce(quarter == 2, F.lit(False)).alias("held_out"), "lang_pred",
                       F.col("lang_score").alias("score"), F.col("lang_entropy").alias("entropy"),
                       F.col("lang_rejected").alias("rejected"))


def op13_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors, their errors, and the digest of the codebooks."""
    coded, books = vector_codes.compress(common.table(spark, folder, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.books_sha256(books)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_shortest_pack_first, op2_polynomial_dedup, op3_order_minhash, op4_addressable_codes,
                            op5_owned_secrets, op6_balanced_propagation, op7_shared_lines, op8_histogram_top_k,
                            op9_temperature_mixture, op10_chain_field, op11_vertical_scan, op12_kneser_ney,
                            op13_dual_tree)}

STRIP = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds written out, one after the other."""
    assign = """a{r} AS MATERIALIZED (SELECT p.vec_id, p.part, arg_min(k.entry, (d.d, k.entry)) AS entry, min(d.d) AS d
        FROM p JOIN k{r} AS k ON p.part = k.part,
        LATERAL (SELECT CAST(list_sum(list_transform(list_zip(p.x, k.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d) AS d
        GROUP BY p.vec_id, p.part)"""
    move = """u{n} AS MATERIALIZED (SELECT a.part, a.entry, i.i, CAST(sum(p.x[i.i]) AS HUGEINT) AS s, count(*) AS n
        FROM a{r} AS a JOIN p ON a.vec_id = p.vec_id AND a.part = p.part, (SELECT unnest(range(1, {most})) AS i) AS i
        WHERE i.i <= len(p.x) GROUP BY a.part, a.entry, i.i),
        w{n} AS MATERIALIZED (SELECT part, entry, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS c
        FROM u{n} GROUP BY part, entry),
        k{n} AS MATERIALIZED (SELECT k.part, k.entry, coalesce(w.c, k.c) AS c FROM k{r} AS k
        LEFT JOIN w{n} AS w ON k.part = w.part AND k.entry = w.entry)"""
    steps = [assign.format(r=0)]
    for r in range(rounds):
        steps += [move.format(r=r, n=r + 1, most=1025), assign.format(r=r + 1)]
    return f"""
        WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE {FINITE}),
        p AS MATERIALIZED (SELECT vec_id, part, list_slice(e, part * (len(e) // {parts}) + 1, (part + 1) * (len(e) // {parts})) AS x
              FROM v, (SELECT unnest(range({parts})) AS part)),
        k0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c
               FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}),
        {", ".join(steps)},
        codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
                  FROM a{rounds} GROUP BY vec_id),
        told AS (SELECT codes.*, v.label FROM codes JOIN v ON codes.vec_id = v.vec_id),
        digest AS (SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: CAST(x AS VARCHAR)), 'string_agg', ','),
                                            ',' ORDER BY part, entry)) AS sha FROM k{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               digest.sha AS codebooks_sha256
        FROM told, digest"""


ORACLE: dict[str, str] = {
    "op2_polynomial_dedup": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          translate(coalesce(text, ''), {STRIP}, '') AS s FROM documents),
        best AS (SELECT s, count(*) AS n, arg_min(doc_id, (-length(t), doc_id)) AS keep_id FROM d GROUP BY s)
        SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(d.s) AS text_sha256
        FROM d JOIN best ON d.s = best.s""",
    "op7_shared_lines": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        keyed AS (SELECT *, trim(translate(line, '{common.UPPER}', '{common.LOWER}'), {STRIP}) AS k FROM lines),
        shared AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10
                   GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
        marked AS (SELECT keyed.*, first IS NOT NULL AND doc_id <> first AS gone
                   FROM keyed LEFT JOIN shared ON keyed.k = shared.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op8_histogram_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id,
                     CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20""",
    "op11_vertical_scan": f"""
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE label IS NOT NULL AND {FINITE}),
        s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same,
                     CAST(list_sum(list_transform(list_zip(a.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS n
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
              AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
        SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE n <= 5""",
    "op13_dual_tree": lloyd_sql(),
}
