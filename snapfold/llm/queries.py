"""The registered query of each operator: the operator on its whole table, reduced to the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapfold.llm import bpe, clustering, rans, suffixes
from snapfold.llm.common import stage, table
from snapfold.llm.decisions import STATS, document_stats, learn_rules
from snapfold.llm.embeddings import embedding_links
from snapfold.llm.ngrams import score_documents
from snapfold.llm.packing import packed_documents
from snapfold.llm.pages import extract
from snapfold.llm.phrases import remove_repeats
from snapfold.llm.sharding import minimax_shards
from snapfold.llm.simhash import near_duplicates
from snapfold.llm.whitening import whiten
from snapfold.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ANSWERS: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the fixed base rule, and the learned verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stage(document_stats(docs).drop("text"), "document-stats")
    rules = learn_rules(stats, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select(
        "doc_id",
        *STATS,
        failed.alias("base_failed"),
        (~failed & rules.keep()).alias("kept"),
    )


@query
def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@query
def op6_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoding, as digests."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        # An array in JSON is its numbers joined by commas, without a string for each of them.
        F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per piece of every document, with its place in a sequence."""
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_rans_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as rANS blocks and read back."""
    path = scratch_dir(spark, "rans")
    rans.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return rans.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embedding_links(vectors).select("vec_id", "n_links", "component_id", "kept")


@query
def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document after removing repeated windows."""
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_words").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left in every document after removing repeated strings, and as text: a character cut in two is replaced."""
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.make_valid_utf8(F.col("kept_bytes").cast("string"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"), text.alias("kept_text"))


@query
def op5_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_block_matrix_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per embedding and component of the whitened space."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*[F.lit(e) for e in found.explained]).cast("array<double>")
    long = found.rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(found.fitted).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )


@query
def op12_lookup_table_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every embedding, with the figures of its cluster."""
    found = clustering.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    # A row for each centroid: what is known of it, and the sum of all.
    per = found.centroids.select(
        "cluster",
        F.col("inertia").try_cast("long").alias("cluster_inertia"),
        F.sum("inertia").over(Window.partitionBy()).try_cast("long").alias("inertia"),
        digest.alias("centroid_sha256"),
    )
    return found.rows.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query
def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = minimax_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ANSWERS["op3_phrase_automata"] = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, s, array_to_string(w[s : s + 19], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
    again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, s + i AS p FROM again, (SELECT unnest(range(20)) AS i)),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) USING (doc_id)
"""

ANSWERS["op10_cover_tree"] = """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
        ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1) USING (vec_id)
    LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1) USING (vec_id)
"""


def _clustering_answer(rounds: int = 5, count: int = 40) -> str:
    """The rounds of centroid clustering one after the other; sums are of whole numbers far below 2 ** 53."""
    nearest = """SELECT vec_id, q, cluster, distance FROM (
            SELECT vec_id, q, cluster, distance, row_number() OVER (PARTITION BY n ORDER BY distance, cluster) AS r FROM (
                SELECT n, any_value(vec_id) AS vec_id, any_value(q) AS q, cluster, sum((x - y) * (x - y))::BIGINT AS distance
                FROM (SELECT n, vec_id, q, cluster, unnest(q) AS x, unnest(c) AS y FROM v, {centroids}) GROUP BY n, cluster)) WHERE r = 1"""
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster, q AS c FROM v
            ORDER BY sha256('2:' || vec_id) LIMIT {count})""",
    ]
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({nearest.format(centroids=f'c{k}')})")
        steps.append(
            f"""m{k} AS (SELECT cluster, list(m ORDER BY d) AS c FROM (SELECT cluster, d, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
            FROM (SELECT cluster, unnest(q) AS x, unnest(range(64)) AS d FROM a{k}) GROUP BY cluster, d) GROUP BY cluster)"""
        )
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))")
    steps.append(f"a AS MATERIALIZED ({nearest.format(centroids=f'c{rounds}')})")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a JOIN c{rounds} USING (cluster)"""


ANSWERS["op12_lookup_table_clusters"] = _clustering_answer()
