"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster
from .common import documents, fold
from .decontaminate import contamination
from .exact_dedup import exact_duplicates
from .filter_audit import audit
from .langid import Model, learn, predict
from .line_dedup import repeated_passages
from .lm_score import score_documents
from .minhash import near_duplicates
from .packing import pack
from .pii import personal_data
from .sharding import interleave
from .suffix_dedup import remove_repeats
from .word_repeats import remove_repeated_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


@register("op1_string_tiling")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    share = F.round("_share", 6).alias("coverage")
    return found.select("_doc.doc_id", (F.col("_items") > 0).alias("contaminated"), F.col("_item").alias("item_id"), share, F.col("_items").alias("n_items"))


@register("op2_line_chunks")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(documents(spark, sf_dir))
    return found.select("doc_id", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), F.col("spans").alias("removed_lines"))


def language_model(spark: SparkSession, sf_dir: str) -> Model | None:
    """Centroids of the labelled documents outside the held-out fold."""
    docs = documents(spark, sf_dir)
    return learn(docs.where(fold("doc_id", 5) != 0), F.col("lang"), F.col("text"), F.md5(F.col("doc_id").cast("string").cast("binary")))


@register("op3_nearest_centroid")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = predict(documents(spark, sf_dir), language_model(spark, sf_dir), ["doc_id"])
    return found.select(
        "_doc.doc_id", (fold("_doc.doc_id", 5) == 0).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


@register(
    "op4_inverted_signatures",
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id, least(w.doc_id, coalesce(c.b, w.doc_id)) = w.doc_id AS kept
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@register("op5_elias_fano_trie")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), fold("doc_id", 7) == 2)


# CRC-32 by its table, byte by byte.
SQL_CRC32 = """tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    b AS (SELECT doc_id, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM documents),
    d AS (SELECT doc_id, source, len(bytes) + 1 AS size, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, tab)"""


@register(
    "op6_stratified_interleaving",
    f"""
    WITH {SQL_CRC32}, m AS (SELECT *, md5('0:' || doc_id) AS mix FROM d),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY mix, doc_id, text_crc32) - 1 AS k, count(*) OVER (PARTITION BY source) AS n FROM m),
    g AS (SELECT *, row_number() OVER (ORDER BY (CAST(k AS DOUBLE) + CAST(0.5 AS DOUBLE)) / n, source NULLS FIRST, mix, doc_id, text_crc32) - 1 AS rank, count(*) OVER () AS total FROM r)
    SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(rank * 16 // total AS INT) AS shard,
    rank - ((rank * 16 // total) * total + 15) // 16 AS slot, CAST(NULL AS INT) AS grown_shard, source FROM g
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = interleave(documents(spark, sf_dir))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


@register("op7_contextual_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


@register("op8_histogram_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), added=True)


@register(
    "op9_block_naming",
    r"""
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


@register(
    "op10_interval_expansion",
    """
    WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - 99, 0))) AS i FROM t)),
    late AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
    runs AS (SELECT *, sum(CASE WHEN i > coalesce(before + 100, -1) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM late)),
    gone AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS z FROM runs GROUP BY doc_id, run),
    gaps AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM gone),
    left_ AS (SELECT g.doc_id, sum(z - a) AS n, count(*) AS c, max(z) AS z, string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS kept FROM gaps g JOIN t ON t.doc_id = g.doc_id GROUP BY g.doc_id)
    SELECT t.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256 FROM t LEFT JOIN left_ ON left_.doc_id = t.doc_id
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


@register(
    "op11_block_anchors",
    r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)),
    late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM s) WHERE doc_id > first),
    gone AS (SELECT doc_id, list_distinct(list(i + j)) AS g FROM late, (SELECT unnest(range(13)) AS j) GROUP BY doc_id),
    kept AS (SELECT t.doc_id, len(w) AS n, coalesce(len(g), 0) AS m, CASE WHEN g IS NULL THEN w ELSE
        list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: NOT list_contains(g, p[2])), lambda p: p[1]) END AS k FROM t LEFT JOIN gone USING (doc_id))
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(documents(spark, sf_dir))


def _round_sql(k: int, last: bool) -> str:
    """Vectors with their nearest centroid, and the centroids after that."""
    near = f"""a{k} AS MATERIALIZED (SELECT row, vec_id, v, struct_extract(m, 'd') AS d, struct_extract(m, 'k') AS k FROM (SELECT row, vec_id, v,
        list_min(list_transform(cs, lambda c: {{'d': list_sum(list_transform(list_zip(v, c['c']), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS BIGINT))), 'k': c['k']}})) AS m
        FROM i, (SELECT list({{'k': k, 'c': c}}) AS cs FROM c{k})))"""
    moved = f"""c{k + 1} AS MATERIALIZED (SELECT k, coalesce(n.c, c{k}.c) AS c FROM c{k} LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c
        FROM (SELECT k, p, sum(v[p]) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 65)) AS p) GROUP BY k, p) GROUP BY k) n USING (k))"""
    return near if last else f"{near}, {moved}"


@register(
    "op12_simplex_clusters",
    f"""
    WITH i AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('1:' || vec_id) AS h, v FROM i ORDER BY h, v LIMIT 16)),
    {", ".join(_round_sql(k, k == 3) for k in range(4))}
    SELECT vec_id, CAST(k AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a3 JOIN c3 USING (k)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register(
    "op13_coalition_audit",
    r"""
    WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (SELECT d.doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
            regexp_matches(text, '[#$%&*|]'), coalesce(d.doc_id, 9223372036854775807) > min(coalesce(d.doc_id, 9223372036854775807)) OVER (PARTITION BY text)] AS fails,
            coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
        FROM t d LEFT JOIN (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
    g AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
    i AS (SELECT unnest(range(1, 6)) AS i),
    o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    s AS (SELECT o, k.i AS step, o[k.i] AS own, o[1:k.i - 1] AS before FROM o, i k),
    r AS (SELECT part, o, step, own, sum(n) AS rows, fails[own] AS f, list_bool_or(list_transform(before, lambda x: fails[x])) AS b, sum(n) AS n, good, toxic,
        list_sum(list_transform(fails, lambda x: CAST(x AS INT))) = 1 AS alone FROM g, s GROUP BY ALL),
    q AS (SELECT part, o, step, own, sum(n) FILTER (NOT f AND NOT coalesce(b, false)) AS kept, sum(n) FILTER (f AND NOT coalesce(b, false)) AS removed, sum(n) FILTER (f AND b) AS redundant,
        sum(n) FILTER (f AND alone) AS unique_fails, sum(n) FILTER (f AND NOT coalesce(b, false) AND good) AS good_lost, sum(n) FILTER (f AND NOT coalesce(b, false) AND toxic) AS toxic_lost FROM r GROUP BY ALL)
    SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
        CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
        CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM q
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
