"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.llm import (exact_dedup, filter_audit, importance, langid, merkle, mixing, ngram_join, packing, quality,
                            sharding, suffix_dedup, toxicity, url_filter)

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), url_filter.RULES)


def remainder(column: str, n: int):
    """crc32 of an id as text, modulo n; a null id is in no fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    scored = toxicity.toxicity(read(spark, sf_dir, "documents"), labels, remainder("doc_id", 3) != 1)
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "passages")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents")) \
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents"))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edited(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, remainder("doc_id", 4) != 2)
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(read(spark, sf_dir, "documents")) \
        .select("doc_id", "class_id", "copies", "n_links", "group_id", "kept")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_url_filters": op2_url_filters,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_sharding": op6_sharding,
    "op7_merkle_fingerprints": op7_merkle_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE: dict[str, str] = {
    "op2_url_filters": r"""
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        places AS (SELECT DISTINCT host, path FROM u),
        best AS (
            SELECT host, path, arg_max(rhost || rpath, length(rhost) + length(rpath)) AS rule,
                   arg_max(verdict, length(rhost) + length(rpath)) AS verdict
            FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY host, path)
        SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM u LEFT JOIN best ON best.host = u.host AND best.path = u.path""",
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_cp,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        best AS (
            SELECT text_sha256, count(*) AS group_size, max(n_cp) AS most FROM d GROUP BY text_sha256),
        keep AS (
            SELECT d.text_sha256, any_value(group_size) AS group_size, min(doc_id) AS keep_id
            FROM d JOIN best ON d.text_sha256 = best.text_sha256 AND n_cp = most GROUP BY d.text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.text_sha256
        FROM d JOIN keep USING (text_sha256)""",
    "op5_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
            FROM d GROUP BY source),
        levels AS (
            SELECT source, source_size, weight,
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER w, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
            FROM s
            WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        fair AS (SELECT arg_min(level, source_size::DOUBLE / weight) AS level FROM levels
                 WHERE 2 * source_size >= level * weight),
        t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, fair.level * weight) AS target
              FROM s, fair),
        placed AS (
            SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (CASE WHEN source_size = 0 THEN 0
                     ELSE (budget // source_size) * size
                          + greatest(0, least(size, budget % source_size - start)) END)::BIGINT AS taken
        FROM placed""",
    "op6_sharding": r"""
        WITH d AS (
            SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
            FROM documents),
        levels AS (SELECT d.*, depth, h >> (60 - depth) AS prefix FROM d, range(0, 61) AS r(depth)),
        fits AS (
            SELECT depth, prefix FROM levels GROUP BY depth, prefix
            HAVING sum(n_bytes) <= 67108864 OR count(DISTINCT h) = 1),
        leaf AS (SELECT doc_id, n_bytes, h, min(depth) AS depth FROM levels JOIN fits USING (depth, prefix) GROUP BY ALL)
        SELECT doc_id, n_bytes, depth::INTEGER AS depth, h >> (60 - depth) AS prefix, NULL::BIGINT AS page,
               CASE WHEN depth = 0 THEN '' ELSE right(bin(h >> (60 - depth) | (1::BIGINT << 60)), depth::INTEGER) END AS shard
        FROM leaf""",
    "op11_filter_audit": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
        f AS (
            SELECT doc_id, part,
                   (len(words) < 100)::INTEGER
                   + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER
                   + 4 * (100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 10 * length(d.t))::INTEGER
                   + 8 * regexp_matches(d.t, '[#$%&*|]')::INTEGER
                   + 16 * coalesce(doc_id > first, false)::INTEGER AS fails
            FROM d JOIN firsts ON d.t = firsts.t),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails),
        letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders(o) AS (
            SELECT '' UNION ALL
            SELECT o || letter FROM orders JOIN letters ON NOT contains(o, letter)),
        steps AS (
            SELECT o, s.step, l.bit, coalesce((SELECT sum(e.bit) FROM letters e
                       WHERE position(e.letter IN o) BETWEEN 1 AND s.step - 1), 0)::INTEGER AS before
            FROM orders, range(1, 6) AS s(step) JOIN letters l ON l.letter = substr(o, s.step, 1) WHERE length(o) = 5),
        r AS (
            SELECT part, o, step, bit,
                   coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0) AS kept,
                   coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS removed,
                   coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS toxic_lost
            FROM steps, m GROUP BY part, o, step, bit)
        SELECT part, o AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM r""",
    # crc32 is spelled out: a table of 256 from eight shifts each, then one step a byte
    "op13_importance_resampling": r"""
        WITH RECURSIVE shifted(b, k, v) AS (
            SELECT b, 0, b::BIGINT FROM range(256) AS r(b) UNION ALL
            SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END
            FROM shifted WHERE k < 8),
        crc AS (SELECT list(v ORDER BY b) AS tab FROM shifted WHERE k = 8),
        d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        w AS (SELECT r, unnest(words) AS word FROM d),
        tw AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark),
        vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM w UNION ALL SELECT word FROM tw)),
        hashed AS (
            SELECT word, (xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2),
                                    lambda i: ('0x' || substr(h, 2 * i::BIGINT + 1, 2))::BIGINT)),
                       lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295::BIGINT) % 10000) AS bucket
            FROM vocabulary, crc),
        s AS (SELECT bucket, count(*) AS s FROM w JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM tw JOIN hashed USING (word) GROUP BY bucket),
        gain AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + 10000)::DOUBLE
                   / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM tw) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s FULL JOIN t USING (bucket)),
        weights AS (
            SELECT r, sum(gain) AS weight FROM w JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
        scored AS (
            SELECT doc_id, r, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
            FROM d LEFT JOIN weights USING (r)),
        full_score AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS n
            FROM full_score)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END::BIGINT AS rank
        FROM placed""",
}
