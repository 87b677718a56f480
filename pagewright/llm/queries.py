"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.decontam import decontaminate
from pagewright.llm.exact import exact_groups
from pagewright.llm.importance import resample
from pagewright.llm.lid import held_out, identify, train_on
from pagewright.llm.mixing import mix
from pagewright.llm.ngram_join import near_duplicates
from pagewright.llm.packing import pack_documents
from pagewright.llm.periods import find_runs
from pagewright.llm.pii import mask
from pagewright.llm.quality import classify
from pagewright.llm.secrets import scan_secrets
from pagewright.llm.substring import remove_repeats
from pagewright.llm.urls import filter_urls


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_docs(spark, sf_dir)).drop("removed")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_docs(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("item_ids", "spans")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_docs(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask(_docs(spark, sf_dir), key="a key for the query only").withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_docs(spark, sf_dir))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_docs(spark, sf_dir))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The content of a public tokenizer's file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_docs(spark, sf_dir), tokenizer_file())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), train_on(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_docs(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(_docs(spark, sf_dir), planted=True).drop("runs")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_secret_scan": op3_secret_scan,
    "op4_pii": op4_pii,
    "op5_decontamination": op5_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_source_mix": op12_source_mix,
    "op13_periodic_runs": op13_periodic_runs,
}

#: CTEs of CRC-32 in SQL: ``crc`` has the checksum of each ``w`` of ``crc_of``, from the polynomial.
_CRC = r"""
        crc_table AS (
            SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
            FROM (SELECT unnest(range(256)) AS i)
        ), crc AS (
            SELECT w, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h
            FROM (SELECT w, [('0x' || substr(hex(w), 2 * k - 1, 2))::BIGINT FOR k IN range(1, strlen(w) + 1)] AS bytes FROM (SELECT DISTINCT w FROM crc_of)), crc_table
        )
"""

ORACLES = {
    "op11_importance_resampling": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
        ), b AS (
            SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
        ), dw AS (SELECT doc_id, unnest(ws) AS w FROM d), bw AS (SELECT unnest(ws) AS w FROM b),
        crc_of AS (SELECT w FROM dw UNION SELECT w FROM bw),
    """
    + _CRC
    + r"""
        , s AS (SELECT h % 10000 AS bucket, count(*) AS n FROM dw JOIN crc USING (w) GROUP BY 1),
        t AS (SELECT h % 10000 AS bucket, count(*) AS n FROM bw JOIN crc USING (w) GROUP BY 1),
        gains AS (
            SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
                   / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS gain
            FROM s LEFT JOIN t USING (bucket)
        ), weights AS (
            SELECT doc_id, floor(sum(gain) / count(*)) AS weight FROM dw JOIN crc USING (w) JOIN gains ON bucket = h % 10000 GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ), ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20)
        SELECT scored.*, CASE WHEN place <= drawn THEN place END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op12_source_mix": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS z, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM d GROUP BY source
        ), sums AS (
            SELECT a.source, a.z, a.weight, (SELECT sum(z) FROM sources) AS words, (SELECT sum(weight) FROM sources) AS weighed,
                   coalesce((SELECT sum(3 * b.z) FROM sources b WHERE b.z * a.weight < a.z * b.weight), 0) AS stopped,
                   coalesce((SELECT sum(b.weight) FROM sources b WHERE b.z * a.weight < a.z * b.weight), 0) AS gone
            FROM sources a
        ), stops AS (SELECT *, 3 * z * (weighed - gone) < weight * (words - stopped) AS stops FROM sums),
        targets AS (
            SELECT source, z, CASE WHEN stops THEN (3 * z)::DOUBLE
                   ELSE (weight * (words - coalesce((SELECT sum(3 * z) FROM stops WHERE stops), 0)))::DOUBLE / (SELECT sum(weight) FROM stops WHERE NOT stops)::DOUBLE END AS target
            FROM stops
        ), shares AS (
            SELECT *, CASE WHEN z > 0 THEN target / z::DOUBLE ELSE 0 END AS ratio FROM targets
        ), quotas AS (SELECT *, floor(ratio) AS whole, ratio - floor(ratio) AS chance, floor(target - floor(ratio) * z + 0.5)::BIGINT AS quota FROM shares),
        copies AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS copy FROM d),
        uniform AS (SELECT *, (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '') || ':' || copy), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u FROM copies),
        odds AS (
            SELECT u.*, z, target, whole, chance, quota, CASE WHEN chance > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS q
            FROM uniform u JOIN quotas t ON u.source IS NOT DISTINCT FROM t.source
        ), ranks AS (SELECT *, least(floor(q / (1 + q) * 281474976710656)::BIGINT, 281474976710655) AS rank FROM odds),
        runs AS (SELECT *, CASE WHEN rank IS NOT NULL AND size > 0 THEN sum(size) OVER (PARTITION BY source, rank IS NOT NULL AND size > 0 ORDER BY rank, doc_id NULLS FIRST, copy, size) END AS upto FROM ranks)
        SELECT doc_id, size, z AS source_size, target, source, (size * whole + CASE WHEN upto IS NULL THEN 0 ELSE greatest(0, least(size, quota - upto + size)) END)::BIGINT AS taken FROM runs
    """,
    "op13_periodic_runs": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        crc_of AS (SELECT doc_id::VARCHAR AS w FROM d),
    """
    + _CRC
    + r"""
        , chosen AS (SELECT doc_id, ws, len(ws) AS n, h // 10 AS g, h % 10 = 0 AND len(ws) > 0 AS planted FROM d JOIN crc ON w = doc_id::VARCHAR),
        placed AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM chosen),
        texts AS (
            SELECT doc_id, n, list_concat(ws[1 : a], [ws[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] FOR i IN range(a, n)]) AS ws FROM placed
        ), grams AS (
            SELECT doc_id, i, array_to_string(ws[i + 1 : i + 5], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(0, n - 4)) AS i FROM texts WHERE n >= 5)
        ), pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i),
        islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
        squares AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM islands GROUP BY doc_id, q, island),
        runs AS (SELECT doc_id, start, length, min(q) AS q FROM squares WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
        lists AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS told,
                   list({'start': start, 'length': length, 'q': q} ORDER BY length::DOUBLE / q DESC, start, q)[1] AS best FROM runs GROUP BY doc_id
        ), gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + q, start + length)) AS i FROM runs) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.q::BIGINT AS period,
               (1000 * best.length // best.q)::BIGINT AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
               sha256(coalesce(array_to_string([x[2] FOR x IN list_zip(range(0, n), ws) IF gone IS NULL OR NOT list_contains(gone, x[1])], ' '), '')) AS collapsed_sha256
        FROM texts LEFT JOIN lists USING (doc_id) LEFT JOIN gone USING (doc_id)
    """,
    "op8_ngram_join": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(ws[s : s + 4], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM t WHERE len(ws) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM t UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
        )
        SELECT t.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(y) AS component_id
        FROM t LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = t.doc_id GROUP BY t.doc_id
    """,
    "op6_substring_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        runs AS (
            SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS win
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM t WHERE len(ws) >= 20)
        ),
        ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS r FROM runs),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1),
        lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string([w[2] FOR w IN list_zip(range(1, len(ws) + 1), ws) IF ps IS NULL OR NOT list_contains(ps, w[1])], ' '), '')) AS kept_sha256
        FROM t LEFT JOIN lists USING (doc_id)
    """,
    "op5_decontamination": r"""
        WITH w AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
        ), items AS (
            SELECT DISTINCT id, least(len(ws), 13) AS k, array_to_string(ws[s : s + least(len(ws), 13) - 1], ' ') AS win
            FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM w WHERE kind = 'b' AND len(ws) > 0)
        ), sizes AS (SELECT DISTINCT k FROM items), runs AS (
            SELECT id, s, k, array_to_string(ws[s : s + k - 1], ' ') AS win
            FROM (SELECT id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM w, sizes WHERE kind = 'd' AND len(ws) >= k)
        ), hits AS (
            SELECT r.id, r.s, r.k, i.id AS item FROM runs r JOIN items i ON r.win = i.win AND r.k = i.k
        ), words AS (
            SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT id, s, k FROM hits)) GROUP BY id
        ), found AS (
            SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hits) GROUP BY id
        )
        SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
               sha256(coalesce(found.names, '')) AS items_sha256,
               coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
        FROM w LEFT JOIN words ON words.id = w.id LEFT JOIN found ON found.id = w.id WHERE kind = 'd'
    """,
    "op7_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY body)
    """,
}
