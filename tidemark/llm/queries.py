"""The operators as queries over whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    collocations, extendible_shards, html_text, importance_resampling, kdtree_topk, minmax_dedup, poisson_mix, qgram_decontamination,
    simhash_tiles, token_counts, toxicity, url_rules, warc,
)
from tidemark.llm.common import table

TOP_K, QUERY_EVERY, SCALE = 20, 20, 64


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85, rows=5)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mixed(table(spark, sf_dir, "documents"))


def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "octet_length(text) AS size")
    return extendible_shards.assigned(docs, size=docs["size"]).drop("size")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"))


def op9_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return kdtree_topk.top_k(vectors, vectors.where(f"vec_id % {QUERY_EVERY} = 0"), k=TOP_K, scale=SCALE)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resampled(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_html_text, op2_qgram_decontamination, op3_warc_normaliser, op4_minmax_dedup, op5_token_counts, op6_poisson_mix,
        op7_extendible_shards, op8_url_rules, op9_kdtree_topk, op10_toxicity,
        op11_simhash_dedup, op12_importance_resampling, op13_collocations,
    ]
    return {f.__name__: f for f in found}


_WARC_SQL = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), coded AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
    translate(
      to_base(('0x' || substr(h, 1, 5))::BIGINT, 32, 4) || to_base(('0x' || substr(h, 6, 5))::BIGINT, 32, 4)
      || to_base(('0x' || substr(h, 11, 5))::BIGINT, 32, 4) || to_base(('0x' || substr(h, 16, 5))::BIGINT, 32, 4)
      || to_base(('0x' || substr(h, 21, 5))::BIGINT, 32, 4) || to_base(('0x' || substr(h, 26, 5))::BIGINT, 32, 4)
      || to_base(('0x' || substr(h, 31, 5))::BIGINT, 32, 4) || to_base(('0x' || substr(h, 36, 5))::BIGINT, 32, 4),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM d
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top,
    row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS place
  FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN top END AS refers_to
FROM ranked
"""

_DEDUP_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
  SELECT a AS doc_id, b AS other FROM both_ways
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other
), least AS (
  SELECT doc_id, min(other) AS m FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least(l.m, d.doc_id), d.doc_id) AS component_id,
  coalesce(least(l.m, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

_MIX_SQL = f"""
WITH RECURSIVE rates AS (
  SELECT source, count(*) AS n_docs,
    1.0::DOUBLE / (SELECT count(*) FROM (SELECT DISTINCT source FROM documents))
      * (SELECT count(*) FROM documents)::DOUBLE / count(*) AS rate
  FROM documents GROUP BY source
), pieces AS (
  SELECT source, piece::BIGINT AS piece,
    CASE WHEN piece < floor(rate / {poisson_mix.PIECE}) THEN {poisson_mix.PIECE}::DOUBLE
         ELSE rate - floor(rate / {poisson_mix.PIECE}) * {poisson_mix.PIECE} END AS mean
  FROM (SELECT source, rate, unnest(range(0, floor(rate / {poisson_mix.PIECE})::BIGINT + 1)) AS piece FROM rates)
), chances AS (
  SELECT source, piece, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM pieces
  UNION ALL
  SELECT source, piece, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1)
  FROM chances WHERE k < ceil(mean + sqrt(mean) * 12 + 20)
), points AS (
  SELECT d.*, piece,
    (('0x' || substr(md5('{poisson_mix.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || piece), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN pieces p ON d.source IS NOT DISTINCT FROM p.source
), drawn AS (
  SELECT doc_id, p.source, any_value(text) AS text, any_value(lang) AS lang, any_value(n_chars) AS n_chars, p.piece,
    count(*) FILTER (WHERE total <= u) AS times
  FROM points p JOIN chances c ON p.source IS NOT DISTINCT FROM c.source AND p.piece = c.piece
  GROUP BY doc_id, p.source, p.piece
)
SELECT doc_id, text, lang, source, n_chars, (piece * 1000 + nth)::BIGINT AS copy,
  md5('{poisson_mix.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || piece || ':' || nth) AS shuffle_key
FROM (SELECT *, unnest(range(1, times + 1)) AS nth FROM drawn WHERE times > 0)
"""

_SHARD_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), levels AS (
  SELECT doc_id, n_bytes, d::INTEGER AS depth, CASE WHEN d = 0 THEN '' ELSE to_base(h >> (60 - d), 2, d::INTEGER) END AS shard
  FROM (SELECT *, unnest(range(0, 41)) AS d FROM hashed)
), sums AS (
  SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM levels GROUP BY depth, shard
), fits AS (
  SELECT l.doc_id, l.n_bytes, l.depth, l.shard, s.shard_bytes,
    row_number() OVER (PARTITION BY l.doc_id ORDER BY l.depth) AS place
  FROM levels l JOIN sums s ON s.depth = l.depth AND s.shard = l.shard
  WHERE s.shard_bytes <= {extendible_shards.SHARD_BYTES} OR s.n = 1
)
SELECT doc_id, shard, depth, n_bytes, shard_bytes FROM fits WHERE place = 1
"""


def _url_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    hosts = []
    for rule in url_rules.HOST_RULES:
        host, slash, path = rule.name.partition("/")
        hosts.append(f"({text(rule.name)}, {text(rule.verdict)}, {text(host)}, {text(slash + path)})")
    blocked = " OR ".join(f"regexp_matches(host || path, {text(rule.pattern)})" for rule in url_rules.PATTERN_RULES)
    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return f"""
WITH parted AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, {parts}, 1), ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
    coalesce(regexp_extract(url, {parts}, 2), '') AS path
  FROM pages
), rules(rule, verdict, rule_host, rule_path) AS (VALUES {", ".join(hosts)}),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parted JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT p.page_id, host, path, f.rule,
  coalesce(f.verdict, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict
FROM parted p LEFT JOIN fits f ON f.page_id = p.page_id
"""


_TOP_K_SQL = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * c::DOUBLE) FOR c IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {TOP_K}
"""


_RESAMPLING_SQL = r"""
WITH RECURSIVE cells AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS step FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM cells WHERE step < 8
), crc_table AS (
  SELECT i, c FROM cells WHERE step = 8
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS id, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), parted AS (
  SELECT side, id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT side, id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM parted
), counted AS (
  SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL
), distinct_features AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)
), crc AS (
  SELECT f, h, 1 AS pos, 4294967295::BIGINT AS c FROM distinct_features
  UNION ALL
  SELECT f, h, pos + 2, xor(crc.c >> 8, t.c)
  FROM crc JOIN crc_table t ON t.i = (xor(crc.c, ('0x' || substr(h, pos, 2))::BIGINT) & 255) WHERE pos < length(h)
), buckets AS (
  SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE pos > length(h)
), placed AS (
  SELECT side, id, bucket, n FROM counted JOIN buckets USING (f)
), totals AS (
  SELECT bucket, sum(n) FILTER (WHERE side = 'd') AS s, sum(n) FILTER (WHERE side = 'b') AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM totals) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM totals) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM totals
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT p.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(p.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM parted p LEFT JOIN weighed USING (id) WHERE p.side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS fit
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * fit // 100 THEN place END AS rank FROM ranked
"""

_COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, size, w[i:i + size - 1] AS w FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size))
), frequent AS (
  SELECT lang, size, w, array_to_string(w, ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) c
  JOIN frequent x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN frequent y ON y.lang = c.lang AND y.w = c.w[k + 1:c.size]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, phrase, max(longer) AS longer FROM (
    SELECT lang, f AS longer, array_to_string(w[pos:pos + s - 1], ' ') AS phrase FROM (
      SELECT *, unnest(range(1, size - s + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS s FROM frequent WHERE size > 2)))
  GROUP BY lang, phrase
), kept AS (
  SELECT l.* FROM lowest l LEFT JOIN held h ON h.lang = l.lang AND h.phrase = l.phrase
  WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * l.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_normaliser": _WARC_SQL,
        "op4_minmax_dedup": _DEDUP_SQL,
        "op6_poisson_mix": _MIX_SQL,
        "op7_extendible_shards": _SHARD_SQL,
        "op8_url_rules": _url_sql(),
        "op9_kdtree_topk": _TOP_K_SQL,
        "op12_importance_resampling": _RESAMPLING_SQL,
        "op13_collocations": _COLLOCATION_SQL,
    }
