"""SQL for the queries that SQL can express over whole tables."""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

# CRC-32 by its table: DuckDB has no such function.
CRC_TABLE = """
digits AS MATERIALIZED (
  SELECT list(list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) AS r(n)
)"""


def crc32(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, where the table ``digits`` is joined."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    return (
        f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen({text})), lambda i: {byte})), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"
    )


def words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {LOWER}), '{WORDS}')"


OP11_TARGET_SAMPLING = f"""
WITH {CRC_TABLE},
texts AS (
  SELECT 0 AS part, doc_id AS id, {words('text')} AS w FROM documents
  UNION ALL SELECT 1, NULL, {words('text')} FROM benchmark
),
bags AS (
  SELECT part, id, len(w) AS n_words,
    list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS f
  FROM texts
),
single AS (SELECT part, id, unnest(f) AS f FROM bags),
buckets AS MATERIALIZED (SELECT f, {crc32('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM single), digits),
counted AS (SELECT part, bucket, count(*) AS n FROM single JOIN buckets USING (f) GROUP BY ALL),
sums AS (
  SELECT coalesce(sum(n) FILTER (part = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (part = 1), 0)::DOUBLE AS t FROM counted
),
gains AS (
  SELECT bucket, floor(1000 * ln(
    (coalesce(sum(n) FILTER (part = 1), 0) + 1)::DOUBLE * (any_value(s) + 10000)
    / ((coalesce(sum(n) FILTER (part = 0), 0) + 1)::DOUBLE * (any_value(t) + 10000))))::BIGINT AS gain
  FROM counted, sums GROUP BY bucket
),
weights AS (
  SELECT id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM single JOIN buckets USING (f) JOIN gains USING (bucket) WHERE part = 0 GROUP BY id
),
scored AS (
  SELECT id AS doc_id, len(f)::BIGINT AS n_features, n_words, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM bags LEFT JOIN weights USING (id) WHERE part = 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM placed
"""

OP13_DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
),
single AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, {LOWER}), '{TERMS}')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM single GROUP BY ALL HAVING count(DISTINCT id) >= 30),
langs AS (
  SELECT lang, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang FROM docs)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang) USING (lang)
),
groups AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, kept.n AS lang_n FROM groups JOIN kept USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM single GROUP BY ALL) AS c USING (lang, source, term)
),
shares AS (
  SELECT grid.lang, source, term, grid.n,
    1 + 1000000000::HUGEINT * (grid.n + 5)::HUGEINT
      // (sum(grid.n) OVER (PARTITION BY grid.lang, source) + 5 * v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (lang_n + 5)::HUGEINT // (langs.n + 5 * v)::HUGEINT AS q
  FROM grid JOIN langs USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 50
"""
