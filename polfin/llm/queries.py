"""Queries over the test tables, one per operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polfin.llm import op1_suffix_dedup as op1
from polfin.llm import op2_quality as op2
from polfin.llm import op10_decontaminate as op10
from polfin.llm import op11_quality_mil as op11
from polfin.llm import op12_vafile as op12
from polfin.llm import op13_divergence as op13
from polfin.llm import op3_url_filter as op3
from polfin.llm import op4_language_id as op4
from polfin.llm import op5_mixing as op5
from polfin.llm import op6_sharding as op6
from polfin.llm import op7_line_dedup as op7
from polfin.llm import op8_license_scan as op8
from polfin.llm import op9_simhash as op9
from polfin.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed values of the task: verdict, host, path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


_BLANK_CLASS = r"[^ \t\n\x0B\f\r]+"

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_URL_SQL = rf"""
WITH rules(verdict, rh, rp) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
pages2 AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
addresses AS (SELECT DISTINCT host, path FROM pages2),
fits AS (
  SELECT host, path, rh || rp AS rule, verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rh) + length(rp) DESC, length(rh) DESC, verdict DESC) AS nth
  FROM addresses JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM pages2 p LEFT JOIN (SELECT * FROM fits WHERE nth = 1) f ON p.host = f.host AND p.path = f.path"""


@query("op3_url_filter", _URL_SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, ([3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS n FROM totals),
-- Capacity and share are in hundredths of a word. A source is full when it is so at the level of all that fill no earlier.
levels AS (
  SELECT a.source, a.n, a.weight, a.source_size, 200 * a.source_size AS cap,
    (SELECT 150 * sum(source_size) FROM ranked)
      - coalesce(sum(200 * b.source_size) FILTER (WHERE (b.source_size * a.weight, b.n) < (a.source_size * b.weight, a.n)), 0) AS remain,
    sum(b.weight) FILTER (WHERE (b.source_size * a.weight, b.n) >= (a.source_size * b.weight, a.n)) AS weight_left
  FROM ranked a CROSS JOIN ranked b GROUP BY ALL),
full_ones AS (SELECT *, remain * weight > cap * weight_left AS is_full FROM levels),
level AS (SELECT min(remain) AS remain, max(weight_left) AS weight_left FROM (
  SELECT * FROM full_ones WHERE NOT is_full
    AND weight_left = (SELECT max(weight_left) FROM full_ones WHERE NOT is_full))),
targets AS (
  SELECT f.source, f.source_size, CASE WHEN is_full THEN cap / 100.0::DOUBLE
    ELSE (weight * level.remain)::DOUBLE / (level.weight_left * 100)::DOUBLE END AS target
  FROM full_ones f CROSS JOIN level),
planned AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized LEFT JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM planned"""


@query("op5_mixing", _MIX_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = op5.repetitions(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_hilbert_shards")
def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32")
    )
    return op6.hilbert_shards(docs, 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
each AS (
  SELECT doc_id, i, ls[i] AS line,
    translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM lines)),
often AS (SELECT key FROM each WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM each LEFT JOIN often o ON each.key = o.key GROUP BY doc_id"""


@query("op7_line_dedup", _LINES_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = op7.with_bitmaps(docs, op7.keep_bitmaps(docs, min_docs=10))
    lines = F.col("lines")
    return marked.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", op7.kept_sha256(F.col("text"), lines).alias("kept_sha256")
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op9.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", op9.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


_QUALITY_SQL = r"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
hits AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeats AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM hits) GROUP BY doc_id),
measured AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0B\f\r]')) AS ls FROM words)
  LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars * 1000 // n_words ELSE 0 END AS m1,
    CASE WHEN word_chars > 0 THEN n_symbols * 1000000 // word_chars ELSE 0 END AS m2,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000000 // n_lines ELSE 0 END AS m3,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000000 // n_words ELSE 0 END AS m4
  FROM measured),
each AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest([m1, m2, m3, m4]) AS v FROM judged WHERE NOT base_failed),
rough AS (
  SELECT lang, source, m, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS v FROM each),
levels AS (
  SELECT 2 AS level, lang, source, m, v FROM rough UNION ALL SELECT 1, lang, NULL, m, v FROM rough
  UNION ALL SELECT 0, NULL, NULL, m, v FROM rough),
quart AS (
  SELECT level, lang, source, m, count(*) AS docs,
    list_sort(list(v))[(count(*) + 3) // 4] AS q1, list_sort(list(v))[(3 * count(*) + 3) // 4] AS q3
  FROM levels GROUP BY level, lang, source, m),
picked AS (
  SELECT g.lang, g.source, q.m, q.q1, q.q3 FROM (SELECT DISTINCT lang, source FROM rough) g JOIN quart q
    ON (q.level = 2 AND q.lang IS NOT DISTINCT FROM g.lang AND q.source IS NOT DISTINCT FROM g.source)
    OR (q.level = 1 AND q.lang IS NOT DISTINCT FROM g.lang) OR q.level = 0
  WHERE q.docs >= 50 OR q.level = 0
  QUALIFY row_number() OVER (PARTITION BY g.lang, g.source, q.m ORDER BY q.level DESC) = 1),
bounds AS (
  SELECT lang, source, m, q3 + 3 * greatest(q3 - q1, least_spread) AS high, q1 - 3 * greatest(q3 - q1, least_spread) AS low
  FROM picked JOIN (VALUES (1, 500), (2, 20000), (3, 200000), (4, 70000)) s(m, least_spread) USING (m)),
wide AS (
  SELECT lang, source, max(high) FILTER (WHERE m = 1) AS h1, max(low) FILTER (WHERE m = 1) AS l1, max(high) FILTER (WHERE m = 2) AS h2,
    max(high) FILTER (WHERE m = 3) AS h3, max(high) FILTER (WHERE m = 4) AS h4 FROM bounds GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(m1 BETWEEN l1 AND h1 AND m2 <= h2 AND m3 <= h3 AND m4 <= h4, true) AS kept
FROM judged j LEFT JOIN wide b ON j.lang IS NOT DISTINCT FROM b.lang AND j.source IS NOT DISTINCT FROM b.source"""


@query("op2_quality_rules", _QUALITY_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_TEMPLATE_ROWS = ", ".join(f"('{t.label}', {t.words!r}, {t.needed})" for t in op8.TEMPLATES)
_LICENSE_SQL = (
    r"""
WITH templates(label, tw, needed) AS (VALUES """
    + _TEMPLATE_ROWS
    + r"""),
phrases(label, p) AS (VALUES ('mit', ['mit', 'license']), ('apache', ['apache', 'license']), ('gpl', ['general', 'public', 'license'])),
low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
words AS (SELECT doc_id, regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
places AS (
  SELECT doc_id, label, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words) JOIN phrases ON w[i:i + len(p) - 1] = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base_labels
  FROM places GROUP BY doc_id),
blocks AS (
  SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(body, chr(10))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS bw FROM low),
matches AS (
  SELECT doc_id, label, len(list_intersect(bw, tw)) / len(tw) AS containment FROM blocks JOIN templates ON len(list_intersect(bw, tw)) >= needed),
more AS (SELECT doc_id, list(DISTINCT label) AS more, max(containment) AS best FROM matches GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base_labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""
)


@query("op8_license_scan", _LICENSE_SQL)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op8.scan(table(spark, sf_dir, "documents"))
    comma = lambda name: F.array_join(name, ",").alias(name)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", comma("base_labels"), comma("labels"), "score")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op10.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "n_covered", "n_slots", "n_changed")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.languages(table(spark, sf_dir, "documents"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.summary(table(spark, sf_dir, "documents"))


@query("op11_quality_mil")
def op11_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.qualities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lloyd_sql() -> str:
    """Rounds one after another, each a materialised table of centroid components and of nearest centroids."""
    steps = [
        r"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS d FROM kept),
c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS x, unnest(range(64)) AS d
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM kept QUALIFY c < 40))"""
    ]
    for i in range(6):
        steps.append(rf"""
a{i} AS MATERIALIZED (
  SELECT vec_id, c, distance FROM (
    SELECT vec_id, c, sum((p.x - q.x) * (p.x - q.x))::BIGINT AS distance FROM parts p JOIN c{i} q USING (d) GROUP BY vec_id, c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1)""")
        steps.append(rf"""
c{i + 1} AS MATERIALIZED (
  SELECT o.c, o.d, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN (
    SELECT c, d, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM parts JOIN a{i} USING (vec_id) GROUP BY c, d) n ON o.c = n.c AND o.d = n.d)""")
    steps.pop()
    return (
        ",".join(steps)
        + r""",
named AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c5 GROUP BY c)
SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN named USING (c)"""
    )


@query("op12_vafile", _lloyd_sql())
def op12_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.assignments(op12.cluster(table(spark, sf_dir, "embeddings")))


_DIVERGENCE_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
words AS (SELECT i, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
each AS MATERIALIZED (SELECT i, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
lang_terms AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS n FROM each GROUP BY lang, term HAVING count(*) >= 30),
group_terms AS MATERIALIZED (
  SELECT lang, source, term, sum(n)::BIGINT AS n FROM each SEMI JOIN lang_terms USING (lang, term) GROUP BY ALL),
langs AS (
  SELECT lang, count(term) AS v, coalesce(sum(n), 0)::BIGINT AS total FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN lang_terms USING (lang) GROUP BY lang),
groups AS MATERIALIZED (
  SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN group_terms USING (lang, source) GROUP BY ALL),
priced AS MATERIALIZED (
  SELECT g.lang, g.source, l.term, coalesce(t.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(t.n, 0) + 5) // (g.total + 5 * s.v) AS p,
    1 + 1000000000::HUGEINT * (l.n + 5) // (s.total + 5 * s.v) AS q
  FROM groups g JOIN langs s USING (lang) JOIN lang_terms l USING (lang) LEFT JOIN group_terms t USING (lang, source, term)),
near AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN near ON near.lang = a.lang AND near.source = a.source AND near.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query("op13_divergence", _DIVERGENCE_SQL)
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.divergence(table(spark, sf_dir, "documents"))
