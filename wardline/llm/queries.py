"""The operators as queries over their whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardline.llm import compression, divergence, language, licenses, line_runs, mixing, sharding, simhash, spelling
from wardline.llm import templates, token_counts, token_files, url_graph
from wardline.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULES = (
    url_graph.Rule("block", "net", "/"),
    url_graph.Rule("allow", "example.net", "/en/"),
    url_graph.Rule("block", "example.com", "/de/"),
    url_graph.Rule("allow", "org", "/fr/"),
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark, folder):
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select(F.col("_row_id").alias("doc_id"), simhash.hex_digits().alias("fingerprint"), "component_id")


@query("op2_license_scans")
def op2_license_scans(spark, folder):
    found = licenses.licenses(read(spark, folder, "documents"))
    return found.select(
        F.col("_row_id").alias("doc_id"), "first_line", "last_line", "license", "reduction", "differences"
    )


@query("op3_token_files")
def op3_token_files(spark, folder):
    place = token_files.token_folder(spark)
    token_files.write_token_files(read(spark, folder, "documents"), place, tokenizer_path("word_bpe_49k.json"))
    return token_files.with_ids_crc32(token_files.read_token_files(spark, place))


@query("op4_language_id")
def op4_language_id(spark, folder):
    return language.identify(read(spark, folder, "documents"))


SHARD_COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


@query("op5_sharding")
def op5_sharding(spark, folder):
    return sharding.shard_documents(read(spark, folder, "documents")).select(*SHARD_COLUMNS)


OP6 = """
WITH d AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source
), level AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
             - coalesce(sum(source_size * 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS l
  FROM s WINDOW w AS (ORDER BY source_size * 2 / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size, least(source_size * 2, weight * max(l) OVER ()) AS target,
    CAST(CAST('0x' || substr(md5('0:' || coalesce('=' || source, 'null')), 1, 5) AS BIGINT) AS DOUBLE)
      / CAST(1048576 AS DOUBLE) AS u
  FROM level
), r AS (
  SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(t.source_size AS BIGINT) AS source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE CAST(0 AS DOUBLE) END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(CAST(d.doc_id AS VARCHAR)) NULLS FIRST,
                       d.doc_id NULLS FIRST) - 1 AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * CAST(floor((k + 1) * rate + u) - floor(k * rate + u) AS BIGINT) AS taken
FROM r
"""


@query("op6_mixing", OP6)
def op6_mixing(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "source", mixing.word_count().alias("size"))
    return mixing.copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op7_token_counts")
def op7_token_counts(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, tokenizer_path("byte_bpe_50k.json"))


@query("op8_benchmark_decontamination")
def op8_benchmark_decontamination(spark, folder):
    found = templates.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select(
        F.col("_row_id").alias("doc_id"), "item_id", "matched_words", "start_word", "changed_slots"
    )


def _scores_sql() -> str:
    """The rounds of ``url_graph.host_scores``, one common table each."""
    d = f"CAST({url_graph.DAMPING} AS DOUBLE)"
    restart = f"SELECT host, kind, mass * (1 - {d}) AS mass FROM seeds"
    steps = [f"r0 AS MATERIALIZED (SELECT host, kind, mass FROM seeds)"]
    for k in range(url_graph.ROUNDS):
        steps.append(
            f"r{k + 1} AS MATERIALIZED (SELECT host, kind, sum(mass) AS mass FROM ("
            f"SELECT s.b AS host, s.kind, r.mass * s.part * {d} AS mass FROM r{k} r JOIN steps s "
            f"ON r.host = s.a AND r.kind = s.kind UNION ALL {restart}) GROUP BY 1, 2)"
        )
    return ",\n".join(steps)


OP9 = f"""
WITH p AS (
  SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{url_graph.CAPITALS}', '{url_graph.SMALL}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages
), q AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
), ruled AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS v FROM q
), hosts AS MATERIALIZED (
  SELECT host, count(*) AS pages, count(*) FILTER (v = 'allow') AS allowed, count(*) FILTER (v = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY 1
), named AS (
  SELECT string_split(host, '.') AS l FROM hosts
  WHERE length(host) <= {url_graph.LONGEST_HOST} AND NOT regexp_matches(host, '{url_graph.NUMERIC}')
), kin AS (
  SELECT DISTINCT array_to_string(l[i:], '.') AS host, array_to_string(l[i + 1:], '.') AS parent
  FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM named)
), links AS (
  SELECT host AS source, translate(x, '{url_graph.CAPITALS}', '{url_graph.SMALL}') AS target FROM (
    SELECT host, unnest(regexp_extract_all(html, '{url_graph.LINK.replace("'", "''")}', 1)) AS x
    FROM ruled WHERE host <> '' AND html IS NOT NULL)
), edges AS MATERIALIZED (
  SELECT source, target, CAST(sum(w) AS DOUBLE) AS w FROM (
    SELECT source, target, 1 AS w FROM links WHERE source <> target
    UNION ALL SELECT host, parent, 1 FROM kin UNION ALL SELECT parent, host, 1 FROM kin) GROUP BY 1, 2
), marks AS (
  SELECT host, 'trust' AS kind FROM hosts WHERE allowed > blocked
  UNION ALL SELECT host, 'distrust' FROM hosts WHERE 2 * blocked > pages
), seeds AS MATERIALIZED (
  SELECT host, kind, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY kind) AS mass FROM marks
), steps AS MATERIALIZED (
  SELECT 'trust' AS kind, source AS a, target AS b, w / sum(w) OVER (PARTITION BY source) AS part FROM edges
  UNION ALL SELECT 'distrust', target, source, w / sum(w) OVER (PARTITION BY target) FROM edges
), {_scores_sql()},
scores AS (
  SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS trust,
         coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS distrust
  FROM r{url_graph.ROUNDS} GROUP BY 1
), fallen AS (
  SELECT host FROM scores WHERE round(distrust - trust, {url_graph.PLACES}) > 0
    AND round(distrust * greatest(1, (SELECT count(*) FROM hosts)) - {url_graph.LEAST_DISTRUST}, {url_graph.PLACES}) >= 0
)
SELECT page_id, host, path, rule,
  coalesce(v, CASE WHEN host IN (SELECT host FROM fallen) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""


@query("op9_url_filters", OP9)
def op9_url_filters(spark, folder):
    return url_graph.judge(read(spark, folder, "pages"), RULES)


@query("op10_quality_rules")
def op10_quality_rules(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return compression.with_quality(docs)


OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
    '{url_graph.CAPITALS}', '{url_graph.SMALL}') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3
), langs AS (
  SELECT lang, sum(n) + count(*) AS size FROM kept GROUP BY 1
), groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept k USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, g.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)
    + (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS size FROM groups g
), p AS MATERIALIZED (
  SELECT lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // s.size AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // l.size AS q
  FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), result AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM result
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", OP11)
def op11_source_divergence(spark, folder):
    return divergence.divergence(read(spark, folder, "documents"))


OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (
  SELECT r, doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d
), k AS MATERIALIZED (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{url_graph.CAPITALS}', '{url_graph.SMALL}') AS key FROM l
), common AS (
  SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT r) >= 5
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.owner AS lost FROM k LEFT JOIN common c ON k.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r
"""


@query("op12_line_dedup", OP12)
def op12_line_dedup(spark, folder):
    found = line_runs.dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP13 = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i)) AS t
), runs AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, '{url_graph.CAPITALS}',
    '{url_graph.SMALL}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS n FROM runs GROUP BY ALL
), summed AS (
  SELECT run, n, xor(list_reduce(flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128
    THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, (unicode(c) - 64)::BIGINT] END)),
    lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM counted, crc
), words AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run) + 2)::INTEGER)
    ELSE run END AS word, sum(n)::BIGINT AS n FROM summed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), rests AS MATERIALIZED (
  SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INTEGER AS k FROM words)
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM rests a JOIN rests b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT r.word, w.word, w.n FROM rests r JOIN words w ON r.rest = w.word
  UNION SELECT w.word, r.word, r.n FROM rests r JOIN words w ON r.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, min({{'n': -n, 'other': encode(other)}}) AS b FROM near GROUP BY 1
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 2 * w.n THEN decode(b.other) END AS form,
    CASE WHEN -b.n >= 2 * w.n THEN -b.n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, c.root, n, n_near, form_n
FROM forms f JOIN (SELECT c.word, c.root FROM chain c JOIN forms e ON c.root = e.word WHERE e.form IS NULL) c ON f.word = c.word
"""


@query("op13_spelling_variants", OP13)
def op13_spelling_variants(spark, folder):
    return spelling.spelling_groups(read(spark, folder, "documents"))
