"""The operators of this part as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillstream.llm import (divergence, html_text, licenses, line_dedup, manifest, mixing, ngram_join, packing, quality,
                            simhash, token_files, topk, toxicity)
from tillstream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(make: Query) -> Query:
    _QUERIES[make.__name__] = make
    return make


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query
def op1_pfair_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents").select("doc_id", "source"))


_SQL["op1_pfair_mixing"] = """
WITH RECURSIVE docs AS (SELECT doc_id, source, coalesce(source, '') AS src FROM documents),
n AS (SELECT src, count(*) AS n_docs FROM docs GROUP BY src),
size AS (SELECT greatest(1000, count(*)) AS size, count(*) AS many, sum(pow(n_docs, 0.7)) AS total FROM n),
shares AS (SELECT src, n_docs, size, many, (size - many) * pow(n_docs, 0.7) / total AS share FROM n, size),
parts AS (SELECT src, n_docs, size AS period,
              CAST(1 + floor(share) + CASE WHEN row_number() OVER (ORDER BY floor(share) - share, src)
                   <= size - many - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS parts FROM shares),
lists AS (SELECT list(src ORDER BY src) AS srcs, list(parts ORDER BY src) AS p, max(period) AS period,
              min(CAST(floor(ceil(n_docs / 8) * period / parts) AS BIGINT)) AS horizon FROM parts),
run AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(p, lambda x: CAST(1 AS BIGINT)) AS nxt, CAST(NULL AS BIGINT) AS j,
      CAST(NULL AS BIGINT) AS nth FROM lists
  UNION ALL
  SELECT t + 1, list_transform(nxt, lambda x, i: CASE WHEN i = m.j THEN x + 1 ELSE x END), m.j, nxt[m.j]
  FROM (SELECT t, nxt, period, list_min(list_transform(nxt, lambda x, i: CASE WHEN floor((x - 1) * period / p[i]) <= t
            THEN {'d': CAST(ceil(x * period / p[i]) AS BIGINT), 'j': i} END)) AS m
        FROM run, lists) WHERE t < period),
slots AS (SELECT srcs[j] AS src, nth, t - 1 AS slot, CAST(floor((nth - 1) * period / p[j]) AS BIGINT) AS release,
              CAST(ceil(nth * period / p[j]) AS BIGINT) AS deadline, horizon FROM run, lists WHERE j IS NOT NULL),
ranks AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r
          FROM docs),
blocks AS (SELECT doc_id, source, src, r, r // 8 AS block, parts, period FROM ranks JOIN parts USING (src))
SELECT doc_id, source, block, release + (block // parts) * period AS release,
    deadline + (block // parts) * period AS deadline, slot + (block // parts) * period AS slot, r % 8 AS place,
    slot + (block // parts) * period < horizon AS in_mix
FROM blocks JOIN slots ON blocks.src = slots.src AND block % parts + 1 = nth
"""


@query
def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return (line_dedup.dedup(table(spark, sf, "documents"))
            .select("doc_id", "n_lines", "n_equal", "n_near", "removed", F.length("text").cast("long").alias("n_chars_left")))


@query
def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = token_files.fresh_folder(spark)
    token_files.write(table(spark, sf, "documents"), path)
    return (token_files.read(spark, path)
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


@query
def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return (ngram_join.join(table(spark, sf, "documents"))
            .select("doc_id", "class_id", "n_links", "n_texts"))


@query
def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query
def op9_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@query
def op10_threshold_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.search(table(spark, sf, "embeddings"))


_SQL["op10_threshold_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


_SQL["op11_source_divergence"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT r, lang, source,
              unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x{7F}]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, sum(total)::HUGEINT AS lang_n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
sizes AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total_n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (total_n + v) AS p,
               1 + (1000000000 * (total + 1)) // (lang_n + v) AS q
           FROM sizes JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM items)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranks WHERE part = 'pair' OR rank <= 200
"""


@query
def op12_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.cluster(table(spark, sf, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest.audit(table(spark, sf, "documents"), manifest.lowered_where(tampered))


def _merkle_sql(levels: int = 6) -> str:
    """The tree level by level: enough levels for 16^levels rows of a source, and as many sources."""
    def field(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"
    leaf = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = (f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           f"lambda d: CAST(ascii(d) AS BIGINT)), lambda c, b: {byte}))")
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str, keys: str, nodes: str) -> str:
        """CTEs: nodes of each level, and the siblings of each node; a tree of one node stays as it is."""
        parts = [f"{name}0 AS ({nodes})"]
        for k in range(1, levels + 1):
            parts.append(f"""{name}{k} AS (SELECT {keys}, CASE WHEN n > 1 THEN pos // 16 ELSE pos END AS pos,
                CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest,
                max((n + 15) // 16) AS n FROM {name}{k - 1} GROUP BY {keys}, n, CASE WHEN n > 1 THEN pos // 16 ELSE pos END,
                CASE WHEN n > 1 THEN 0 ELSE pos END)""")
        for k in range(levels):
            run = f"PARTITION BY {keys}, CASE WHEN n > 1 THEN pos // 16 ELSE -1 END ORDER BY pos ROWS BETWEEN"
            parts.append(f"""{name}s{k} AS (SELECT {keys}, pos, n,
                coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
        return ",\n".join(parts)

    def climb(name: str, source: str, on: str, pos: str) -> tuple[str, str]:
        """CTEs that fold a claim level by level and gather its siblings, and the name of the last."""
        parts, last = [], source
        for k in range(levels):
            s = f"{name}s{k}"
            parts.append(f"""{name}f{k} AS (SELECT x.* EXCLUDE (digest, proof),
                CASE WHEN {s}.n > 1 THEN sha256({s}.l || digest || {s}.r) ELSE digest END AS digest,
                proof || {s}.l || {s}.r AS proof
                FROM {last} x JOIN {s} ON {on.format(t=s)} AND {s}.pos = x.{pos} // {16 ** k})""")
            last = f"{name}f{k}"
        return ",\n".join(parts), last

    up, top = climb("d", "start", "{t}.tree = x.tree", "pos")
    over, last = climb("r", top, "true", "tree_pos")
    return f"""
WITH leaves AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, {leaf.format(text="text")} AS leaf,
    {leaf.format(text=f"(CASE WHEN ({crc}) % 5 = 0 THEN {small} ELSE text END)")} AS claim FROM documents),
rows AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{tree("d", "tree", "SELECT tree, pos, leaf AS digest, n FROM rows")},
tops AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS tree_pos, count(*) OVER () AS m FROM d{levels}),
{tree("r", "one", "SELECT 1 AS one, tree_pos AS pos, subroot AS digest, m AS n FROM tops")},
start AS (SELECT doc_id, tree, pos, leaf, subroot, tree_pos, claim AS digest, '' AS proof FROM rows JOIN tops USING (tree)),
{up},
{over}
SELECT doc_id, leaf, subroot, r{levels}.digest AS root, sha256(proof) AS proof_sha256, x.digest AS folded_root,
    x.digest = r{levels}.digest AS verified
FROM {last} x JOIN r{levels} ON true
"""


_SQL["op13_merkle_manifest"] = _merkle_sql()


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
