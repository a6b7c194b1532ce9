"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (decontam, langid, linedup, neardup, neighbours, orchard, packing, pii, quality, retrieval,
                        sharding, substring, tokens)
from quarry.llm.common import LOWER, UPPER, table

QUERIES = {}
ORACLES = {}


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return deco


@_query("op1_pii_bootstrap")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 10], ' ') AS phrase, least(len(w), 10) AS k FROM bw),
k AS (SELECT DISTINCT k FROM p),
dw AS (SELECT doc_id, i, k.k, array_to_string(w[i + 1:i + k.k], ' ') AS phrase
       FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d) x, k WHERE i + k.k <= len(w)),
hit AS (SELECT DISTINCT dw.doc_id, dw.i, dw.k, p.item_id FROM dw JOIN p USING (phrase, k)),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS spot FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@_query("op3_decontaminate", DECONTAMINATION_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


_SPACED_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS.format(text=_LOWERED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v),
m AS (SELECT v AS doc_id, min(root) AS component FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@_query("op5_near_dedup", NEAR_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op6_pack_sequences")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@_query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


_STRIPPED = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LINES_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate({_STRIPPED}, '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, pos, line, first IS NOT NULL AND k.doc_id <> first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@_query("op8_line_dedup", LINES_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_dedup(table(spark, sf_dir, "documents"))


SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_SPACED_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35),
x AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 35], ' ') AS win FROM s),
r AS (SELECT win FROM x GROUP BY win HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS spot FROM x JOIN r USING (win)),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d),
t AS (SELECT p.doc_id, count(*) AS n, count(g.spot) AS gone,
             string_agg(word, ' ' ORDER BY p.spot) FILTER (g.spot IS NULL) AS kept
      FROM p LEFT JOIN g USING (doc_id, spot) GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


@_query("op9_substring_dedup", SUBSTRING_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def sharding_sql(limit: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents),
e AS (SELECT d.*, g.depth::INT AS depth, h >> (60 - g.depth)::BIGINT AS p FROM d, range(61) g(depth)),
s AS (SELECT depth, p, sum(n_bytes)::BIGINT AS bytes, count(*) AS n FROM e GROUP BY ALL),
f AS (SELECT e.doc_id, e.n_bytes, e.h, min(e.depth) AS depth FROM e JOIN s USING (depth, p)
      WHERE bytes <= {limit} OR n = 1 GROUP BY ALL)
SELECT f.doc_id, f.n_bytes, f.depth AS local_depth,
       CASE WHEN f.depth = 0 THEN '' ELSE lpad(to_base((f.h >> (60 - f.depth)::BIGINT), 2), f.depth, '0') END AS shard,
       s.bytes AS shard_bytes
FROM f JOIN s ON s.depth = f.depth AND s.p = f.h >> (60 - f.depth)::BIGINT
"""


@_query("op10_extendible_sharding", sharding_sql(sharding.SHARD_BYTES))
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
f AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY r, term),
q AS (SELECT item, any_value(item_id) AS item_id, term, count(*) AS repeats
      FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
s AS (SELECT item, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(repeats * w *
             ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term), c GROUP BY item, r),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10
"""


@_query("op11_ranked_search", SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op12_quality_neighbours")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def clusters_sql(k: int, rounds: int, dim: int, scale: int) -> str:
    """K-means with every distance taken, one block of expressions a round."""
    near = f"""n{{i}} AS MATERIALIZED (SELECT r, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
    SELECT r, c.j, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{{i}} c) GROUP BY r)"""
    move = """c{n} AS MATERIALIZED (SELECT c.j, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY axis) AS q FROM (
        SELECT j, axis, sum(x)::BIGINT AS s, count(*) AS n FROM (
            SELECT j, unnest(q) AS x, unnest(range(len(q))) AS axis FROM v JOIN n{i} USING (r)) GROUP BY j, axis)
    GROUP BY j) m USING (j))"""
    steps = ",\n".join(x for i in range(rounds) for x in (near.format(i=i), move.format(i=i, n=i + 1)))
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS q FROM embeddings
    WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS j, q FROM v
    QUALIFY j < {k}),
{steps},
{near.format(i=rounds)},
s AS (SELECT j, sum(d)::BIGINT AS cluster_inertia FROM n{rounds} GROUP BY j)
SELECT vec_id, j::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM n{rounds}) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM n{rounds} JOIN v USING (r) JOIN s USING (j) JOIN c{rounds} c USING (j)
"""


@_query("op13_orchard_clusters", clusters_sql(orchard.K, orchard.ROUNDS, orchard.DIM, orchard.SCALE))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.clusters(table(spark, sf_dir, "embeddings")).drop("centroid")


__all__ = ["ORACLES", "QUERIES"]
