"""Registered queries of the package: thin calls of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from .common import bounded_batches, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(bounded_batches(prepare(spark)), sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


@query("op10_quality_discriminant")
def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    from . import quality
    return quality.op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_benchmark_prefix_join")
def q_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    from . import decontam
    return decontam.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op9_benchmark_prefix_join"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS k, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM i WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM w, lens WHERE len(ws) >= k)),
hit AS (SELECT doc_id, p, dw.k, item FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
          FROM hit GROUP BY 1)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op6_extendible_hash_dedup")
def q_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    from . import exact_dedup
    return exact_dedup.op6(table(spark, sf_dir, "documents"))


ORACLE["op6_extendible_hash_dedup"] = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM n JOIN g USING (h)
"""


@query("op5_permutation_table_sharding")
def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    from . import sharding
    return sharding.op5(table(spark, sf_dir, "documents"))


def _sharding_sql() -> str:
    from .sharding import SLOTS, lookup_table, shard_names
    owners = ",".join(map(str, lookup_table(shard_names())))
    return f"""
WITH s AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
                  % {SLOTS} AS slot FROM documents),
t AS (SELECT [{owners}] AS owners)
SELECT doc_id, slot, CAST(owners[slot + 1] AS INTEGER) AS shard FROM s, t
"""


ORACLE["op5_permutation_table_sharding"] = _sharding_sql()


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query("op4_token_id_orc")
def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back."""
    from . import token_files
    return token_files.op4(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op8_configuration_packing")
def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    from . import packing
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op2_warc_archive")
def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    from . import warc
    return warc.op2(table(spark, sf_dir, "pages"))


def _base32_of_hex(digits: str) -> str:
    """SQL for the base32 form of 40 hex digits: five digits make four letters."""
    letters = []
    for i in range(8):
        group = f"CAST('0x' || substr({digits}, {5 * i + 1}, 5) AS INTEGER)"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({group} >> {s}) & 31) + 1, 1)"
                    for s in (15, 10, 5, 0)]
    return " || ".join(letters)


ORACLE["op2_warc_archive"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT html, max(page_id) AS top FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_base32_of_hex("hex")} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p JOIN g USING (html)
"""


@query("op1_crf_language")
def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by word-level CRF posteriors."""
    from . import language
    return language.op1(table(spark, sf_dir, "documents"))


@query("op7_combination_jaccard_join")
def q_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy classes of all documents."""
    from . import jaccard_join
    return jaccard_join.op7(table(spark, sf_dir, "documents"))


ORACLE["op7_combination_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + least(len(ws), 3) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(len(ws), 3) + 2)) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT g, count(*) AS c FROM s GROUP BY g HAVING count(*) > 1),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM (SELECT x.doc_id, y.doc_id AS other, count(*) AS k FROM s x JOIN df USING (g) JOIN s y USING (g)
        WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) z
  JOIN n x ON x.doc_id = z.doc_id JOIN n y ON y.doc_id = z.other
  WHERE 100 * z.k >= 90 * (x.n + y.n - z.k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""


@query("op3_induced_suffix_dedup")
def q_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings cut from every document."""
    from . import suffix_dedup
    return suffix_dedup.op3(table(spark, sf_dir, "documents"))


@query("op12_gray_code_filter_audit")
def q_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of five filters over all documents, by language."""
    from . import filter_audit
    return filter_audit.op12(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_gray_code_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
m AS (
  SELECT doc_id, part, concat(
           CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END,
           CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END,
           CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END,
           CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
           CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails FROM d),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
         count(*) FILTER (WHERE toxic = 1) AS toxic FROM m LEFT JOIN labels USING (doc_id) GROUP BY part, fails),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
         sum(CASE WHEN translate(fails, before || x, '') = fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, x) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN translate(fails, before, '') <> fails AND contains(fails, x) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, x) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, x) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""


@query("op13_shared_list_hard_negatives")
def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all vectors."""
    from . import hard_negatives
    return hard_negatives.op13(table(spark, sf_dir, "embeddings"))


ORACLE["op13_shared_list_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS z
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same,
         CAST(list_inner_product(a.z, v.z) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10
"""


@query("op11_robust_pruned_graph_dedup")
def q_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy classes of all vectors."""
    from . import embedding_dedup
    return embedding_dedup.op11(table(spark, sf_dir, "embeddings"))


ORACLE["op11_robust_pruned_graph_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM r LEFT JOIN n ON n.a = r.a GROUP BY r.a
"""
