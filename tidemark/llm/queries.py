"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from tidemark.llm.common import id_remainder, table
from tidemark.llm.conversation_repair import damaged, repair_report
from tidemark.llm.decontaminate import contamination_report
from tidemark.llm.feistel_shards import sharding_report
from tidemark.llm.gru_lm import lm_scores
from tidemark.llm.hard_negatives import hard_negatives, shifted
from tidemark.llm.language_id import language_id
from tidemark.llm.license_scan import license_scan
from tidemark.llm.packing import packing
from tidemark.llm.pii import pii
from tidemark.llm.quality_gam import quality_gam
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.secrets import secret_scan
from tidemark.llm.simhash import near_duplicates


def op1_pii(spark, sf_dir):
    return pii(table(spark, sf_dir, "documents"))


def op2_language(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"), id_remainder(4) != 2)


def op3_quality(spark, sf_dir):
    return quality_gam(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder(5) != 0)


def op4_secrets(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_licenses(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op9_lm(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"), id_remainder(5) != 1)


def op10_packing(spark, sf_dir):
    return packing(table(spark, sf_dir, "documents"))


def op11_sharding(spark, sf_dir):
    return sharding_report(table(spark, sf_dir, "documents"))


def op12_conversations(spark, sf_dir):
    return repair_report(damaged(table(spark, sf_dir, "conversations")), copies="copies")


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives(shifted(table(spark, sf_dir, "embeddings")))


REGISTRY = {f.__name__: f for f in (op1_pii, op2_language, op3_quality, op4_secrets, op5_decontamination, op6_simhash,
                                    op7_rules, op8_licenses, op9_lm, op10_packing, op11_sharding, op12_conversations,
                                    op13_hard_negatives)}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = {
    "op5_decontamination": f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
probe AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, w[i:i + least(len(w), 13) - 1] AS words
  FROM item, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS r(i) WHERE len(w) > 0),
doc AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
shape AS (SELECT DISTINCT m FROM probe),
win AS (SELECT row_id, i, m, w[i:i + m - 1] AS words
  FROM doc, shape, unnest(range(1, len(w) - m + 2)) AS r(i) WHERE len(w) >= m),
hit AS (SELECT win.row_id, win.i, win.m, probe.item_id FROM win JOIN probe ON win.words = probe.words),
covered AS (SELECT row_id, count(DISTINCT p) AS n_hit
  FROM hit, unnest(range(i, i + m)) AS r(p) GROUP BY row_id),
named AS (SELECT row_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY row_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (row_id) LEFT JOIN named USING (row_id)""",
    "op13_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS row_id, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.row_id AS anchor_row, a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
    CAST(list_inner_product(a.e, o.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS o ON a.vec_id % 100 = 0 AND a.row_id <> o.row_id),
pos AS (SELECT anchor_row, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id) AS k
  FROM scored WHERE same QUALIFY k <= 5)
SELECT pos.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY pos.anchor_row, k ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scored ON pos.anchor_row = scored.anchor_row AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
}
