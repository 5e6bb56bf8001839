"""Registered queries of the operators, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import encode_decode
from riskloom.llm.classifier import classify, fit_classifier
from riskloom.llm.common import documents, labels
from riskloom.llm.context_mixing import score_texts
from riskloom.llm.exact_dedup import exact_duplicates
from riskloom.llm.hard_negatives import hard_negatives, whole_vectors
from riskloom.llm.licenses import BASE_PHRASES, MIN_COVER, NEIGHBOURS, PASSAGES, scan_licenses
from riskloom.llm.mixing import mix_sources
from riskloom.llm.near_dedup import near_duplicates
from riskloom.llm.pii import personal_data_digest
from riskloom.llm.prefix_trie import numbered_turns, prefix_trie, shared_openings, trie_digest
from riskloom.llm.quality_rules import apply_rules, fit_quality
from riskloom.llm.secrets import scan_history, secret_digest
from riskloom.llm.toxicity import fit_toxicity, score_toxicity
from riskloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@_query(r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


@_query(r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size * (6 // ((rank - 1) % 3 + 1)) AS level FROM s),
f AS (SELECT *, coalesce(sum(3 * source_size) OVER below, 0) AS cap_below, sum(weight) OVER above AS weight_left, (SELECT sum(size) FROM d) AS budget FROM w
      WINDOW below AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), above AS (ORDER BY level, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g AS (SELECT *, (budget - cap_below) * 6 > level * weight_left AS is_full FROM f),
h AS (SELECT *, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(budget - (SELECT coalesce(sum(3 * source_size), 0) FROM g WHERE is_full) AS DOUBLE) * weight
      / CAST((SELECT sum(weight) FROM g WHERE NOT is_full) AS DOUBLE) END AS target FROM g),
q AS (SELECT d.doc_id, d.size, d.key, h.rank, h.weight, h.source_size, h.target, h.budget,
      sum(d.size) OVER (PARTITION BY h.rank ORDER BY d.key ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
c AS (SELECT *, (upto + k * source_size) * (6 // weight) AS t FROM q, (VALUES (0), (1), (2)) AS rounds(k) WHERE size > 0),
t AS (SELECT doc_id, size, budget, sum(size) OVER (ORDER BY t, rank, key ROWS UNBOUNDED PRECEDING) AS total FROM c),
k AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM t WHERE total <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0) AS taken FROM q LEFT JOIN k USING (doc_id)""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).drop("source")


@_query(r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id, min(r.c) = d.doc_id AS kept FROM d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, percent=85)


@_query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return apply_rules(docs, fit_quality(docs, labels(spark, sf_dir)))


@_query()
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


@_query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classify(docs, fit_classifier(docs, labels(spark, sf_dir)))


_TEMPLATES = ", ".join(f"({i}, '{text}', '{label}', {str(i < len(BASE_PHRASES)).lower()})" for i, (text, label) in enumerate([*BASE_PHRASES, *PASSAGES]))


@_query(rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT template, label, is_base, string_split(phrase, ' ') AS p FROM (VALUES {_TEMPLATES}) AS v(template, phrase, label, is_base)),
tg AS (SELECT *, len(p) - 2 AS n_grams, unnest(range(0, len(p) - 2)) AS place FROM t),
dg AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, 0))) AS pos FROM d),
h AS (SELECT DISTINCT doc_id, template, place, pos - place AS diagonal FROM dg JOIN tg ON w[pos + 1] = p[place + 1] AND w[pos + 2] = p[place + 2] AND w[pos + 3] = p[place + 3]),
v AS (SELECT DISTINCT doc_id, template, diagonal, is_base FROM h JOIN t USING (template)),
e AS (SELECT *, CASE WHEN is_base OR diagonal - lag(diagonal) OVER o <= {NEIGHBOURS} IS NOT TRUE THEN 1 ELSE 0 END AS new_run FROM v WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
r AS (SELECT *, sum(new_run) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS run FROM e),
m AS (SELECT doc_id, template, run, min(diagonal + place) AS first_word, count(DISTINCT place) AS covered FROM h JOIN r USING (doc_id, template, diagonal) GROUP BY ALL),
s AS (SELECT doc_id, label, is_base, first_word, covered / (len(p) - 2) AS cover FROM m JOIN t USING (template) WHERE CASE WHEN is_base THEN covered = len(p) - 2 ELSE covered / (len(p) - 2) >= {MIN_COVER} END),
f AS (SELECT doc_id, count(*) FILTER (is_base) AS n_base, min(first_word) FILTER (is_base) AS first_word, max(first_word) FILTER (is_base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM s GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (doc_id)""")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


@_query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, fit_toxicity(docs, labels(spark, sf_dir)))


@_query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(documents(spark, sf_dir))


@_query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


# crc32, bit by bit
_CRC = "xor(list_reduce(list_transform(string_split({}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda acc, b: list_reduce(range(8), lambda x, i: xor(x // 2, 3988292384 * (x % 2)), xor(acc, b)), 4294967295), 4294967295)"


@_query(rf"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS words
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, max(place) AS own, conv_id - conv_id % 20 AS first, {_CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.place, t.digest, t.words FROM c JOIN t ON t.conv_id = c.first AND t.place <= c.h
      UNION ALL SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(b.own, 0)), t.digest, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h LEFT JOIN c b ON b.conv_id = c.first),
s AS (SELECT c.conv_id, coalesce(list(digest ORDER BY place) FILTER (digest IS NOT NULL), []) AS d, coalesce(list(words ORDER BY place) FILTER (digest IS NOT NULL), []) AS w FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, len(d) AS length, unnest(range(0, len(d) + 1)) AS depth, d, w FROM s),
k AS (SELECT conv_id, length, depth, array_to_string(d[1:depth], ',') AS node, CASE WHEN depth > 0 THEN array_to_string(d[1:depth - 1], ',') END AS up, CASE WHEN depth > 0 THEN w[depth] ELSE 0 END AS words, d FROM p),
n AS (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(d) AS d,
      string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth) AS ends FROM k GROUP BY depth, node),
q AS (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(q.n_children, 0) AS n_children FROM n LEFT JOIN q ON q.up = n.node AND q.depth = n.depth),
a AS (SELECT array_to_string(d[1:x], ',') AS node, x AS depth, n_children = 0 AS leaf, (n_convs - 1) * words AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS x FROM m)),
u AS (SELECT node, depth, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM a GROUP BY ALL)
SELECT m.conv_id, m.depth, z.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, u.saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN u ON u.node = m.node AND u.depth = m.depth LEFT JOIN m z ON z.node = m.up AND z.depth = m.depth - 1""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = shared_openings(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return trie_digest(prefix_trie(turns, convs))


@_query()
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_history(documents(spark, sf_dir), scratch_path(spark, "secret-ledger"), path_col="doc_id", version_col=None))


@_query(r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(whole_vectors(table, label=moved), F.col("vec_id") % 100 == 0)
