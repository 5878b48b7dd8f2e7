"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginalia.llm.bpe import document_tokens
from marginalia.llm.decontamination import contamination
from marginalia.llm.hilbert import document_shards
from marginalia.llm.jaccard_join import near_documents
from marginalia.llm.near_vectors import near_embeddings
from marginalia.llm.packing import packed
from marginalia.llm.quotations import MAIL_SQL, link_quotations, mail
from marginalia.llm.ranking import quality_scores
from marginalia.llm.spelling import document_spellings
from marginalia.llm.suffix_dedup import repeats_removed
from marginalia.llm.tables import table
from marginalia.llm.topk_search import embedding_search
from marginalia.llm.warc import archive_pages
from marginalia.llm.whitening import whitened_embeddings
from marginalia.scratch import Scratch

LLM_QUERIES = {}
LLM_ORACLES = {}


def registered(run):
    LLM_QUERIES[run.__name__] = run
    return run


@registered
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_search(table(spark, sf_dir, "embeddings"), Scratch(spark))


@registered
def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"), Scratch(spark))


@registered
def op5_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), Scratch(spark))


LLM_ORACLES["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@registered
def op10_global_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return document_tokens(table(spark, sf_dir, "documents"), ranks, pattern, Scratch(spark))


@registered
def op8_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@registered
def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op3_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(mail(table(spark, sf_dir, "conversations")), Scratch(spark), apart=True)


LLM_ORACLES["op3_quotation_threads"] = (
    """
WITH RECURSIVE mail AS (
"""
    + MAIL_SQL.format(conversations="conversations")
    + r"""
), lines AS (
  SELECT conv_id, turn, role, i, lvl, body
  FROM (
    SELECT conv_id, turn, role, i, length(replace(replace(regexp_extract(line, '^[ \t]{0,3}((?:>[ \t]?)+)', 1), ' ', ''), chr(9), '')) AS lvl,
      regexp_replace(line, '^[ \t]{0,3}((?:>[ \t]?)+)', '') AS body
    FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM mail)
  )
  WHERE trim(body) <> ''
), runs AS (
  SELECT *, sum(CASE WHEN lvl IS DISTINCT FROM last THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run
  FROM (SELECT *, lag(lvl) OVER (PARTITION BY conv_id, turn ORDER BY i) AS last FROM lines)
), passages AS (
  SELECT conv_id, turn, run, min(lvl) AS lvl, string_agg(body, chr(10) ORDER BY i) AS body FROM runs GROUP BY 1, 2, 3
), hashed AS (
  SELECT conv_id, turn, run, lvl, md5(trim(regexp_replace(lower(body), '[ \t\r\n\f\x0B]+', ' ', 'g'))) AS h FROM passages
), whole AS (
  SELECT conv_id, turn, string_agg(body, chr(10) ORDER BY run) AS text FROM passages WHERE lvl = 0 GROUP BY 1, 2
), spoken AS (
  SELECT conv_id, turn, h FROM hashed WHERE lvl = 0
  UNION SELECT conv_id, turn, md5(trim(regexp_replace(lower(text), '[ \t\r\n\f\x0B]+', ' ', 'g'))) FROM whole
), linked AS (
  SELECT q.conv_id, q.turn, q.run, q.lvl, max(s.turn) AS source
  FROM hashed q LEFT JOIN spoken s ON q.conv_id = s.conv_id AND q.h = s.h AND s.turn < q.turn
  WHERE q.lvl > 0 GROUP BY 1, 2, 3, 4
), replies AS (
  SELECT conv_id, turn, arg_min(source, run) FILTER (lvl = 1 AND source IS NOT NULL) AS parent_turn, count(source) AS n_linked, count(*) AS n_quotes
  FROM linked GROUP BY 1, 2
), threads AS (
  SELECT m.conv_id, m.turn, m.role, r.parent_turn, coalesce(w.text, '') AS text, coalesce(r.n_linked, 0) AS n_linked, coalesce(r.n_quotes, 0) AS n_quotes
  FROM mail m LEFT JOIN replies r ON m.conv_id = r.conv_id AND m.turn = r.turn LEFT JOIN whole w ON m.conv_id = w.conv_id AND m.turn = w.turn
), placed AS (
  SELECT conv_id, turn, turn AS root_turn, CAST(0 AS BIGINT) AS depth FROM threads WHERE parent_turn IS NULL
  UNION ALL
  SELECT t.conv_id, t.turn, p.root_turn, p.depth + 1 FROM threads t JOIN placed p ON t.conv_id = p.conv_id AND t.parent_turn = p.turn
)
SELECT t.conv_id, t.turn, t.role, t.parent_turn, p.root_turn, p.depth, CAST(t.n_quotes AS INTEGER) AS n_quotes, CAST(t.n_linked AS BIGINT) AS n_linked, t.text
FROM threads t JOIN placed p ON t.conv_id = p.conv_id AND t.turn = p.turn
"""
)


@registered
def op7_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"), Scratch(spark))


@registered
def op6_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"), Scratch(spark))


@registered
def op1_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(table(spark, sf_dir, "documents"), Scratch(spark))


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


LLM_ORACLES["op6_partition_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE
      WHEN coalesce(len(w), 0) = 0 THEN []
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n - count(*) AS total, count(*) AS shared
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n
), links AS (
  SELECT x, y FROM pairs WHERE 100 * shared >= 75 * total UNION SELECT y, x FROM pairs WHERE 100 * shared >= 75 * total
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION
  SELECT r.id, l.y FROM reach r JOIN links l ON r.other = l.x
)
SELECT d.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN shingled s ON d.doc_id = s.doc_id JOIN reach r ON d.doc_id = r.id
GROUP BY d.doc_id, len(s.s)
"""
LLM_ORACLES["op7_collision_counting"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION
  SELECT r.id, l.y FROM reach r JOIN links l ON r.other = l.x
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY 1
)
SELECT e.vec_id, CAST(coalesce(max(c.n), 0) AS BIGINT) AS n_links, min(r.other) AS component_id, min(r.other) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON e.vec_id = r.id LEFT JOIN counts c ON e.vec_id = c.x
GROUP BY e.vec_id
"""


@registered
def op11_window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))


LLM_ORACLES["op11_window_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), found AS (
  SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND array_to_string(w[i:i + p.size - 1], ' ') = v.words
), hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id
"""


@registered
def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"), Scratch(spark))


@registered
def op12_sorted_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_spellings(table(spark, sf_dir, "documents"), Scratch(spark))


# CRC-32 by its table, over the UTF-8 bytes of letters up to U+00FF; then near words by what is left
# of a word without one character.
LLM_ORACLES["op12_sorted_spellings"] = r"""
WITH RECURSIVE shifts(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shifts WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM shifts WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY 1, 2
), points AS (
  SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CAST(unicode(c) AS BIGINT)) AS p FROM runs
), summed AS (
  SELECT run, n, xor(list_reduce(
      flatten(list_transform(p, lambda u: CASE WHEN u < 128 THEN [u] ELSE [CAST(195 AS BIGINT), u - 64] END)),
      lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM points, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), way AS (
  SELECT word, word AS root, form AS further FROM formed
  UNION ALL
  SELECT w.word, f.word, f.form FROM way w JOIN formed f ON w.further = f.word
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM formed f JOIN way w ON f.word = w.word WHERE w.further IS NULL
"""
