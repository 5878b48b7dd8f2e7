"""SQL over the same tables for each registered query, in a dialect without Spark.

Regular expressions here know no look-around and no back-references.
"""

from __future__ import annotations

from marginalia.operators.embedding import SORT_DIGITS
from marginalia.operators.rank import SORT_DIGITS as RANK_DIGITS, TOP
from marginalia.plans import inputs
from marginalia.plans.registered import DIGITS, NEAREST

WP = "wp AS (" + inputs.wikitext_sql(inputs.PLAIN).format(documents="documents") + ")"
MIXED_WP = "wp AS (" + inputs.wikitext_sql(inputs.MIXED).format(documents="documents") + ")"
ART = "art AS (SELECT title, text FROM wp WHERE ns = 0 AND text IS NOT NULL)"

# The cleaning patterns, in this dialect.
TEMPLATE = r"\{\{[^{}]*\}\}"


def _regex(pattern: str, replacement: str = "", options: str = "g"):
    return lambda text: f"regexp_replace({text}, '{pattern}', '{replacement}', '{options}')"


def _templates(text: str) -> str:
    for _ in range(11):
        text = _regex(TEMPLATE)(text)
    return text


STEPS = [
    _regex("<ref>.*?</ref>|<[^>]*>", "", "gs"),
    _regex(r"(\[\[.*?\]\]).*?\(\[.*?\]\)", r"\1"),
    _regex(r"=+[ \t]*(.*)[ \t]=+"),
    _regex("''{2,3}"),
    lambda text: f"replace({text}, chr(10) || '* ', chr(10))",
    lambda text: f"replace({text}, chr(10), ' ')",
    _regex(r"\{\{Date.*?\|(.*?)\}\}", r"\1"),
    _templates,
    _regex(r"&lt;ref&gt;.*?&lt;/ref&gt;"),
    _regex(r"(\[\[[^\]]*?)\([^\]]*?\)(.*?\]\])", r"\1\2"),
    _regex(r"\[\[[^\]]+?\|(.+?)\]\]", r"[[\1]]"),
    _regex(r"\[\[[^\]]*?:[^\]]*?\]\]"),
    _regex(r"\[\[(.+?)\]\]", r"\1"),
    _regex("[,;:(|)]", " "),
    _regex(" {2,}", " "),
    _regex(r"\. \.", "."),
    _regex("’", "''"),
]


def _clean(text: str, first: int = 0) -> str:
    for step in STEPS[first:]:
        text = step(text)
    return text


CLEAN = f"clean AS (SELECT title, {_clean('text')} AS text FROM art)"
LINKS = r"""bodies AS (
  SELECT title, l.place - 1 AS place, l.body FROM (
    SELECT title, unnest(list_zip(range(1, len(b) + 1), b)) AS z FROM (
      SELECT title, regexp_extract_all(text, '\[\[(.+?)\]\]', 1) AS b FROM art)) x,
    LATERAL (SELECT z[1] AS place, z[2] AS body) l),
kept AS (
  SELECT title, body, place FROM bodies
  WHERE NOT contains(body, ':') AND NOT regexp_matches(body, '^(#+|\|+(#.*)?)$')),
links AS (
  SELECT title AS src, split_part(split_part(body, '#', 1), '|', 1) AS dst, place FROM kept)"""
PAGES = """pg AS (
  SELECT c.title, c.text, coalesce(t.targets, '') AS targets FROM clean c LEFT JOIN (
    SELECT src, string_agg(dst, '|' ORDER BY place) AS targets FROM links GROUP BY src) t
  ON c.title = t.src)"""
READ = f"WITH RECURSIVE {WP}, {ART}, {LINKS}"
READ_PAGES = f"{READ}, {CLEAN}, {PAGES}"

TOKENS = r"""sentence AS (
  SELECT regexp_replace(s, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS s FROM (
    SELECT unnest(string_split(text, '.')) AS s FROM clean) x WHERE length(s) > 0),
corpus AS (
  SELECT list_transform(list_filter(regexp_split_to_array(s, '[ '']'), lambda w: length(w) > 0),
                        lambda w: lower(w)) AS tokens FROM sentence),
counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM corpus) x GROUP BY word),
vocab AS (SELECT word, n FROM counts WHERE n >= 5)"""
READ_TOKENS = f"WITH {WP}, {ART}, {CLEAN}, {TOKENS}"

LINES = """lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM conversations),
line_corpus AS (
  SELECT CASE WHEN rtrim(value, ' ') = '' THEN [] ELSE string_split(rtrim(value, ' '), ' ') END AS tokens
  FROM lines WHERE length(value) > 0)"""

VERTICES = "verts AS (SELECT DISTINCT unnest([src, dst]) AS v FROM links)"

# Each vertex has one row to itself of weight 0. The rounds go on to the fixed point, so close that
# the digits compared no longer depend on where they stop.
RANKS_STAND_STILL = 1e-14
RANKS = f"""pairs AS (SELECT src, dst, count(*) AS n FROM links GROUP BY src, dst),
weights AS (
  SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w, false AS keeper FROM pairs
  UNION ALL SELECT v, v, 0.0, true FROM verts),
rounds(it, v, rank, delta) AS (
  SELECT 0, v, 0.15::DOUBLE, 1.0::DOUBLE FROM verts
  UNION ALL
  SELECT it + 1, dst, 0.15 + 0.85 * sum(rank * w),
         abs(0.15 + 0.85 * sum(rank * w) - max(CASE WHEN keeper THEN rank END))
  FROM rounds JOIN weights ON v = src
  WHERE it < 1000 AND (SELECT max(delta) FROM rounds) > {RANKS_STAND_STILL}
  GROUP BY it, dst),
ranks AS (SELECT v AS label, rank FROM rounds WHERE it = (SELECT max(it) FROM rounds)),
best AS (SELECT label, rank FROM ranks ORDER BY round(rank, {RANK_DIGITS}) DESC, label LIMIT {TOP})"""


def _neighbours(order: str) -> str:
    return f"""around AS (
  SELECT src AS top_label, dst AS neighbour FROM links WHERE src IN (SELECT label FROM best)
  UNION ALL
  SELECT dst, src FROM links WHERE dst IN (SELECT label FROM best)),
near AS (
  SELECT * FROM (
    SELECT top_label, neighbour, rank, row_number() OVER (
      PARTITION BY top_label ORDER BY round(rank, {RANK_DIGITS}) {order}, neighbour) AS place
    FROM around JOIN ranks ON label = neighbour) x
  WHERE place <= {TOP}),
ids AS (SELECT DISTINCT unnest([top_label, neighbour]) AS label FROM near)"""


READ_RANKS = f"{READ}, {VERTICES}, {RANKS}"
READ_NEAR = f"{READ_RANKS}, {_neighbours('ASC')}"

COMPONENTS = """touch AS (
  SELECT src AS a, dst AS b FROM links UNION SELECT dst, src FROM links UNION SELECT v, v FROM verts),
spread(it, v, c, moved) AS (
  SELECT 0, v, v, true FROM verts
  UNION ALL
  SELECT it + 1, a, min(c), min(c) <> max(CASE WHEN a = b THEN c END)
  FROM spread JOIN touch ON v = b
  WHERE (SELECT bool_or(moved) FROM spread)
  GROUP BY it, a),
comps AS (SELECT v AS label, c AS component_label FROM spread WHERE it = (SELECT max(it) FROM spread))"""

# The procedural tag loop: each round deletes at the first '<', or ends the page's loop.
TAG_LOOP = """cut(title, text, live) AS (
  SELECT title, text, true FROM art
  UNION ALL
  SELECT title,
    CASE WHEN stop THEN text ELSE substr(text, 1, opened - 2) || substr(text, resume) END, NOT stop
  FROM (
    SELECT *, e = 0 OR opened = 1 OR resume - 1 > length(text) AS stop FROM (
      SELECT *, CASE WHEN c = 0 THEN opened + e + 1 ELSE opened + e + c + length(label) + 1 END AS resume FROM (
        SELECT *, strpos(substr(text, opened + e), label) AS c FROM (
          SELECT *, '/' || substr(text, opened + 1, e - 1) AS label FROM (
            SELECT *, strpos(substr(text, opened + 1), '>') AS e FROM (
              SELECT title, text, strpos(text, '<') AS opened FROM cut WHERE live) a
            WHERE opened > 0) b) c) d) f) g),
looped AS (
  SELECT title, arg_min(text, length(text)) AS text FROM cut GROUP BY title)"""

PROPERTY = f"""pv AS ({inputs.PROPERTY_VERTICES_SQL.format(documents='documents')}),
pe AS ({inputs.PROPERTY_EDGES_SQL.format(documents='documents')}),
whole AS (
  SELECT * FROM pv UNION ALL
  SELECT DISTINCT dst, 'DEFAULT_USER', 'MISSING' FROM pe WHERE dst NOT IN (SELECT id FROM pv))"""


def _triplets(vertices: str) -> str:
    return f"""SELECT src, dst, attr, s.name AS src_name, s.role AS src_role, d.name AS dst_name,
  d.role AS dst_role FROM pe LEFT JOIN {vertices} s ON s.id = src LEFT JOIN {vertices} d ON d.id = dst"""


VECTORS = "vec AS (SELECT vec_id, 'w' || vec_id AS word, embedding::DOUBLE[] AS a FROM embeddings)"


def _values(vector: str, source: str, key: str = "word") -> str:
    return f"""SELECT {key}, CAST(place - 1 AS INTEGER) AS place, round(a[place], {DIGITS}) AS value FROM (
  SELECT {key}, a, unnest(range(1, len(a) + 1)) AS place FROM (SELECT {key}, {vector} AS a FROM {source}) x) y"""


PAIRS = "vec x JOIN (SELECT vec_id - 1 AS vec_id, a AS b FROM vec) z ON x.vec_id = z.vec_id"
BOTH = f"both_vecs AS (SELECT word, a, b FROM {PAIRS})"

WORD_VECTORS = """known AS (
  SELECT word, embedding::DOUBLE[] AS vector FROM vocab JOIN embeddings
  ON vec_id = CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) % (SELECT count(*) FROM embeddings))"""
READ_VECTORS = f"{READ_TOKENS}, {WORD_VECTORS}"

SIMILAR = "CASE WHEN list_dot_product(vector, vector) * list_dot_product(aim, aim) > 0 THEN list_cosine_similarity(vector, aim) ELSE 0.0 END"


def _nearest(aim: str) -> str:
    return f"""scored AS (SELECT word, {SIMILAR} AS similarity FROM known, (SELECT {aim} AS aim) t)
SELECT word, round(similarity, {DIGITS}) AS similarity FROM scored
ORDER BY round(similarity, {SORT_DIGITS}) DESC, word LIMIT {NEAREST}"""


def _vector(word: str) -> str:
    return f"(SELECT vector FROM known WHERE word = '{word}')"


QUERY_VECTORS = r"""asked AS (""" + inputs.WORD_QUERIES_SQL.format(benchmark="benchmark") + r"""),
parts AS (SELECT query_id, unnest(regexp_extract_all(expr, '[+-]?[^+-]+')) AS part FROM asked),
terms AS (
  SELECT query_id, CASE WHEN part LIKE '-%' THEN -1 ELSE 1 END AS sign,
    lower(regexp_replace(regexp_replace(part, '^[+-]', ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) AS word
  FROM parts),
spots AS (
  SELECT query_id, place, sum(sign * vector[place]) AS value FROM (
    SELECT query_id, sign, vector, unnest(range(1, len(vector) + 1)) AS place
    FROM terms JOIN known USING (word)) x GROUP BY query_id, place),
aims AS (SELECT query_id, list(value ORDER BY place) AS aim FROM spots GROUP BY query_id)"""

DIMENSION = "(SELECT len(vector) FROM known LIMIT 1)"
ZEROS = f"list_transform(range({DIMENSION}), lambda i: 0.0::DOUBLE)"

EDGE_LABELS = "SELECT src AS src_label, dst AS dst_label, CAST(1 AS BIGINT) AS weight FROM links"

ORACLES: dict[str, str] = {
    # pages
    "dump_scan": f"WITH {WP} SELECT title, ns, text FROM wp",
    "dump_rejects": f"""WITH records AS ({inputs.RECORDS_SQL.format(documents="documents")})
  SELECT record, (SELECT count(*) FROM records WHERE NOT broken) AS pages FROM records WHERE broken""",
    "articles": f"WITH {WP}, {ART} SELECT * FROM art",
    "import_pages": f"{READ_PAGES} SELECT * FROM pg",
    "import_dump": f"""{READ}, {VERTICES} SELECT (SELECT count(*) FROM links) AS edges,
  (SELECT count(*) FROM verts) AS vertices, (SELECT count(*) FROM art) AS pages""",
    "pages_round_trip": f"{READ_PAGES} SELECT * FROM pg",
    "pages_export_json": f"{READ_PAGES} SELECT * FROM pg",
    "page_count": f"WITH {WP}, {ART} SELECT count(*) AS pages FROM art",
    "find_page": f"{READ_PAGES} SELECT *, 1 AS page FROM pg WHERE title = 'Doc 10'",
    "find_pages": f"""{READ_PAGES} SELECT * FROM pg
  WHERE title IN (SELECT 'Doc ' || CAST(doc_id AS VARCHAR) FROM labels)""",
    "page_outlinks": f"""{READ} SELECT title, coalesce(o.outlinks, '') AS outlinks FROM art LEFT JOIN (
  SELECT src, string_agg(dst, '|' ORDER BY dst) AS outlinks
  FROM (SELECT DISTINCT src, dst FROM links) d GROUP BY src) o ON title = src""",
    "load_session": f"""{READ}, {VERTICES} SELECT (SELECT count(*) FROM links) AS edges,
  (SELECT count(*) FROM verts) AS vertices, (SELECT count(*) FROM art) AS pages""",
    "lines_nearest": f"""WITH {LINES}, words AS (SELECT DISTINCT unnest(tokens) AS word FROM line_corpus)
  SELECT CAST(place AS INTEGER) AS place, true AS known, true AS rises, true AS recomputed, place = 1 AS target
  FROM (SELECT unnest(range(1, least({NEAREST}, (SELECT count(*) FROM words)) + 1)) AS place) p""",
    # cleaning
    **{
        f"clean_t{i}": f"WITH {WP}, {ART} SELECT title, {step('text')} AS text FROM art"
        for i, step in enumerate(STEPS)
    },
    "clean_pages": f"WITH {WP}, {ART}, {CLEAN} SELECT * FROM clean",
    "clean_pages_compat": f"""WITH RECURSIVE {WP}, {ART}, {TAG_LOOP}
  SELECT title, {_clean('text', first=1)} AS text FROM looped""",
    # links
    "link_match": f"{READ} SELECT title, CAST(place AS INTEGER) AS place, body FROM bodies",
    "page_links": f"""{READ} SELECT src, dst,
  CAST(row_number() OVER (PARTITION BY src ORDER BY place) - 1 AS INTEGER) AS place FROM links""",
    "link_edges": f"{READ} SELECT src, dst, count(*) AS n FROM links GROUP BY src, dst",
    # words
    "sentences": f"""{READ_TOKENS} SELECT array_to_string(tokens, '|') AS tokens,
  CAST(len(tokens) AS INTEGER) AS n_tokens FROM corpus""",
    "line_scan": f"WITH {LINES} SELECT value FROM lines",
    "line_tokens": f"""WITH {LINES} SELECT array_to_string(tokens, '|') AS tokens,
  CAST(len(tokens) AS INTEGER) AS n_tokens FROM line_corpus""",
    "corpus_words": f"WITH {LINES} SELECT DISTINCT unnest(tokens) AS word FROM line_corpus",
    "vocabulary_counts": f"{READ_TOKENS} SELECT word, n FROM vocab",
    # graphs
    "graph_vertices": f"{READ}, {VERTICES} SELECT v AS label FROM verts",
    "encode_edges": f"{READ} {EDGE_LABELS}",
    "graph_round_trip": f"{READ} {EDGE_LABELS}",
    "graph_size": f"""{READ}, {VERTICES} SELECT (SELECT count(*) FROM links) AS edges,
  (SELECT count(*) FROM verts) AS vertices""",
    "triplets": f"WITH {PROPERTY} {_triplets('pv')}",
    "graph_with_default": f"WITH {PROPERTY} {_triplets('whole')}",
    "incident_edges": f"""WITH {PROPERTY} SELECT src_name || '--(' || attr || ')--' || dst_name AS triplet
  FROM ({_triplets('whole')}) t WHERE src_name = 'Doc 14' OR dst_name = 'Doc 14'""",
    "neighbour_ids": f"""{READ} SELECT label, neighbour, count(*) AS n FROM (
  SELECT src AS label, dst AS neighbour FROM links UNION ALL SELECT dst, src FROM links) b
  GROUP BY label, neighbour""",
    "induced_subgraph": f"{READ} {EDGE_LABELS} WHERE dst IN (SELECT src FROM links)",
    "page_rank": f"{READ_RANKS} SELECT label, round(rank, {DIGITS}) AS rank FROM ranks",
    "top_rank_vertices": f"{READ_RANKS} SELECT label, round(rank, {DIGITS}) AS rank FROM best",
    "top_neighbours": f"""{READ_NEAR} SELECT top_label, CAST(place AS INTEGER) AS place, neighbour,
  round(rank, {DIGITS}) AS rank FROM near""",
    "top_neighbours_desc": f"""{READ_RANKS}, {_neighbours('DESC')}
  SELECT top_label, CAST(place AS INTEGER) AS place, neighbour, round(rank, {DIGITS}) AS rank FROM near""",
    "top_rank_ids": f"{READ_NEAR} SELECT label FROM ids",
    "top_rank_subgraph": f"""{READ_NEAR} SELECT src AS from_label, dst AS to_label FROM links
  WHERE src IN (SELECT label FROM ids) AND dst IN (SELECT label FROM ids)""",
    "components": f"{READ}, {VERTICES}, {COMPONENTS} SELECT label, component_label FROM comps",
    "community_count": f"""{READ}, {VERTICES}, {COMPONENTS}
  SELECT count(DISTINCT component_label) AS communities FROM comps""",
    # vectors
    "vector_add": f"WITH {VECTORS}, {BOTH} {_values('list_transform(list_zip(a, b), lambda p: p[1] + p[2])', 'both_vecs')}",
    "vector_sub": f"WITH {VECTORS}, {BOTH} {_values('list_transform(list_zip(a, b), lambda p: p[1] - p[2])', 'both_vecs')}",
    "vector_opposite": f"WITH {VECTORS} {_values('list_transform(a, lambda x: -x)', 'vec')}",
    "vector_distance": f"WITH {VECTORS}, {BOTH} SELECT word, round(list_distance(a, b), {DIGITS}) AS distance FROM both_vecs",
    "vectors_export_json": f"WITH {VECTORS} {_values('a', 'vec')}",
    "synonyms": f"{READ_VECTORS}, {_nearest(_vector('doc'))}",
    "sum_words": f"""{READ_VECTORS},
{_nearest(f"list_transform(list_zip({_vector('doc')}, {_vector('ok')}), lambda p: p[1] - p[2])")}""",
    "word_query": f"""{READ_VECTORS}, {QUERY_VECTORS},
placed AS (
  SELECT query_id, word, similarity, row_number() OVER (
    PARTITION BY query_id ORDER BY round(similarity, {SORT_DIGITS}) DESC, word) AS place
  FROM (SELECT query_id, word, {SIMILAR} AS similarity FROM aims, known) s)
SELECT query_id, CAST(place AS INTEGER) AS place, word, round(similarity, {DIGITS}) AS similarity
FROM placed WHERE place <= {NEAREST}""",
    "nearest_euclid": f"""{READ_VECTORS},
away AS (
  SELECT c.word, list_distance(coalesce(k.vector, {ZEROS}), {_vector('doc')}) AS distance
  FROM counts c LEFT JOIN known k ON c.word = k.word)
SELECT word, round(distance, {DIGITS}) AS distance FROM away
ORDER BY round(distance, {SORT_DIGITS}), word LIMIT {NEAREST}""",
    "document_vectors": f"""{READ_VECTORS},
doc_words AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM doc_words GROUP BY doc_id),
parts AS (
  SELECT doc_id, vector, unnest(range(1, len(vector) + 1)) AS place FROM doc_words JOIN known USING (word)),
sums AS (SELECT doc_id, place, sum(vector[place]) AS value FROM parts GROUP BY doc_id, place),
spots AS (SELECT doc_id, n, unnest(range(1, {DIMENSION} + 1)) AS place FROM sizes)
SELECT doc_id, CAST(place - 1 AS INTEGER) AS place, round(coalesce(value, 0.0) / n, {DIGITS}) AS value
FROM spots LEFT JOIN sums USING (doc_id, place)""",
    "vocabulary": f"{READ_TOKENS} SELECT word FROM vocab",
    "word2vec_vocab": f"{READ_TOKENS} SELECT word, 50 AS dimension FROM vocab",
    "word2vec_lines": f"""WITH {LINES} SELECT word, 300 AS dimension
  FROM (SELECT unnest(tokens) AS word FROM line_corpus) x GROUP BY word HAVING count(*) >= 5""",
}

# These filter articles, so theirs is the view with pages of other kinds.
for _name in ("dump_scan", "articles", "import_pages", "import_dump", "load_session", "page_count"):
    ORACLES[_name] = ORACLES[_name].replace(WP, MIXED_WP)
