"""What the registered queries read: views derived from the given tables.

The tables hold no wikitext, no dump file and no words with vectors. The views make them out
of whole tables, by SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import pages as page_ops
from marginalia.operators.corpus import sentences, vocabulary_counts
from marginalia.operators.graph import Graph, build_graph
from marginalia.scratch import Scratch
from marginalia.sources.dump import spread_out

# One page per document, of which some are talk or without text where a query filters articles
# (MIXED); otherwise every document is an article (PLAIN). Pages link within blocks of ten; every third block also links to one
# hub page and, by section, to nowhere. So a third of the pages share a link target, and the
# rest falls into many components.
WIKITEXT_SQL = """
SELECT doc_id,
  'Doc ' || CAST(doc_id AS STRING) AS title,
  CAST({ns} AS BIGINT) AS ns,
  CASE WHEN {missing} THEN NULL ELSE
    '== Titre ==' || chr(10)
    || repeat(chr(39), 3) || 'Doc' || repeat(chr(39), 3) || ' voir [[Doc '
    || CAST(doc_id - doc_id % 10 + (doc_id * 7 + 1) % 10 AS STRING) || '#Histoire|alias]] et [[Doc '
    || CAST(CASE WHEN doc_id % 30 < 10
         THEN t - t % 30 + t % 10
         ELSE doc_id - doc_id % 10 + (doc_id * doc_id + 3) % 10 END AS STRING) || '|nom]]'
    || CASE WHEN doc_id % 30 < 10
         THEN ' et [[Lyon (ville)|Lyon]] ou [[Lyon (ville)]] et [[#Ici]] [[#]]' ELSE '' END
    || '. {{Infobox|a {{b}} c}} {{Date|1|mai|1900}} [[Catégorie:X]]'
    || '<ref>note ' || CAST(doc_id AS STRING) || '</ref> suite<br/> vu ([lien]) ici; l’eau '
    || '&lt;ref&gt;cachée&lt;/ref&gt; fin. . Ok' || chr(10)
    || '* puce' || chr(10) || text END AS text
FROM (SELECT *, (doc_id * 13 + 5) % (doc_id - doc_id % 30 + 30) AS t FROM {documents}) d
"""

MIXED = {"ns": "CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 0 END", "missing": "doc_id % 50 = 23"}
PLAIN = {"ns": "0", "missing": "FALSE"}

# One record of a dump per document, of which some are not well-formed, name no namespace by number,
# or do not end before the next one starts.
RECORDS_SQL = """
SELECT '<page><title>Doc ' || CAST(doc_id AS STRING) || '</title><ns>'
    || CASE WHEN doc_id % 7 = 4 THEN 'zero' ELSE '0' END
    || '</ns><revision><text xml:space="preserve">'
    || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || CASE WHEN doc_id % 7 = 2 THEN '</revision>' WHEN doc_id % 7 = 5 THEN '</text>' ELSE '</text></revision>' END AS record,
  doc_id % 7 <> 5 AS ends, doc_id % 7 IN (2, 4, 5) AS broken
FROM {documents}
"""

# A property graph over all documents, where each tenth edge or so names no known vertex.
PROPERTY_VERTICES_SQL = """
SELECT doc_id AS id, 'Doc ' || CAST(doc_id AS STRING) AS name, lang AS role FROM {documents}
"""
PROPERTY_EDGES_SQL = """
SELECT doc_id AS src,
  CASE WHEN doc_id % 10 = 9 THEN -1 - doc_id % 100 ELSE doc_id - doc_id % 7 END AS dst,
  source AS attr
FROM {documents}
"""
# The attributes of a vertex that only edges name.
DEFAULT_VERTEX = {"name": "DEFAULT_USER", "role": "MISSING"}

# All words of a benchmark item make one word-arithmetic query.
WORD_QUERIES_SQL = """
SELECT item_id AS query_id,
  replace(text, ' ', ' + ') AS expr
FROM {benchmark}
"""

# Each word of the vocabulary takes the embedding its hash points to.
WORD_VECTORS_SQL = """
SELECT word, CAST(embedding AS ARRAY<DOUBLE>) AS vector
FROM {vocabulary}
JOIN {embeddings}
ON vec_id = CAST(conv(substr(md5(word), 1, 7), 16, 10) AS BIGINT) % (SELECT count(*) FROM {embeddings})
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spread_out(table(spark, sf_dir, "documents").select("doc_id", "text"), tasks)


def wikitext_sql(kinds: dict[str, str]) -> str:
    """The view, with the name of its table still to be filled in."""
    return WIKITEXT_SQL.replace("{ns}", kinds["ns"]).replace("{missing}", kinds["missing"])


def wikitext(spark: SparkSession, sf_dir: str, kinds: dict[str, str] = PLAIN) -> DataFrame:
    return spark.sql(wikitext_sql(kinds), documents=_documents(spark, sf_dir))


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, tokens)`` with the blank-parted words of every document."""
    return _documents(spark, sf_dir).select("doc_id", F.split(F.lower("text"), " ").alias("tokens"))


def articles(spark: SparkSession, sf_dir: str, kinds: dict[str, str] = PLAIN) -> DataFrame:
    return page_ops.articles(wikitext(spark, sf_dir, kinds))


def pages(spark: SparkSession, sf_dir: str, kinds: dict[str, str] = PLAIN) -> DataFrame:
    return page_ops.with_links_and_clean_text(articles(spark, sf_dir, kinds))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_ops.link_edges(pages(spark, sf_dir))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(pages(spark, sf_dir))


def link_graph(spark: SparkSession, sf_dir: str, scratch: Scratch) -> Graph:
    """The graph of all pages, built from written links and written itself."""
    graph = build_graph(scratch.keep(links(spark, sf_dir), "links"), scratch)
    return Graph(graph.vertices, scratch.keep(graph.edges, "edges"))


def property_graph(spark: SparkSession, sf_dir: str) -> Graph:
    documents = table(spark, sf_dir, "documents")
    return Graph(
        spark.sql(PROPERTY_VERTICES_SQL, documents=documents),
        spark.sql(PROPERTY_EDGES_SQL, documents=documents),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as a vector table."""
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("w"), "vec_id").alias("word"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def vectors_of_words(spark: SparkSession, sf_dir: str, vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """A vector table over the words of ``vocabulary(word)``."""
    known = spark.sql(WORD_VECTORS_SQL, vocabulary=vocabulary, embeddings=table(spark, sf_dir, "embeddings"))
    return scratch.keep(known, "word_vectors")


def word_vectors(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """A vector table over the words of the pages."""
    return vectors_of_words(spark, sf_dir, vocabulary_counts(corpus(spark, sf_dir)), scratch)


def word_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WORD_QUERIES_SQL, benchmark=table(spark, sf_dir, "benchmark"))


def write_dump(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """Write all pages as an XML dump; returns its path."""
    body = F.struct(F.col("text").alias("_VALUE"), F.lit("preserve").alias("_xml:space"))
    dump = wikitext(spark, sf_dir, MIXED).select(
        "title", "ns", F.struct(F.when(F.col("text").isNotNull(), body).alias("text")).alias("revision")
    )
    path = scratch.file("dump.xml")
    options = {"rowTag": "page", "rootTag": "mediawiki", "validateName": "false"}
    dump.write.format("xml").options(**options).save(path)
    return path


def write_broken_dump(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """Write a dump with broken records among the pages; returns its path."""
    records = spark.sql(RECORDS_SQL, documents=_documents(spark, sf_dir)).filter("record is not null")
    path = scratch.file("broken.xml")
    records.select(F.concat("record", F.when(F.col("ends"), F.lit("</page>")).otherwise(F.lit("")))).write.text(path)
    return path


def write_lines(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """Write all turns of all conversations as a line file; returns its path."""
    path = scratch.file("lines.txt")
    table(spark, sf_dir, "conversations").select("text").write.text(path)
    return path
