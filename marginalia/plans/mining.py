"""Whole user operations, from a dump to saved pages, graphs, vectors and answers.

Each takes and returns DataFrames; nothing is kept between calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import corpus, embedding, pages as page_ops, rank
from marginalia.operators.components import community_count, connected_components
from marginalia.operators.graph import Graph, build_graph
from marginalia.scratch import Scratch
from marginalia.sources import store
from marginalia.sources.dump import pages_of, rejects_of, scan_dump, scan_dump_records


def read_pages(spark: SparkSession, path: str, tag_mode: str = "default") -> DataFrame:
    """Pages of a dump, with links extracted and text cleaned."""
    return page_ops.with_links_and_clean_text(page_ops.articles(scan_dump(spark, path)), tag_mode)


def import_dump(
    spark: SparkSession,
    path: str,
    folder: str,
    tag_mode: str = "default",
) -> tuple[DataFrame, Graph]:
    """Import a dump into ``folder``: parse and clean it once, then build the graph from the
    written pages.

    Records that are no pages are counted in the same pass. Only if there are any, the dump is read
    again to save them beside the pages; ``load_rejects`` gives them in either case.
    """
    seen = Observation()
    rejected = F.count("reject").alias("rejected")
    articles = page_ops.articles(pages_of(scan_dump_records(spark, path).observe(seen, rejected)))
    pages = store.save_pages(page_ops.with_links_and_clean_text(articles, tag_mode), folder)
    rejects = rejects_of(scan_dump_records(spark, path))
    store.save_rejects(rejects if seen.get["rejected"] else rejects.limit(0), folder)
    graph = build_graph(page_ops.link_edges(pages), Scratch(spark))
    return pages, store.save_graph(graph, folder)


def load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """``(record)``: what ``import_dump`` could not parse."""
    return store.load_rejects(spark, folder)


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, Graph]:
    """What ``import_dump`` has saved."""
    return store.load_pages(spark, folder), store.load_graph(spark, folder)


def find_page(pages: DataFrame, title: str) -> DataFrame:
    """``(title, text, edges, outlinks)`` of one page."""
    page = page_ops.find_page(pages, title)
    return page.withColumn("outlinks", page_ops.outlinks(F.col("edges")))


def best_ranked_graph(
    graph: Graph,
    tol: float | None = rank.TOLERANCE,
    max_iter: int | None = None,
    k: int = rank.TOP,
    neighbour_order: str = "asc",
) -> Graph:
    """The graph between the best-ranked vertices and their neighbours, for viewing."""
    scratch = Scratch(graph.edges.sparkSession)
    ranks = rank.page_rank(graph.edges, scratch, tol, max_iter)
    return rank.viewable(rank.top_rank_subgraph(graph, ranks, scratch, k, neighbour_order))


def count_communities(graph: Graph) -> DataFrame:
    return community_count(connected_components(graph.edges, Scratch(graph.edges.sparkSession)))


def embed(
    pages: DataFrame, dimension: int, window: int, iterations: int, folder: str | None = None, **training: int
) -> DataFrame:
    """The vector table of the words in the pages; ``training`` takes ``min_count``, ``partitions``
    and ``seed``. With a ``folder`` the vectors are written there once and read from there, so the
    driver need not send them along with every later answer."""
    return _vectors(corpus.sentences(pages), dimension, window, iterations, folder, training)


def embed_lines(
    lines: DataFrame, dimension: int = 300, window: int = 10, iterations: int = 3, folder: str | None = None, **training: int
) -> DataFrame:
    """The vector table of the words in a line file; see ``embed``."""
    return _vectors(corpus.line_tokens(lines), dimension, window, iterations, folder, training)


def _vectors(tokens: DataFrame, dimension: int, window: int, iterations: int, folder: str | None, training: dict) -> DataFrame:
    model = embedding.train_word_vectors(tokens, dimension, window, iterations, **training)
    found = embedding.vector_table(model)
    return store.save_vectors(found, folder) if folder else found


def nearest_in_lines(lines: DataFrame, target: str, folder: str, n: int = embedding.NEAREST, **training: int) -> DataFrame:
    """``(word, distance)``: train on a line file and find the words nearest to a target."""
    vectors = embed_lines(lines, folder=folder, **training)
    return embedding.nearest_euclid(corpus.corpus_words(corpus.line_tokens(lines)), vectors, target, n)


def answer(vectors: DataFrame, query: str, n: int) -> DataFrame:
    """``(word, similarity)`` for one query such as ``roi + femme - homme``."""
    asked = vectors.sparkSession.createDataFrame([(0, query)], "query_id bigint, expr string")
    return embedding.word_query(asked, vectors, n).orderBy("place").select("word", "similarity")


def export_pages(pages: DataFrame, folder: str, single_file: bool = False) -> None:
    store.export_json(pages, f"{folder}/pages.json", single_file)


def export_vectors(vectors: DataFrame, folder: str, single_file: bool = False) -> None:
    store.export_json(vectors, f"{folder}/vectors.json", single_file)
