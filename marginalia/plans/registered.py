"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Vertex ids differ from run to run, so graph results are given by label.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import links, vectors, wikitext
from marginalia.operators import corpus, embedding, graph, pages, rank
from marginalia.operators.components import connected_components
from marginalia.operators.skew import look_up
from marginalia.plans import inputs, mining
from marginalia.scratch import Scratch
from marginalia.sources import store
from marginalia.sources.dump import scan_dump
from marginalia.sources.lines import scan_lines

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
NEAREST = 20

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _rounded(name: str) -> Column:
    return F.round(name, DIGITS).alias(name)


# --- pages ---------------------------------------------------------------------------------


@query
def dump_scan(spark, sf_dir):
    return scan_dump(spark, inputs.write_dump(spark, sf_dir, Scratch(spark)))


@query
def dump_rejects(spark, sf_dir):
    """The records that an import of a dump with broken ones saves beside its pages, and their number."""
    scratch = Scratch(spark)
    folder = scratch.file("import")
    found, _ = mining.import_dump(spark, inputs.write_broken_dump(spark, sf_dir, scratch), folder)
    return mining.load_rejects(spark, folder).withColumn("pages", pages.page_count(found).scalar())


@query
def articles(spark, sf_dir):
    return inputs.articles(spark, sf_dir, inputs.MIXED)


def _flat_pages(found: DataFrame) -> DataFrame:
    targets = F.array_join(F.transform("edges", lambda e: e["dst"]), "|").alias("targets")
    return found.select("title", "text", targets)


@query
def import_pages(spark, sf_dir):
    path = inputs.write_dump(spark, sf_dir, Scratch(spark))
    return _flat_pages(mining.read_pages(spark, path))


@query
def import_dump(spark, sf_dir):
    scratch = Scratch(spark)
    path = inputs.write_dump(spark, sf_dir, scratch)
    return _session_size(*mining.import_dump(spark, path, scratch.file("import")))


@query
def load_session(spark, sf_dir):
    """What an import has saved, as a later session loads it."""
    scratch = Scratch(spark)
    folder = scratch.file("import")
    mining.import_dump(spark, inputs.write_dump(spark, sf_dir, scratch), folder)
    return _session_size(*mining.load(spark, folder))


def _session_size(found: DataFrame, built: graph.Graph) -> DataFrame:
    counted = pages.page_count(found).scalar()
    return graph.graph_size(built).withColumn("pages", counted)


@query
def pages_round_trip(spark, sf_dir):
    folder = Scratch(spark).file("saved")
    return _flat_pages(store.save_pages(inputs.pages(spark, sf_dir), folder))


@query
def pages_export_json(spark, sf_dir):
    folder = Scratch(spark).file("export")
    mining.export_pages(inputs.pages(spark, sf_dir), folder)
    return _flat_pages(spark.read.schema(store.PAGES_SCHEMA).json(f"{folder}/pages.json"))


@query
def page_count(spark, sf_dir):
    return pages.page_count(inputs.pages(spark, sf_dir, inputs.MIXED))


@query
def find_page(spark, sf_dir):
    found = mining.find_page(inputs.pages(spark, sf_dir), "Doc 10")
    return _flat_pages(found).withColumn("page", F.lit(1))


@query
def find_pages(spark, sf_dir):
    wanted = inputs.table(spark, sf_dir, "labels").select(F.concat(F.lit("Doc "), "doc_id").alias("title"))
    return _flat_pages(pages.find_pages(inputs.pages(spark, sf_dir), wanted))


@query
def page_outlinks(spark, sf_dir):
    outlinks = F.array_join(pages.outlinks(F.col("edges")), "|").alias("outlinks")
    return inputs.pages(spark, sf_dir).select("title", outlinks)


# --- cleaning ------------------------------------------------------------------------------


def _clean_step(step: Callable[[Column], Column], spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.articles(spark, sf_dir).select("title", step(F.col("text")).alias("text"))


for _number, _step in enumerate(wikitext.STEPS):
    QUERIES[f"clean_t{_number}"] = partial(_clean_step, _step)


@query
def clean_pages(spark, sf_dir):
    return _clean_step(wikitext.clean_text, spark, sf_dir)


@query
def clean_pages_compat(spark, sf_dir):
    return _clean_step(partial(wikitext.clean_text, tag_mode="compat"), spark, sf_dir)


# --- links ---------------------------------------------------------------------------------


@query
def link_match(spark, sf_dir):
    bodies = links.link_bodies(F.col("text"))
    return inputs.articles(spark, sf_dir).select("title", F.posexplode(bodies).alias("place", "body"))


@query
def page_links(spark, sf_dir):
    found = links.page_links(F.col("title"), F.col("text"))
    placed = inputs.articles(spark, sf_dir).select(F.posexplode(found).alias("place", "link"))
    return placed.select("place", "link.src", "link.dst")


@query
def link_edges(spark, sf_dir):
    return inputs.links(spark, sf_dir).groupBy("src", "dst").agg(F.count("*").alias("n"))


# --- words ---------------------------------------------------------------------------------


@query
def sentences(spark, sf_dir):
    return inputs.corpus(spark, sf_dir).select(
        F.array_join("tokens", "|").alias("tokens"), F.size("tokens").alias("n_tokens")
    )


@query
def line_scan(spark, sf_dir):
    return scan_lines(spark, inputs.write_lines(spark, sf_dir, Scratch(spark)))


@query
def line_tokens(spark, sf_dir):
    lines = scan_lines(spark, inputs.write_lines(spark, sf_dir, Scratch(spark)))
    return corpus.line_tokens(lines).select(
        F.array_join("tokens", "|").alias("tokens"), F.size("tokens").alias("n_tokens")
    )


@query
def corpus_words(spark, sf_dir):
    lines = scan_lines(spark, inputs.write_lines(spark, sf_dir, Scratch(spark)))
    return corpus.corpus_words(corpus.line_tokens(lines))


@query
def vocabulary_counts(spark, sf_dir):
    return corpus.vocabulary_counts(inputs.corpus(spark, sf_dir))


# --- graphs --------------------------------------------------------------------------------


@query
def graph_vertices(spark, sf_dir):
    return graph.graph_labels(inputs.links(spark, sf_dir)).select("label")


def _edge_labels(found: graph.Graph) -> DataFrame:
    return graph.triplets(found).select("src_label", "dst_label", "weight")


@query
def encode_edges(spark, sf_dir):
    return _edge_labels(inputs.link_graph(spark, sf_dir, Scratch(spark)))


@query
def graph_round_trip(spark, sf_dir):
    scratch = Scratch(spark)
    built = inputs.link_graph(spark, sf_dir, scratch)
    return _edge_labels(store.save_graph(built, scratch.file("saved")))


@query
def graph_size(spark, sf_dir):
    return graph.graph_size(inputs.link_graph(spark, sf_dir, Scratch(spark)))


@query
def triplets(spark, sf_dir):
    return graph.triplets(inputs.property_graph(spark, sf_dir))


@query
def graph_with_default(spark, sf_dir):
    found = graph.with_default_vertices(inputs.property_graph(spark, sf_dir), **inputs.DEFAULT_VERTEX)
    return graph.triplets(found)


@query
def incident_edges(spark, sf_dir):
    whole = graph.with_default_vertices(inputs.property_graph(spark, sf_dir), **inputs.DEFAULT_VERTEX)
    found = graph.incident_triplets(whole, F.col("name") == "Doc 14")
    return found.select(graph.describe_triplet("src_name", "attr", "dst_name").alias("triplet"))


@query
def neighbour_ids(spark, sf_dir):
    built = inputs.link_graph(spark, sf_dir, Scratch(spark))
    pairs = graph.neighbour_ids(built.edges).select(F.col("id").alias("src"), F.col("neighbour").alias("dst"), "n")
    named = graph.triplets(graph.Graph(built.vertices, pairs))
    return named.select(F.col("src_label").alias("label"), F.col("dst_label").alias("neighbour"), "n")


@query
def induced_subgraph(spark, sf_dir):
    """The graph between the pages that exist, without those that are only linked to."""
    built = inputs.link_graph(spark, sf_dir, Scratch(spark))
    existing = built.edges.select(F.col("src").alias("id")).distinct()
    return _edge_labels(graph.induced_subgraph(built, existing))


def _ranked(spark: SparkSession, sf_dir: str) -> tuple[graph.Graph, DataFrame]:
    scratch = Scratch(spark)
    built = inputs.link_graph(spark, sf_dir, scratch)
    return built, rank.page_rank(built.edges, scratch)


@query
def page_rank(spark, sf_dir):
    built, ranks = _ranked(spark, sf_dir)
    return rank.labelled_ranks(ranks, built.vertices).select("label", _rounded("rank"))


@query
def top_rank_vertices(spark, sf_dir):
    built, ranks = _ranked(spark, sf_dir)
    best = rank.top_ranked(rank.labelled_ranks(ranks, built.vertices))
    return best.select("label", _rounded("rank"))


def _top_neighbours(neighbour_order: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    built, ranks = _ranked(spark, sf_dir)
    ranked = rank.labelled_ranks(ranks, built.vertices)
    top = rank.top_ranked(ranked)
    found = rank.top_neighbours(built.edges, ranked, top, neighbour_order=neighbour_order)
    names = top.select("id", F.col("label").alias("top_label"))
    return found.join(names, "id").select(
        "top_label", "place", F.col("label").alias("neighbour"), _rounded("rank")
    )


QUERIES["top_neighbours"] = partial(_top_neighbours, "asc")
QUERIES["top_neighbours_desc"] = partial(_top_neighbours, "desc")


@query
def top_rank_ids(spark, sf_dir):
    built, ranks = _ranked(spark, sf_dir)
    ids = rank.top_rank_ids(built, ranks)
    return built.vertices.join(ids, "id", "left_semi").select("label")


@query
def top_rank_subgraph(spark, sf_dir):
    """Edges of the graph between the best-ranked vertices and their neighbours, by label."""
    built = inputs.link_graph(spark, sf_dir, Scratch(spark))
    best = mining.best_ranked_graph(built)
    edges = best.edges.select(F.col("from").alias("src"), F.col("to").alias("dst"))
    return graph.triplets(graph.Graph(best.vertices, edges)).select(
        F.col("src_label").alias("from_label"), F.col("dst_label").alias("to_label")
    )


@query
def components(spark, sf_dir):
    """The component of each vertex, named by its first label."""
    scratch = Scratch(spark)
    built = inputs.link_graph(spark, sf_dir, scratch)
    found = connected_components(built.edges, scratch).join(built.vertices, "id")
    found = scratch.keep(found, "components")
    first = found.groupBy("component").agg(F.min("label").alias("component_label"))
    return look_up(found, first, "component").select("label", "component_label")


@query
def community_count(spark, sf_dir):
    return mining.count_communities(inputs.link_graph(spark, sf_dir, Scratch(spark)))


# --- vectors -------------------------------------------------------------------------------


def _vector_values(found: DataFrame) -> DataFrame:
    values = found.select("word", F.posexplode("vector").alias("place", "value"))
    return values.select("word", "place", _rounded("value"))


def _with_next(combine: Callable[[Column, Column], Column], spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding and the next one."""
    both = inputs.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("a")
    )
    following = both.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    word = F.concat(F.lit("w"), "vec_id").alias("word")
    return both.join(following, "vec_id").select(word, combine(F.col("a"), F.col("b")).alias("vector"))


@query
def vector_add(spark, sf_dir):
    return _vector_values(_with_next(vectors.add, spark, sf_dir))


@query
def vector_sub(spark, sf_dir):
    return _vector_values(_with_next(vectors.subtract, spark, sf_dir))


@query
def vector_opposite(spark, sf_dir):
    found = inputs.vectors(spark, sf_dir)
    return _vector_values(found.select("word", vectors.opposite(F.col("vector")).alias("vector")))


@query
def vector_distance(spark, sf_dir):
    return _with_next(vectors.distance, spark, sf_dir).select("word", F.round("vector", DIGITS).alias("distance"))


@query
def vectors_export_json(spark, sf_dir):
    folder = Scratch(spark).file("export")
    mining.export_vectors(inputs.vectors(spark, sf_dir), folder)
    read = spark.read.schema("word string, vector array<double>").json(f"{folder}/vectors.json")
    return _vector_values(read)


@query
def synonyms(spark, sf_dir):
    known = inputs.word_vectors(spark, sf_dir, Scratch(spark))
    found = embedding.synonyms(known, embedding.word_vector(known, "Doc"), NEAREST)
    return found.select("word", _rounded("similarity"))


@query
def sum_words(spark, sf_dir):
    known = inputs.word_vectors(spark, sf_dir, Scratch(spark))
    return embedding.sum_words(known, "Doc", "Ok", NEAREST, minus=True).select("word", _rounded("similarity"))


@query
def word_query(spark, sf_dir):
    known = inputs.word_vectors(spark, sf_dir, Scratch(spark))
    found = embedding.word_query(inputs.word_queries(spark, sf_dir), known, NEAREST)
    return found.select("query_id", "place", "word", _rounded("similarity"))


@query
def nearest_euclid(spark, sf_dir):
    scratch = Scratch(spark)
    tokens = scratch.keep(inputs.corpus(spark, sf_dir), "corpus")  # read for the vectors and for the words
    known = inputs.vectors_of_words(spark, sf_dir, corpus.vocabulary_counts(tokens), scratch)
    found = embedding.nearest_euclid(corpus.corpus_words(tokens), known, "doc")
    return found.select("word", _rounded("distance"))


@query
def document_vectors(spark, sf_dir):
    known = inputs.word_vectors(spark, sf_dir, Scratch(spark))
    found = embedding.document_vectors(inputs.document_tokens(spark, sf_dir), known)
    values = found.select("doc_id", F.posexplode("vector").alias("place", "value"))
    return values.select("doc_id", "place", _rounded("value"))


def _tasks(spark: SparkSession) -> int:
    """As many parts of the corpus are trained on as the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def vocabulary(spark, sf_dir):
    return embedding.vocabulary(embedding.train_word_vectors(inputs.corpus(spark, sf_dir), 16, 3, 1))


@query
def word2vec_vocab(spark, sf_dir):
    scratch = Scratch(spark)
    saved = store.save_pages(inputs.pages(spark, sf_dir), scratch.file("saved"))
    known = mining.embed(saved, 50, 3, 2, folder=scratch.file("vectors"), partitions=_tasks(spark))
    return known.select("word", F.size("vector").alias("dimension"))


@query
def word2vec_lines(spark, sf_dir):
    lines = scan_lines(spark, inputs.write_lines(spark, sf_dir, Scratch(spark)))
    return mining.embed_lines(lines).select("word", F.size("vector").alias("dimension"))


@query
def lines_nearest(spark, sf_dir):
    """The example of the line file: train, then look for the words nearest to one.

    The words differ from run to run. So what is compared is that each place holds a word of the
    file, that distances rise from the target's own, and that they are those of the saved vectors.
    """
    scratch = Scratch(spark)
    lines = scan_lines(spark, inputs.write_lines(spark, sf_dir, scratch), tasks=64)
    folder = scratch.file("vectors")
    found = scratch.keep(mining.nearest_in_lines(lines, "the", folder, seed=7), "nearest")
    known = store.load_vectors(spark, folder)
    aim = known.filter("word = 'the'").select("vector").scalar()
    words = corpus.corpus_words(corpus.line_tokens(lines)).select("word", F.lit(True).alias("known"))
    placed = found.join(known, "word", "left").join(words, "word", "left").withColumn("aim", aim)
    own = F.coalesce("vector", F.array_repeat(F.lit(0.0), F.size("aim")))
    again = F.sqrt(F.aggregate(F.zip_with(own, "aim", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    order = Window.orderBy("distance", "word")  # over a report of a few words
    return placed.select(
        F.row_number().over(order).alias("place"),
        F.coalesce("known", F.lit(False)).alias("known"),
        (F.col("distance") >= F.coalesce(F.lag("distance").over(order), F.lit(0.0))).alias("rises"),
        (F.abs(F.col("distance") - again) < 1e-9).alias("recomputed"),
        (F.col("word") == "the").alias("target"),
    )
