from pyspark.sql import functions as F

from conftest import plan
from marginalia.functions import wikitext
from marginalia.functions.links import page_links
from marginalia.functions.tokens import line_words
from marginalia.operators import corpus, pages

EDGE_CASES = {
    "[[a]]": ["a"],
    "[[a|b]]": ["a"],
    "[[a#b|c]]": ["a"],
    "[[a|b#c]]": ["a"],
    "[[#s]]": [""],
    "[[#]]": [],
    "[[##]]": [],
    "[[|]]": [],
    "[[||]]": [],
    "[[|x]]": [""],
    "[[||x]]": [""],
    "[[|#x]]": [],
    "[[|||#x]]": [],
    "[[#|]]": [""],
    "[[a:b]]": [],
    "[[a|b:c]]": [],
    "[[a\nb]] [[c]]": ["c"],
    "[[]]": [],
    "[[]]]]": ["]"],
    "[[]] t [[Lyon]]": ["]] t [[Lyon"],
    "[[Fichier:x.jpg|thumb|leg [[Lyon]] fin]]": [],
    "[[a [[b]] c]]": ["a [[b"],
    "[[ a ]]": [" a "],
    "[[a||b]]": ["a"],
    "[[a|]]": ["a"],
    "[[a#]]": ["a"],
    "no": [],
    "[[A]] [[A]] [[a]]": ["A", "A", "a"],
    "[[a]b]]": ["a]b"],
}


def targets(spark, rows, **options):
    found = spark.createDataFrame(rows, "title string, text string").select(
        page_links(F.col("title"), F.col("text"), **options).alias("edges")
    )
    return [[(e.src, e.dst) for e in r.edges] for r in found.collect()]


def test_link_edge_cases(spark):
    found = targets(spark, [("T", text) for text in EDGE_CASES])
    assert found == [[("T", dst) for dst in want] for want in EDGE_CASES.values()]


def test_link_nulls_and_empty_targets(spark):
    assert targets(spark, [(None, "[[a]]"), ("T", None)]) == [[], []]
    assert targets(spark, [("T", "[[#s]] [[a]]")], drop_empty=True) == [[("T", "a")]]


def test_edges_and_lookup(spark):
    edges = "array<struct<src:string,dst:string>>"
    table = spark.createDataFrame(
        [("b", "t", [("b", "z"), ("b", "a"), ("b", "z")]), ("a", "t", [("a", "q")]), ('c"', "t", [])],
        f"title string, text string, edges {edges}",
    )
    assert pages.link_edges(table).count() == 4
    assert pages.find_page(table, 'c"').count() == 1
    assert pages.find_page(table, "none").count() == 0
    assert table.select(pages.outlinks(F.col("edges")).alias("o")).first().o == ["a", "z"]


def test_sentences(spark):
    text = spark.createDataFrame([("L'eau  douce.. Fin. ",), ("a\tb\t.\r\n c\t",)], "text string")
    found = [r.tokens for r in corpus.sentences(text).collect()]
    assert found == [["l", "eau", "douce"], ["fin"], [], ["a\tb"], ["c"]]


def test_line_words(spark):
    lines = spark.createDataFrame([("a b  ",), (" a  b",), ("  ",), ("",), ("A",)], "value string")
    assert [r.tokens for r in corpus.line_tokens(lines).collect()] == [
        ["a", "b"], ["", "a", "", "b"], [], ["A"],
    ]
    assert lines.select(line_words(F.col("value")).alias("w")).first().w == ["a", "b"]


def test_vocabulary(spark):
    tokens = spark.createDataFrame([(["a"] * 5 + ["b"] * 4,)], "tokens array<string>")
    assert [tuple(r) for r in corpus.vocabulary_counts(tokens).collect()] == [("a", 5)]
    assert {r.word for r in corpus.corpus_words(tokens).collect()} == {"a", "b"}


def test_words_split_each_sentence_once(spark):
    """Counting words looks at no sentence twice, and drops only rows without tokens."""
    pages = spark.createDataFrame([("Ab c'D. .\t. ΟΔΟΣ'ΣΑΣ Σ. İé",), (None,), ("",)], "text string")
    found = corpus.words(corpus.sentences(pages))
    assert sorted(r.word for r in found.collect()) == sorted(["ab", "c", "d", "οδος", "σας", "σ", "i\u0307é"])
    assert "size(" not in plan(found)
    odd = spark.createDataFrame([(["a", None],), ([],), (None,)], "tokens array<string>")
    assert sorted((r.word for r in corpus.words(odd).collect()), key=str) == [None, "a"]


def test_patterns_are_tried_only_at_their_mark():
    steps = (wikitext.drop_headers, wikitext.drop_link_parenthesis, wikitext.keep_link_label, wikitext.drop_namespaced_links, wikitext.unwrap_links)
    assert all("(?=" in str(step(F.col("t"))) for step in steps)
