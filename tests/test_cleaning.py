import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan
from marginalia.functions import links, wikitext

# raw, default, and compat where it differs
GOLDEN = [
    ("'''Lyon''' est une ville de [[France]].", "Lyon est une ville de France."),
    ("a [[Rhône (fleuve)|le Rhône]] b", "a le Rhône b"),
    ("x [[Paris#Histoire|Paris]] y", "x Paris y"),
    ("[[Catégorie:Ville]] z", " z"),
    ("q [[Fichier:x.jpg|thumb|légende]] r", "q thumb légende r"),
    ("né le {{Date|14|juillet|1789}} à Lyon", "né le 14 juillet 1789 à Lyon"),
    ("a {{x {{y}} z}} b", "a b"),
    ("== Histoire ==\ntexte", " texte"),
    ("==Histoire==\ntexte", "==Histoire== texte"),
    ("x | a = 1 | b = 2 fin", "x a 2 fin"),
    ("l1\n* un\n* deux\n** trois", "l1 un deux ** trois"),
    ("Fin.<ref>note</ref> Suite", "Fin. Suite", "FinSuite"),
    ('Fin.<ref name="a">note</ref> Suite', "Fin.note Suite", "Finnot Suite"),
    ("ab<br/><br/>c", "abc", "c"),
    ("<b>x</b> y", " y", "<b>x</b> y"),
    ("fin <b>x</b>", "fin ", "fin <b>x</b>"),
    ("a <b", "a <b"),
    ("[[a|b|c]]", "b c"),
    ("l’eau, (douce); fin. . Ok", "l'eau douce fin. Ok"),
    ("a &lt;ref&gt;n&lt;/ref&gt; b", "a b"),
    ("[[Lyon]] foo ([move]) bar", "Lyon bar"),
    ("'''''gras'''''", "gras"),
    ('x<ref name="q"/> y<ref>z</ref> w', "x y w", " w"),
    ("l1<ref>a\nb</ref>l2", "l1l2", "l2"),
    ("a<!-- c -->b", "ab", "b"),
]


def cleaned(spark, texts, **mode):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = rows.select("i", wikitext.clean_text(F.col("text"), **mode).alias("text"))
    return [r.text for r in found.orderBy("i").collect()]


@pytest.mark.parametrize("mode, column", [("default", 1), ("compat", -1)])
def test_golden_rows(spark, mode, column):
    assert cleaned(spark, [g[0] for g in GOLDEN], tag_mode=mode) == [g[column] for g in GOLDEN]


def test_null_stays_null(spark):
    assert cleaned(spark, [None, "a"]) == [None, "a"]
    assert cleaned(spark, [None, "a"], tag_mode="compat") == [None, "a"]


def test_unknown_mode():
    with pytest.raises(ValueError):
        wikitext.clean_text(F, tag_mode="other")


def test_steps_match_their_plain_patterns(spark):
    """Steps that are written otherwise for speed do what their pattern says."""
    texts = [
        "[[a]] x ([b]) [[c]] ([d])\n[[e]] f\n([g])",
        "[[a [[b]] c]] ([d] e) ([f])",
        "([x]) [[a]]",
        "\n* \n* a\n * b\r\n* c",
        ". . . . .. ..  .",
        "a,b;c:d(e|f)g",
        "’’a’",
        "{{{a}}} {{b {c} d}} {{{{e}} {{f}}}} {{{g}}{h}}",
        "{{" * 13 + "deep" + "}}" * 13,
    ]
    plain = {
        1: (r"(\[\[.*?\]\]).*?\(\[.*?\]\)", "$1"),
        4: (r"\n\* ", "\n"),
        5: (r"\n", " "),
        13: (r"[,;:(|)]", " "),
        15: (r"\. \.", "."),
        16: (r"\’", "'"),
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for number, (pattern, replacement) in plain.items():
        step = wikitext.STEPS[number](F.col("t"))
        assert rows.filter(step != F.regexp_replace("t", pattern, replacement)).isEmpty(), number
    rounds = F.col("t")
    for _ in range(11):
        rounds = F.regexp_replace(rounds, r"\{\{[^{}]*\}\}", "")
    assert rows.filter(wikitext.STEPS[7](F.col("t")) != rounds).isEmpty()


TAG_PIECES = ["<a>", "</a>", "<b.c>", "</b.c>", "<a", "</", "<", ">", "/a", "x", "y ", "\n", "<r n='1'>", "\\E", "😀"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TAG_PIECES), max_size=12).map("".join), min_size=60, max_size=60))
def test_tags_by_their_plain_pattern(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select(
        "t",
        wikitext.strip_tags(F.col("t")).alias("got"),
        F.regexp_replace("t", r"(?s)<([^>]*)>(?:.*?</\1>)?", "").alias("want"),
    ).filter("got <> want")
    assert found.take(1) == []


def tag_loop(text):
    """The tag loop step by step on the whole text, over UTF-16 units."""
    units = text.encode("utf-16-le")
    t = [units[i : i + 2] for i in range(0, len(units), 2)]
    mark = {c: c.encode("utf-16-le") for c in "<>/"}

    def find(needle, start):
        for i in range(start, len(t) - len(needle) + 1):
            if t[i : i + len(needle)] == needle:
                return i
        return -1

    while (a := find([mark["<"]], 0)) >= 0:
        b = find([mark[">"]], a + 1)
        if b < 0:
            break
        label = [mark["/"], *t[a + 1 : b]]
        c = find(label, b)
        rest = b + 1 if c < 0 else c + len(label) + 2
        if a == 0 or rest > len(t):
            break
        t = t[: a - 1] + t[rest:]
    joined = b"".join(t).decode("utf-16-le", "surrogatepass")
    return "".join("?" if 0xD800 <= ord(c) < 0xE000 else c for c in joined)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(TAG_PIECES), max_size=14).map("".join))
def test_compat_tags_by_the_plain_loop(text):
    assert wikitext._strip_tags_one_page(text) == tag_loop(text)


def test_no_link_brackets_are_left(spark):
    texts = ["[[a]] [[b|c]] [[d:e]] [[f (g)|h]]", "{{x|[[y]]}} [[z]]"]
    assert all("[[" not in t and "]]" not in t for t in cleaned(spark, texts))


def test_many_unpaired_tags_stay_cheap(spark):
    page = spark.range(1).select(F.expr("repeat('mot <br> suite <b>x</b> ', 50000)").alias("t"))
    assert page.select(F.length(wikitext.strip_tags(F.col("t")))).first()[0] == 50000 * 12


def test_default_mode_stays_in_the_jvm(spark):
    rows = spark.createDataFrame([("a",)], "t string")
    assert "Python" not in plan(rows.select(wikitext.clean_text(F.col("t"))))


PLAIN = {
    1: (wikitext.MOVE_INFO, "$1"), 2: (wikitext.HEADER, ""), 6: (wikitext.DATE, "$1"), 8: (wikitext.ESCAPED_REF, ""),
    9: (wikitext.LINK_PARENTHESIS, "$1$2"), 10: (wikitext.LINK_LABEL, "[[$1]]"), 11: (wikitext.NAMESPACED_LINK, ""), 12: (wikitext.LINK, "$1"),
}


def test_linear_patterns_match_their_plain_ones(spark):
    random.seed(4)
    marks = ["[[", "]]", "[", "]", "(", ")", "([", "])", "|", ":", "=", "==", " ", " ", "a", "b", "{{Date", "}}", "&lt;ref&gt;", "&lt;/ref&gt;"]
    texts = ["".join(random.choice(marks + ["\n", "\r"] * (i % 2)) for _ in range(random.randint(1, 40))) for i in range(6000)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for step, (pattern, new) in PLAIN.items():
        text = F.col("text")
        both = rows.select("text", wikitext.STEPS[step](text).alias("got"), F.regexp_replace(text, pattern, new).alias("want"))
        assert both.filter("got <> want").collect() == [], step
    found = rows.select("text", links.link_bodies(F.col("text")).alias("got"), F.regexp_extract_all("text", F.lit(links.LINK), 1).alias("want"))
    assert found.filter("got <> want").collect() == []


LINE_ENDS = ["\n", "\r", "\u0085", "\u2028", "\u2029", "\r\n"]


def test_links_over_lines_match_their_plain_patterns(spark):
    random.seed(6)
    marks = ["[[", "[[", "]]", "[", "]", "(", ")", "|", "|", " ", "a"]
    texts = ["".join(random.choice(marks + LINE_ENDS * (i % 2)) for _ in range(random.randint(1, 30))) for i in range(20_000)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for step in (9, 10):
        pattern, new = PLAIN[step]
        text = F.col("text")
        both = rows.select("text", wikitext.STEPS[step](text).alias("got"), F.regexp_replace(text, pattern, new).alias("want"))
        assert both.filter("got <> want").collect() == [], step
        assert both.filter("got <> text").count() > 500, step


@pytest.mark.parametrize("end", LINE_ENDS)
def test_link_steps_are_linear_over_lines(spark, end):
    """100 KB of each mark, alone, with an end of line at the end and behind each mark."""
    pieces = ["[[a (b) ", "[[a|b ", "[[a (b)] ", "[[a|b] ", "[[", "[[(", "[[|", "(a)", "[[a (b "]
    texts = [text for p in pieces for text in (p * (100_000 // len(p)) + end, (p + end) * (100_000 // len(p + end)))]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1).cache()
    for step in (wikitext.drop_link_parenthesis, wikitext.keep_link_label):
        start = time.perf_counter()
        rows.select(step(F.col("text")).alias("t")).write.format("noop").mode("overwrite").save()
        assert time.perf_counter() - start < 3  # for 18 pages


def test_many_labels_are_one_walk(spark):
    """20,000 labels that are closed, in and out of order, and as many that are closed before."""
    n = 20_000
    opened, closed = "".join(f"<t{i}>x" for i in range(n)), "".join(f"</t{i}>y" for i in range(n))
    pages = [("".join(f"<t{i}>x</t{i}>y" for i in range(n)), "y" * n), (opened + closed, "y" * n), (closed + opened, "y" * n + "x" * n), ("<x>" + "</a" * 33_000 + ">", "")]
    for page, want in pages:
        rows = spark.createDataFrame([(page,)], "t string").select(wikitext.strip_tags(F.col("t")))
        rows.first()  # the plan is made and compiled
        start = time.perf_counter()
        found = rows.first()[0]
        took = time.perf_counter() - start
        assert found == want
        assert took < 4


JUNK = ["=", "a=", "[[a|b ", "[[a (b) ", "[[a ", "[[a:b ", "{{Date|", "&lt;ref&gt;", "[[a ([b ", "[[a]] ([b ", "== a", "[[(", "[[|", "<b>", "<a", "</a"]


@pytest.mark.parametrize("piece", JUNK)
def test_junk_pages_are_cleaned_in_time(spark, piece):
    """100 KB of one unclosed mark: each step on its own, and the whole chain."""
    head = "</b><b>x</b>" if piece == "<b>" else ""
    rows = spark.createDataFrame([(head + piece * (100_000 // len(piece)),)], "text string")
    steps = [step(F.col("text")).alias(f"t{i}") for i, step in enumerate(wikitext.STEPS)]
    start = time.perf_counter()
    rows.select(*steps, wikitext.clean_text(F.col("text")), links.link_bodies(F.col("text"))).collect()
    assert time.perf_counter() - start < 8
