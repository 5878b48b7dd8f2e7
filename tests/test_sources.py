import bz2
import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan
from marginalia.operators import pages as page_ops
from marginalia.plans import mining
from marginalia.scratch import Scratch, shared_folder
from marginalia.sources import dump, lines, store

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="fr">
  <siteinfo><sitename>Test</sitename></siteinfo>
  <page><title>Lyon</title><ns>0</ns><id>1</id><revision><id>11</id><text xml:space="preserve">'''Lyon''' est une ville de [[France]]. Voir [[Rhône (fleuve)|le Rhône]] et [[Paris#Histoire|Paris]].&lt;ref&gt;note&lt;/ref&gt; Fin.
* [[Catégorie:Ville]]
[[#Histoire]] [[|vide]]</text></revision></page>
  <page><title>Discussion:Lyon</title><ns>1</ns><id>2</id><revision><id>12</id><text xml:space="preserve">talk [[Lyon]]</text></revision></page>
  <page><title>Vide</title><ns>0</ns><id>3</id><revision><id>13</id><text xml:space="preserve"/></revision></page>
  <page><title>SansTexte</title><ns>0</ns><id>4</id><revision><id>14</id></revision></page>
</mediawiki>
"""


@pytest.fixture(scope="module")
def dump_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "dump.xml"
    path.write_text(DUMP)
    return str(path)


def test_scan(spark, dump_file):
    found = dump.scan_dump(spark, dump_file)
    assert {(r.title, r.ns, r.text is None) for r in found.collect()} == {
        ("Lyon", 0, False), ("Discussion:Lyon", 1, False), ("Vide", 0, True), ("SansTexte", 0, True),
    }
    other = dump.scan_dump_files(spark, dump_file)
    assert found.exceptAll(other).isEmpty() and other.exceptAll(found).isEmpty()


BROKEN = """<mediawiki>
<page><title>A</title><ns>0</ns><revision><text xml:space="preserve">a &lt;ref&gt; x</text></revision></page>
<page><title>B</title><ns>zero</ns><revision><text>b</text></revision></page>
<page><title>C</title><ns>0</ns><revision><text>c</revision></page>
<page><title>D</title><ns>0</ns><revision><text>d</text>
<page><title>E</title><ns>0</ns><revision><text>e [[A]]</text></revision></page>
<page><title>F &bad;</title><ns>0</ns><revision><text/></revision></page>
<page><title>G</title><ns>1</ns></page>
<page><title>H</title><ns>0</ns><revision><text>cut off"""


def test_broken_records_are_told_from_pages(spark, tmp_path):
    path = tmp_path / "broken.xml"
    path.write_text(BROKEN)
    records = dump.scan_dump_records(spark, str(path))
    assert sorted((r.title, r.text) for r in dump.pages_of(records).collect()) == [("A", "a <ref> x"), ("E", "e [[A]]"), ("G", None)]
    rejects = sorted(r.record for r in dump.rejects_of(records).collect())
    assert [r[13:14] for r in rejects] == ["B", "C", "D", "F", "H"]
    assert rejects[2] == "<page><title>D</title><ns>0</ns><revision><text>d</text>"
    assert plan(records).count("from_xml") == 1
    folder = str(tmp_path / "saved")
    pages, _ = mining.import_dump(spark, str(path), folder)
    assert sorted(r.title for r in pages.collect()) == ["A", "E"]
    assert sorted(r.record for r in mining.load_rejects(spark, folder).collect()) == rejects


def test_a_whole_dump_has_no_rejects(spark, dump_file, tmp_path):
    assert dump.rejects_of(dump.scan_dump_records(spark, dump_file)).isEmpty()
    mining.import_dump(spark, dump_file, str(tmp_path / "saved"))
    assert mining.load_rejects(spark, str(tmp_path / "saved")).isEmpty()


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    body = "".join(
        f"<page><title>T{i}</title><ns>0</ns><revision><text>{'mot ' * 50}[[T{i + 1}]]\n</text></revision></page>\n"
        for i in range(20_000)
    )
    path = tmp_path / "large.xml"
    path.write_text(f"<mediawiki>{body}</mediawiki>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        found = dump.scan_dump(spark, str(path))
        used = found.select(F.spark_partition_id().alias("p"), "title").distinct()
        assert used.count() == 20_000
        assert found.select(F.spark_partition_id()).distinct().count() > 5
        assert found.filter("text not like '%mot [[T%]]\n'").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compressed_dump(spark, tmp_path):
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(bz2.compress(DUMP.encode()))
    found = dump.scan_dump(spark, str(path))
    assert sorted(r.title for r in found.collect()) == ["Discussion:Lyon", "Lyon", "SansTexte", "Vide"]


def test_import_and_load(spark, dump_file, tmp_path):
    folder = str(tmp_path / "saved")
    mining.import_dump(spark, dump_file, folder)
    pages, graph = mining.load(spark, folder)
    assert page_ops.page_count(pages).first().pages == 1
    page = mining.find_page(pages, "Lyon").first()
    assert [x.dst for x in page.edges] == ["France", "Rhône (fleuve)", "Paris", "", ""]
    assert page.outlinks == ["", "France", "Paris", "Rhône (fleuve)"]
    assert page.text.startswith("Lyon est une ville de France. Voir le Rhône et Paris. Fin.")
    assert graph.edges.count() == 5 and graph.vertices.count() == 5
    assert mining.count_communities(graph).first().communities == 1
    assert mining.load(spark, folder)[1].edges.count() == 5


def test_exports(spark, dump_file, tmp_path):
    folder = str(tmp_path)
    pages = mining.read_pages(spark, dump_file)
    mining.export_pages(pages, folder, single_file=True)
    assert len([f for f in os.listdir(tmp_path / "pages.json") if f.startswith("part")]) == 1
    again = spark.read.schema(store.PAGES_SCHEMA).json(f"{folder}/pages.json")
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in pages.collect()]


def test_lookup_reaches_the_scan(spark, dump_file, tmp_path):
    pages = store.save_pages(mining.read_pages(spark, dump_file), str(tmp_path))
    text = plan(page_ops.find_page(pages, "Lyon"))
    assert "EqualTo(title,Lyon)" in text
    count = plan(page_ops.link_edges(pages).select("dst"))
    assert "text" not in count.split("ReadSchema")[1]


def test_records_are_parsed_once(spark, dump_file):
    raw = page_ops.articles(dump.scan_dump(spark, dump_file))
    assert plan(page_ops.with_links_and_clean_text(raw)).count("from_xml") == 1


def test_counting_pages_cleans_nothing(spark, dump_file):
    assert "regexp" not in plan(page_ops.page_count(mining.read_pages(spark, dump_file)))


class Session:
    """Stands in for sessions of other masters and settings."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder


def test_scratch_folder():
    assert Scratch(Session("yarn", "hdfs://host/shared/")).path.startswith("hdfs://host/shared/")
    with pytest.raises(ValueError):
        shared_folder(Session("yarn"))
    with pytest.raises(ValueError):
        shared_folder(Session("local[2]"))


def test_line_files_are_split_by_bytes(spark, tmp_path):
    """64 tasks on one plain file without a shuffle; a compressed one is dealt out."""
    want = [f"line {i}" for i in range(20_000)]
    (tmp_path / "lines.txt").write_text("\n".join(want) + "\n")
    (tmp_path / "lines.txt.bz2").write_bytes(bz2.compress("\n".join(want[:50]).encode()))
    (tmp_path / "lines.txt.gz").write_bytes(gzip.compress("\n".join(want).encode()))
    found = lines.scan_lines(spark, str(tmp_path / "lines.txt"), tasks=64)
    assert "Exchange" not in plan(found) and 60 <= found.rdd.getNumPartitions() <= 66
    assert sorted(r.value for r in found.collect()) == sorted(want)
    assert found.join(spark.createDataFrame([("line 7",)], "value string"), "value").count() == 1
    assert found.select(F.spark_partition_id()).distinct().count() > 55
    packed = lines.scan_lines(spark, str(tmp_path / "lines.txt.gz"), tasks=64)
    assert "Exchange" in plan(packed) and packed.count() == 20_000
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("lines_")]


def test_a_single_file_is_only_copied_by_one_task(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 1000, 1, 8).select("id", F.concat(F.lit("é\u2028\n"), "id").alias("text"), F.spark_partition_id().alias("task"))
    store.export_json(rows, str(tmp_path / "one.json"), single_file=True)
    files = [f for f in os.listdir(tmp_path / "one.json") if f.startswith("part-")]
    assert len(files) == 1
    back = spark.read.schema("id long, text string, task int").json(str(tmp_path / "one.json"))
    assert back.exceptAll(rows).isEmpty() and back.count() == 1000
    assert back.select("task").distinct().count() == 8  # the rows were worked out by eight tasks


@pytest.mark.parametrize("scheme", ["file://", "viewfs://pages"])
def test_paths_are_uris(spark, dump_file, tmp_path, scheme):
    """Reading, saving, loading and exporting go by Hadoop URIs of any scheme."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.pages.link./tmp", f"file://{tmp_path}")
    hadoop.set("fs.viewfs.mounttable.pages.link./dump", f"file://{os.path.dirname(dump_file)}")
    here, there = (f"file://{os.path.dirname(dump_file)}", f"file://{tmp_path}") if scheme == "file://" else (f"{scheme}/dump", f"{scheme}/tmp")
    pages, _ = mining.import_dump(spark, f"{here}/dump.xml", f"{there}/saved")
    assert [r.title for r in pages.collect()] == ["Lyon"]
    loaded, graph = mining.load(spark, f"{there}/saved")
    mining.export_pages(loaded, f"{there}/export", single_file=True)
    assert spark.read.schema(store.PAGES_SCHEMA).json(f"{there}/export/pages.json").count() == 1
    assert graph.edges.count() == 5 and lines.scan_lines(spark, f"{here}/dump.xml", tasks=3).count() > 5


def test_many_titles_are_looked_up_without_shuffling_pages(plain, tmp_path):
    pages = plain.range(500).selectExpr("concat('Doc ', id) AS title", "repeat('mot ', 20) AS text", "array(struct(concat('Doc ', id) AS src, 'Lyon' AS dst)) AS edges")
    titles = plain.range(0, 800, 7).selectExpr("concat('Doc ', id) AS title").union(plain.createDataFrame([(None,), ("Doc 7",)], "title string"))
    saved = store.save_pages_by_title(pages, str(tmp_path), 8)
    for table in (saved, store.load_pages_by_title(plain, str(tmp_path))):
        found = page_ops.find_pages(table, titles)
        assert {r.title for r in found.collect()} == {f"Doc {i}" for i in range(0, 500, 7)} and found.count() == 72
        text = plan(page_ops.find_pages(table, titles))
        join = text.index("SortMergeJoin")
        assert "Exchange" not in text[join : text.index("FileScan", join)] and text.count("Exchange") == 1
    again = store.save_pages_by_title(pages.limit(10), str(tmp_path), 16)
    assert again.count() == 10 == store.load_pages_by_title(plain, str(tmp_path)).count()
