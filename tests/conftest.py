import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from marginalia.scratch import Scratch

    return Scratch(spark)


@pytest.fixture(scope="session")
def links(spark):
    edges = ["AB", "AC", "BC", "CA", "DC", "EF", "AB"]
    return spark.createDataFrame([tuple(e) for e in edges], "src string, dst string")


@pytest.fixture(scope="session")
def graph(spark, links):
    from marginalia.operators.graph import build_graph
    from marginalia.scratch import Scratch
    from marginalia.sources.store import save_graph

    scratch = Scratch(spark)
    return save_graph(build_graph(links, scratch), scratch.file("graph"))


@pytest.fixture(scope="session")
def ranks(spark, graph):
    from marginalia.operators.rank import page_rank
    from marginalia.scratch import Scratch

    return page_rank(graph.edges, Scratch(spark), tol=1e-7)


@pytest.fixture
def plain(spark):
    """Switches broadcast joins off, so that joins shuffle as they do on large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
