import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lexspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CORPUS = """[[Alpha Dog]]
==Intro==
Running dogs, running cats!
The state-of-the-art dog

[[Beta]]
cats see [[File|the cat]] sleeping
[[Gamma]]
nothing relevant here
[[Delta]]
birds fly
[[Epsilon]]
birds sing
[[Zeta]]
"""


@pytest.fixture(scope="session")
def corpus_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    (folder / "wiki.txt").write_text(CORPUS)
    return str(folder)


@pytest.fixture(scope="session")
def corpus_index(spark, corpus_path, tmp_path_factory):
    from lexspark import build_index, read_wiki, wiki_chunks

    path = str(tmp_path_factory.mktemp("index"))
    return build_index(wiki_chunks(read_wiki(spark, corpus_path)), path, stem=True, count_titles=True)
