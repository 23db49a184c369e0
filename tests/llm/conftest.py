import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parent))

from llm_data import EDGE_ROWS

from dockmetrics.llm.common import ship_package

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    def docs(rows, partitions=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)

    return docs


@pytest.fixture(scope="session")
def edge_docs(docs_of):
    return docs_of(EDGE_ROWS)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
