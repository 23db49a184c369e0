"""Every registered query against its SQL oracle on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
import bench
from oracle import assert_matches

SF_DIR = "/root/testdata/sf0.001"
ORACLES = __spark_entry__.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_every_query_has_an_oracle():
    assert set(__spark_entry__.core_queries()) <= set(ORACLES)
    assert set(__spark_entry__.core_queries()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("left_over", ["nothing", "pipeline", "cache folder"])
def test_entry_without_the_optional_parts(tmp_path, left_over):
    """In a copy without the optional package every core query is still there."""
    here = Path(__spark_entry__.__file__).parent
    gone = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(here / "dockmetrics", tmp_path / "dockmetrics", ignore=gone)
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    if left_over == "pipeline":
        shutil.copy(here / "corpus_pipeline.py", tmp_path)
    elif left_over == "cache folder":
        (tmp_path / "dockmetrics" / "llm" / "__pycache__").mkdir(parents=True)
    show = "import __spark_entry__ as e; print(*e.queries()); assert set(e.queries()) <= set(e.oracle_sql())"
    found = subprocess.run(
        [sys.executable, "-c", show], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert set(found.stdout.split()) == set(__spark_entry__.core_queries())


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.count() > 0
    assert result.schema == __spark_entry__.entry(spark).schema


@pytest.mark.parametrize("name", __spark_entry__.core_queries())
def test_query_matches_oracle(spark, name):
    result = __spark_entry__.queries()[name](spark, SF_DIR)
    assert assert_matches(result, ORACLES[name], SF_DIR) > 0


def test_one_pass_daily_figures_equal_three_passes(spark):
    three = bench.daily_three_pass(spark, SF_DIR)
    one = __spark_entry__.daily_station_stats(spark, SF_DIR).select(*three.columns)
    assert three.count() > 0
    assert three.exceptAll(one).count() == one.exceptAll(three).count() == 0
