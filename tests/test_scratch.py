from pathlib import Path
from types import SimpleNamespace

import pytest

from sigil.operators import graph
from sigil.sources import scratch


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=SimpleNamespace(master=master))


def test_scratch_folders():
    assert scratch.scratch_path(session("spark://m:7077", "file:///shared/"), "x").startswith("file:///shared/sigil-x-")
    assert scratch.scratch_path(session("local[4]"), "x").startswith(scratch.DEFAULT_SCRATCH)
    for master in ("spark://m:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.scratch_path(session(master), "x")


def test_written_tables_can_be_discarded(spark):
    table = scratch.written(spark.range(10).withColumnRenamed("id", "n"), "numbers")
    path = Path(table.scratch.removeprefix("file:"))
    assert table.count() == 10 and path.exists()
    scratch.discard(table)
    scratch.discard(table)
    assert not path.exists()


@pytest.mark.parametrize("share", [2, 1000])
def test_hot_joins(spark, share):
    """Every row finds its partner, whether its key is dealt by a salt or not; null keys find none."""
    left = spark.range(5000).selectExpr("CASE WHEN id % 2 = 0 THEN 0 WHEN id % 11 = 0 THEN NULL ELSE id END AS k", "id AS v")
    right = spark.range(5000).selectExpr("id AS k", "id * 2 AS w")
    found = graph.hot_join(left, right, "k", "v", salts=4, share=share)
    want = {i: 0 if i % 2 == 0 else 2 * i for i in range(5000) if i % 2 == 0 or i % 11}
    assert {r.v: r.w for r in found.collect()} == want


def test_a_star_of_many_leaves(spark):
    edges = spark.range(1, 4000).selectExpr("id AS i", "CASE WHEN id % 3 = 0 THEN id - 1 ELSE 5000L END AS j")
    found = {r.node: r.comp for r in graph.components(edges).collect()}
    assert set(found.values()) == {1} and len(found) == 4000
