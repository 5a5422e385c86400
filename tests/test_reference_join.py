"""Texts of reference blocks stream past the sites: they are neither sorted nor broadcast, however small Spark takes them for."""

from genoeval.operators import sites as site_ops


def test_blocks_stream(spark):
    bases = spark.createDataFrame([("Chr01", 0, "ACGT" * 250), ("Chr01", 1, "N" * 1000)], "chrom string, block long, bases string")
    sites = spark.createDataFrame([("Chr01", 1, "A"), ("Chr01", 2, "A"), ("Chr01", 1001, "N"), ("Chr02", 1, "A")], "chrom string, pos int, ref string")
    got = site_ops.check_ref(sites, bases)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
    assert sorted(tuple(r) for r in got.select("chrom", "pos", "base").collect()) == [("Chr01", 2, "C"), ("Chr02", 1, None)]
