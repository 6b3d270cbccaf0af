"""Join conditions, and that plans bring no rows of data to a single task."""

from statloom.operators.joins import key_condition
from statloom.plans import blocks
from statloom.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_null_matches_null_only_where_nullable(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (None, "b")], "k int, j string").alias("l")
    right = spark.createDataFrame([(1, None), (2, "a"), (None, "b")], "k int, j string").alias("r")
    both = left.join(right, key_condition(left, right, ["k", "j"]))
    assert both.count() == 3
    some = left.join(right, key_condition(left, right, ["k", "j"], nullable=["j"]))
    assert some.count() == 2


def test_blocks_run_no_job_while_they_are_planned(spark, capsys):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    df = blocks.testdata_employment(Tables(spark, SF))
    assert len(tracker.getJobIdsForGroup(None)) == before
    df.explain()
    assert "SinglePartition" not in capsys.readouterr().out
