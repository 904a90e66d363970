"""No operator broadcasts what an explode made: Spark sizes it by what was exploded."""

import random

from lakeshore.llm import simhash
from lakeshore.llm.common import saved


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_simhash_variants_are_not_broadcast(spark):
    r = random.Random(3)
    fps = [r.getrandbits(63) for _ in range(200)]
    # Files have sizes, other than frames of Python rows.
    frame = saved(spark.createDataFrame([(f,) for f in fps] + [(f ^ 5,) for f in fps], "fp long"), "test")
    links = simhash.links(frame)
    assert "SortMergeJoin" in plan(links) and "BroadcastHashJoin" not in plan(links)
    assert {frozenset(x) for x in links.collect()} == {frozenset((f, f ^ 5)) for f in fps}
