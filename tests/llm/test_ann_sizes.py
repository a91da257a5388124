"""Recall and full rankings around the size below which every bucket is probed."""

import pytest
from pyspark.sql import functions as F

from isobar.llm import ann

from .test_vectors import check_ann, frame, vectors


@pytest.mark.parametrize("n,floor", [(160, 1.0), (161, 0.9), (200, 0.9), (320, 0.9)])
def test_full_rankings_around_the_switch(spark, n, floor):
    assert ann.EXHAUSTIVE_BELOW * 20 == 160
    rows = vectors(n, seed=12)
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    check_ann(got, rows, 20, 20, floor)     # also: each query has 20 rows
