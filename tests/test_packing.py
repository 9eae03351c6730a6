"""Request packing against the plain loop, over blocks of any size."""

from __future__ import annotations

import random

import pytest

from ledgerspark.operators import packing as P
from pyspark.sql import functions as F


def greedy(rows, limits, most):
    """The request of each row, taking them one after the other."""
    out, n, used = [], 0, [0] * len(limits)
    request = 0
    for row in rows:
        over = any(used[i] + row[i] > limit and not (nothing and row[i] == 0) for i, (limit, nothing) in enumerate(limits))
        if n and (n >= most or over):
            request, n, used = request + 1, 0, [0] * len(limits)
        n, used = n + 1, [a + b for a, b in zip(used, row, strict=True)]
        out.append(request)
    return out


@pytest.mark.parametrize(("n", "partitions", "most"), [(0, 4, 3), (1, 4, 3), (7, 40, 10), (300, 1, 10), (300, 60, 10), (400, 7, 1), (500, 90, 25)])
def test_blocks_equal_the_loop(spark, n, partitions, most):
    r = random.Random(n + most)
    rows = [(r.choice([0, 0, 1, 3, 7, 60]), r.choice([1, 2, 11])) for _ in range(n)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, a long, b long").repartition(5)
        for nothing in (True, False):
            limits = {"a": (10, nothing), "b": (14, False)}
            got = [x.request for x in P.pack(df, [F.col("i")], limits, most).orderBy("i").collect()]
            assert got == greedy(rows, list(limits.values()), most)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def requests(df):
    out = {}
    for x in df.orderBy("source_id").collect():
        out.setdefault(x.request, []).append(x.source_id)
    return list(out.values())


def test_page_budget_estimates_and_oversized_pages(spark):
    ddl = "source_id string, page_start int, page_end int, total_pages int, estimated_rows int"
    f = lambda pages, estimate=None: spark.createDataFrame([(f"f{i}", 1, p, p, estimate) for i, p in enumerate(pages)], ddl)
    order = [F.col("source_id")]
    assert requests(P.page_requests(f([3, 3, 3, 1]), order, pages=6)) == [["f0", "f1"], ["f2", "f3"]]
    assert requests(P.page_requests(f([3, 3, 3, 1]), order, pages=100, most=3)) == [["f0", "f1", "f2"], ["f3"]]
    assert requests(P.page_requests(f([3, 3, 3], 30), order, pages=100)) == [["f0"], ["f1"], ["f2"]]
    assert requests(P.page_requests(f([2, 2]), order, pages=100)) == [["f0", "f1"]]
    assert requests(P.page_requests(f([4]), order, pages=2)) == [["f0"]]
    halves = spark.createDataFrame([("a", 1, 10, 15, 45), ("b", 11, 15, 15, 45)], ddl)
    assert [x.rows for x in P.page_requests(halves, order).orderBy("source_id").collect()] == [30, 15]


def test_windows_without_table_rows_weigh_one(spark):
    df = spark.createDataFrame([(f"w{i:02}", 0) for i in range(12)], "source_id string, table_rows int")
    assert requests(P.text_requests(df, [F.col("source_id")], rows=5)) == [[f"w{i:02}" for i in range(a, min(12, a + 5))] for a in (0, 5, 10)]
    with pytest.raises(ValueError):
        P.pack(df, [F.col("source_id")], {}, 0)
