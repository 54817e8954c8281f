"""A third of all rows with one key: no task gets much more than its even share."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanebeacon.llm import fingerprints, sharding, urls

N = 12_000


@pytest.mark.parametrize("hot", ["null", "5"])
def test_next_rows_of_a_shared_id(spark, hot):
    rows = spark.range(N).selectExpr(f"if(id % 3 = 0, {hot}, id * 7) as doc_id", "concat('t', id) as text").repartition(6)
    following = fingerprints.with_next(rows, "doc_id", ["text"])
    found = {row["text"]: row for row in following.collect()}
    assert len(found) == N and Counter(row["next_text"] for row in found.values()) == Counter(list(found))
    # Once around, in descending order with the rows without an id last, each row is met once.
    start = max((row["doc_id"] for row in found.values() if row["doc_id"] is not None))
    at = next(text for text, row in found.items() if row["doc_id"] == start)
    ids = []
    for _ in range(N):
        ids.append(found[at]["doc_id"])
        at = found[at]["next_text"]
    assert found[at]["doc_id"] == start and ids == sorted(ids, key=lambda i: (i is None, -(i or 0)))
    tasks = [row["count"] for row in following.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 2.5 * N / 8


def test_rows_of_a_heavy_text_are_not_shuffled_by_it(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="20")
    rows = spark.range(N).selectExpr("if(id % 2 = 0, null, id % 3) as doc_id", "if(id % 3 = 0, 'the one text', concat('t', id)) as text")
    sharded = sharding.shard_documents(rows, 4)
    assert sharded.count() == N
    sizes = Counter(row["shard"] for row in sharded.collect())
    assert len(sizes) == 4 and max(sizes.values()) - min(sizes.values()) <= 0.05 * N
    tasks = [row["count"] for row in sharded.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= N / 5


def test_packing_beats_dealing_and_equals_plain_packing():
    """Plain packing: each vector to the bin with the highest dot product, written out number by number."""
    chance = np.random.default_rng(3)
    vectors = chance.random((200, 3)) ** 3 / 10
    got = sharding.pack(vectors, np.ones((5, 3)))
    residual = [[1.0] * 3 for _ in range(5)]
    expected = [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-max(vectors[i]), i)):
        scores = [sum(r * v * w for r, v, w in zip(bin_, vectors[i], sharding.WEIGHTS)) for bin_ in residual]
        expected[i] = scores.index(max(scores))
        residual[expected[i]] = [r - v for r, v in zip(residual[expected[i]], vectors[i])]
    assert got.tolist() == expected


def test_a_url_on_a_third_of_all_rows(spark, monkeypatch):
    rows = spark.range(N).selectExpr("id as page_id", "if(id % 3 = 0, 'http://hot.com/x', concat('http://h', id % 400, '.', element_at(array('com', 'net', 'org'), 1 + cast(id % 3 as int)), '/p')) as url")
    each = {}
    for crowded in (1000, 2, 1):
        monkeypatch.setattr(urls, "CROWDED", crowded)
        each[crowded] = sorted(tuple(row) for row in urls.judge_urls(rows).collect())
    assert each[1000] == each[2] == each[1] and len(each[1]) == N
    # page_id, host, path, rule, score, verdict
    assert all((row[4] is None) == (row[3] is not None) and row[5] in ("allow", "block") for row in each[1])
