import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplake.llm.topk import Tree, largest_products

VECTOR = "vec_id bigint, embedding array<float>, label int, floor bigint, shard int"


def by_hand(rows, k=5):
    points = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        points[i] = min(points.get(i, v), v)
    whole = {i: [int(np.floor(x * 256)) for x in v] for i, v in points.items()}
    found = []
    for q in whole:
        if q % 5 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(whole[q], v)), i)
                for i, v in whole.items()
                if i != q and len(v) == len(whole[q])
            )
            found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], VECTOR)


def searched(spark, rows, **options):
    return largest_products(frame(spark, rows), F.col("vec_id") % 5 == 0, **options)


def test_search_matches_brute_force(spark):
    pick = np.random.default_rng(2)
    rows = [(i, [float(x) for x in pick.normal(0, 0.2, 8)]) for i in range(400)]
    rows += [(i, [0.25] * 8) for i in range(400, 600)]  # a vector that is very common
    rows += [(600, None), (605, [None] * 8), (610, [float("nan")] * 8), (615, [float("inf")] * 8)]
    rows += [(620, []), (621, []), (625, [0.5, 0.5]), (None, [0.1] * 8), (5, [0.9] * 8), (10, rows[10][1])]
    found = searched(spark, rows)
    assert sorted(tuple(r) for r in found.collect()) == by_hand(rows)


def test_fewer_candidates_than_k_and_none(spark):
    assert [tuple(r) for r in searched(spark, [(5, [1.0]), (6, [-1.0])]).collect()] == [(5, 1, 6, -65536)]
    assert searched(spark, [(5, [1.0])]).count() == 0
    assert searched(spark, []).count() == 0


def test_products_beyond_doubles_are_exact():
    points = np.array([[2.0**40, 1.0], [2.0**40, 2.0], [-(2.0**40), 3.0]])
    tree = Tree(np.array([1, 2, 3]), points)
    found = tree.search(9, np.array([2.0**20, 1.0]), 2, None)
    assert found == [(2**60 + 2, -2), (2**60 + 1, -1)]


@pytest.mark.parametrize("floor", [None, 3])
def test_ties_reach_the_smaller_id_across_leaves(floor):
    points = np.array([[1.0, float(i % 2)] for i in range(500)])
    tree = Tree(np.arange(500), points)
    assert tree.search(0, np.array([3.0, 0.0]), 3, floor) == [(3, -1), (3, -2), (3, -3)]
