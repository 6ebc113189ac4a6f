import hashlib
import random

import pytest

from shoplake.llm.exact import digests, drop_copies, exact_groups, merge_runs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    found = []
    for i, t in pairs:
        t = (t or "").translate(LOWER)
        keep = max((x for x in groups[t] if x is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        found.append((i, keep, len(groups[t]), i == keep, sha))
    return sorted(found, key=str)


def test_groups_match_brute_force(documents):
    pick = random.Random(1)
    texts = ["", None, "A b", "a B", "É", "é", "x" * 200_000, "X" * 200_000, " a b", "tail"]
    pairs = [(i, pick.choice(texts)) for i in range(300)] + [(7, "a b"), (7, "a b"), (None, "a b")]
    found = exact_groups(documents(pairs, 7))
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_hand(pairs)


@pytest.mark.parametrize("runs, radix", [(1, 2), (5, 2), (16, 4), (30, 4)])
def test_every_tree_gives_the_same_groups(documents, runs, radix):
    pairs = [(i, f"text {i % 40}" if i % 3 else "hot") for i in range(600)]
    merged = merge_runs(digests(documents(pairs, 9)), runs, radix).collect()
    assert len(merged) == len({t for _, t in pairs})
    hot = max(merged, key=lambda r: r.copies)
    assert (hot.copies, hot.keep) == (200, 597)


def test_no_rows(documents):
    assert exact_groups(documents([])).count() == 0
    assert drop_copies(documents([])).count() == 0


def test_drop_copies_keeps_one_row_with_all_its_columns(documents):
    docs = documents(
        [(1, "A"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (None, "c"), (None, "c"), (None, "b"), (5, "z")]
    )
    docs = docs.selectExpr("*", "doc_id as id", "'x' as sha", "1 as keep", "2 as copies")
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id > 0").collect()) == [
        (2, "a"), (4, ""), (5, "b"), (5, "z"),
    ]
    # Of rows without an id those stay whose text no other row has.
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["c", "c"]


def test_texts_move_once_at_most(spark, documents):
    docs = documents([(i, f"t{i % 50}") for i in range(200)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert len(moved) <= 2  # once for either branch; Spark uses one for both


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    rows = [(1, "a", "en", f"s{i}", i) for i in range(20)]
    for turned in (rows, rows[::-1]):
        docs = spark.createDataFrame(turned, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        assert [r.source for r in drop_copies(docs.repartition(4)).collect()] == ["s0"]
