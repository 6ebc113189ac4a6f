from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplake.operators import (
    explode_documents,
    explode_keeping,
    first_failure,
    first_per_group,
    keep_first,
    passing,
    rejects_by_rule,
    top,
    without_copies,
    without_copies_late,
)

RECORD = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["", "a", "b"])),
    st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
)


def nulls_first(values):
    return [(v is not None, v) for v in values]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(RECORD, min_size=1, max_size=25))
def test_dedup_keeps_the_smallest_row(spark, records):
    expected = {}
    for record in records:
        key = record[0]
        if key not in expected or nulls_first(record) < nulls_first(expected[key]):
            expected[key] = record
    copies = Counter(record[0] for record in records)
    blank = Counter(record[0] for record in records if record[1] is None)

    df = spark.createDataFrame(records, "k int, t string, v double").repartition(3)
    assert {tuple(r) for r in without_copies(df, ["k"]).collect()} == set(expected.values())
    for most in (100, 0):
        late = without_copies_late(df, ["k"], most).collect()
        assert Counter(map(tuple, late)) == Counter(expected.values())
    tally = F.count_if(F.col("t").isNull()).alias("blank")
    found = {r[0]: tuple(r) for r in keep_first(df, ["k"], [tally]).collect()}
    assert found == {k: (*row, copies[k], blank[k]) for k, row in expected.items()}


def test_dedup_on_two_keys_keeps_column_order(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, 2, 9), ("w", 1, 2, 9), ("x", 1, 3, 9)], "t string, a int, b int, c int"
    )
    kept = without_copies(df, ["a", "b"])
    assert kept.columns == ["t", "a", "b", "c"]
    assert rows(kept) == [("w", 1, 2, 9), ("x", 1, 3, 9)]
    assert keep_first(df, ["a", "b"]).columns == ["t", "a", "b", "c", "copies"]


def test_late_dedup_of_no_rows_and_clashing_names(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, 5), (1, 2, 4), (None, 2, 3), (None, 2, 3), (3, 3, 3)], "k int, k_0 int, copies int"
    )
    assert rows(without_copies_late(df, ["k"])) == [(None, 2, 3), (1, 2, 4), (3, 3, 3)]
    assert rows(without_copies_late(df, ["k_0", "copies"])) == [
        (None, 2, 3), (1, 2, 4), (1, 2, 5), (3, 3, 3),
    ]
    assert without_copies_late(df.limit(0), ["k"]).count() == 0


def test_late_dedup_moves_keys_in_place_of_rows(spark, tmp_path):
    """Shuffled bytes of lines of which one in fifty is there twice."""
    lines = spark.range(0, 40_000, numPartitions=4).select(
        (F.col("id") - (F.col("id") % 50 == 1).cast("int")).alias("k"),
        *[F.sha2((F.col("id") + i).cast("string"), 256).alias(f"c{i}") for i in range(6)],
    )
    lines.write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))

    def moved(df):
        df.collect()
        stack, total = [df._jdf.queryExecution().executedPlan()], 0
        while stack:
            node = stack.pop()
            kind = node.getClass().getSimpleName()
            if kind == "AdaptiveSparkPlanExec":
                stack.append(node.executedPlan())
                continue
            if kind.endswith("QueryStageExec"):
                stack.append(node.plan())
                continue
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("dataSize").value()
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
        return total

    keys = moved(lines.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    plain, late = without_copies(lines, ["k"]), without_copies_late(lines, ["k"])
    assert 2 * (keys + moved(late)) < moved(plain)
    assert sorted(late.collect()) == sorted(plain.collect())


def test_a_hot_key_sends_few_rows(spark):
    """A key holding most rows is cut down before the shuffle, in both forms."""
    df = spark.range(0, 100_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    plan = without_copies(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_min")
    assert without_copies(df, ["k"]).count() == keep_first(df, ["k"]).count()
    assert keep_first(df, ["k"]).filter("k = 0").first().copies == 66_667


def test_explode(spark, rows):
    docs = spark.createDataFrame(
        [([(1, "a"), (2, "b")],), ([],), (None,)], "things array<struct<id:int,t:string>>"
    )
    assert rows(explode_documents(docs, "things")) == [(1, "a"), (2, "b")]
    parents = spark.createDataFrame([(7, [1, 2]), (8, []), (9, None)], "p int, xs array<int>")
    assert rows(explode_keeping(parents, [F.col("p")], "xs", "x")) == [(7, 1), (7, 2)]


def test_rules_name_the_first_failure_and_null_fails(spark, rows):
    rules = {"positive": F.col("x") > 0, "small": F.col("x") < 10}
    df = spark.createDataFrame([(1,), (-1,), (50,), (None,)], "x int")
    found = df.select("x", first_failure(rules).alias("f"))
    assert rows(found) == [
        (None, "positive"),
        (-1, "positive"),
        (1, None),
        (50, "small"),
    ]
    assert rows(df.filter(passing(rules))) == [(1,)]
    assert rows(rejects_by_rule(df, rules)) == [("positive", 2), ("small", 1)]


def test_first_per_group_and_top(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "c", 4), (2, None, 3), (2, "z", 3), (None, "n", 1)],
        "k int, c string, q int",
    )
    order = [F.desc("q"), F.asc_nulls_last("c")]
    assert rows(first_per_group(df, ["k"], order), "k", "c") == [
        (None, "n"),
        (1, "a"),
        (2, "z"),
    ]
    assert [r.c for r in top(df, 2, *order).collect()] == ["a", "b"]
    assert top(df, 100, *order).count() == 6
