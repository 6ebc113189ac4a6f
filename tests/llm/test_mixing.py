import random
from collections import defaultdict

import numpy as np
import pytest

from shoplake.llm.mixing import RIDGE, drawn, fitted, learned, memberships, mix

WORDS = {
    "x": [f"x{i}" for i in range(60)],
    "y": [f"y{i}" for i in range(60)],
    "z": [f"z{i}" for i in range(60)] + [f"x{i}" for i in range(20)],
}
TARGETS = {"x": 0.5, "y": 0.3, "z": 0.2}


def corpus(seed, n=600):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        domain = pick.choices("xyz", weights=[6, 3, 2])[0]
        words = pick.choices(WORDS[domain], k=pick.randint(1, 150))
        rows.append((i, pick.choice([" ", "\n\t"]).join(words), domain))
    return rows


@pytest.fixture
def frames(spark):
    def make(rows, labelled):
        docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").selectExpr(
            "*", "1 as row", "2 as tokens", "3 as word", "4 as feature", "5 as domain", "6 as p0", "7 as rate"
        )
        return docs, spark.createDataFrame(labelled, "doc_id bigint, domain string")

    return make


def test_domains_are_predicted_and_totals_match_the_targets(frames):
    rows = corpus(1)
    docs, labelled = frames(rows, [(i, d) for i, _, d in rows if i % 3 == 0] + [(None, "x"), (1, "other"), (2, None)])
    found = mix(docs, labelled, TARGETS, tolerance=1e-6).collect()
    truth = {i: (d, len(t.split())) for i, t, d in rows}
    assert all(r.tokens == truth[r.doc_id][1] and 0 <= r.rate and r.converged for r in found)
    assert all(abs(r.reached_share - r.target_share) < 1e-4 for r in found)
    assert sum(r.domain == truth[r.doc_id][0] for r in found) > 0.95 * len(found)
    expected, drawn_ = defaultdict(float), defaultdict(float)
    for r in found:
        expected[r.domain] += r.rate * r.tokens
        drawn_[r.domain] += r.copies * r.tokens
    for totals, margin in ((expected, 0.02), (drawn_, 0.06)):
        whole = sum(totals.values())
        assert all(abs(totals[d] / whole - w) < margin for d, w in TARGETS.items()), totals


def test_rates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    p, tokens = rng.dirichlet([0.3, 0.5, 0.4], 200), rng.integers(0, 500, 200)
    weights = [0.9, 0.08, 0.02]
    rows = [(i, int(tokens[i]), *map(float, p[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, p0 double, p1 double, p2 double")
    for total, most, steps in ((None, None, 15), (30_000.0, 1.0, 12), (10.0**6, None, 4), (10.0**6, 3.0, 6)):
        goal = np.array(weights) * (tokens.sum() if total is None else total)
        gram = (p * tokens[:, None]).T @ p + RIDGE * tokens.sum() / 3 * np.eye(3)
        rates = np.full(200, min(goal.sum() / tokens.sum(), most or np.inf))
        for _ in range(steps):
            rates = np.clip(rates - p @ np.linalg.solve(gram, (tokens * rates) @ p - goal), 0, most)
        fit = fitted(df, weights, most, total, steps, -1.0)
        found = {r[0]: r[1] for r in df.select("doc_id", fit.rate).collect()}
        assert np.allclose([found[i] for i in range(200)], rates, atol=1e-9)
        assert np.allclose(fit.reached, (tokens * rates) @ p) and np.allclose(fit.wanted, goal)
        assert fit.steps == steps and not fit.converged
    # Where no rate is at a bound it is the least-squares fit.
    fit = fitted(df, [0.5, 0.3, 0.2], tolerance=1e-9)
    assert fit.converged and np.allclose(fit.reached, np.array([0.5, 0.3, 0.2]) * tokens.sum())


def sized(shares, n=3000, seed=7):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        domain = pick.choices(list(shares), weights=list(shares.values()))[0]
        rows.append((i, " ".join(f"{domain}{k}" for k in pick.choices(range(60), k=60)), domain))
    return rows


def test_shares_are_met_for_scarce_and_common_domains(frames):
    rows = sized({"w": 0.6, "x": 0.375, "y": 0.02, "z": 0.005})
    docs, labelled = frames(rows, [(i, d) for i, _, d in rows if i % 2 == 0])
    for targets in ({"w": 0.25, "x": 0.25, "y": 0.25, "z": 0.25}, {"w": 0.05, "x": 0.04, "y": 0.9, "z": 0.01}):
        found = mix(docs, labelled, targets).collect()
        expected, drawn_ = defaultdict(float), defaultdict(float)
        for r in found:
            expected[rows[r.doc_id][2]] += r.rate * r.tokens
            drawn_[rows[r.doc_id][2]] += r.copies * r.tokens
        assert all(r.converged for r in found)
        assert all(abs(expected[d] / sum(expected.values()) - w) < 0.01 for d, w in targets.items()), expected
        assert all(abs(drawn_[d] / sum(drawn_.values()) - w) < 0.02 for d, w in targets.items()), drawn_
        assert abs(sum(expected.values()) / (60 * len(rows)) - 1) < 0.01


def test_the_mixture_changes_as_little_as_its_targets(frames):
    rows = sized({"x": 0.5, "y": 0.5}, 600)
    docs, labelled = frames(rows, [(i, d) for i, _, d in rows])
    before = None
    for share in (0.5, 0.8, 0.81):
        found = mix(docs, labelled, {"x": share, "y": 1 - share}).collect()
        tokens = sum(r.rate * r.tokens for r in found)
        of_x = sum(r.rate * r.tokens for r in found if r.domain == "x") / tokens
        assert abs(tokens / (60 * len(rows)) - 1) < 0.01 and abs(of_x - share) < 0.01
        assert before is None or of_x > before
        before = of_x


def test_memberships_match_brute_force(frames):
    rows = corpus(5, 60)
    docs, labelled = frames(rows, [(i, d) for i, _, d in rows if i < 40])
    model, priors = learned(docs, labelled, ["x", "y", "z"], "doc_id", "text", 30)
    table = {r.feature: r for r in model.collect()}
    assert len(table) == 8192
    found = memberships(docs, model, priors).collect()
    assert len(found) == 60
    assert all(abs(r.p0 + r.p1 + r.p2 - 1) < 1e-9 for r in found)
    sums = np.exp([[table[f][f"l{i}"] for f in table] for i in range(3)]).sum(axis=1)
    assert np.allclose(sums, 1)


def test_nulls_empty_and_long_texts_repeats_and_missing_labels(frames, spark):
    rows = [(1, None, ""), (2, "", ""), (3, " \n", ""), (4, "x1 " * 50_000, ""), (4, "x1 " * 50_000, ""), (None, "y1", "")]
    docs, labelled = frames(rows, [])
    found = mix(docs, labelled, TARGETS).collect()
    assert len(found) == 6
    assert sorted(r.tokens for r in found) == [0, 0, 0, 1, 50_000, 50_000]
    assert all(abs(r.probability - 1 / 3) < 1e-9 for r in found)
    assert mix(docs.where("false"), labelled, TARGETS).count() == 0
    taken = drawn(docs, labelled, TARGETS)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in found)


def test_a_domain_that_is_not_there_leaves_the_others_at_their_targets(frames):
    rows = sized({"x": 0.7, "y": 0.3}, 2000)
    docs, labelled = frames(rows, [(i, d) for i, _, d in rows if i % 2 == 0])
    found = mix(docs, labelled, {"x": 0.5, "y": 0.4, "z": 0.1}).collect()
    assert not any(r.converged for r in found)
    tokens = defaultdict(float)
    for r in found:
        tokens[rows[r.doc_id][2]] += r.rate * r.tokens / (60 * len(rows))
    assert abs(tokens["x"] - 0.5) < 0.01 and abs(tokens["y"] - 0.4) < 0.01
    whole = drawn(docs, labelled, {"x": 0.5, "y": 0.4, "z": 0.1}).count()
    assert abs(whole / len(rows) - 0.9) < 0.03
    some = drawn(docs, labelled, {"x": 0.5, "y": 0.5}, total=0.2 * 60 * len(rows)).count()
    assert abs(some / len(rows) - 0.2) < 0.03


def test_rows_of_one_id_with_different_texts_are_drawn_apart(frames):
    rows = [(i, f"x{i % 60} " * 50, "x") for i in range(300)] + [(i, "z1 z2 z3 " * 10, "z") for i in range(4)]
    docs, labelled = frames(rows, [(i, "x") for i in range(10, 200)] + [(999, "z")])
    docs = docs.unionByName(docs.limit(1).selectExpr("999L as doc_id", "'z1 z2 z3' as text", *docs.columns[2:]))
    taken = drawn(docs, labelled, {"x": 0.9, "z": 0.1})
    mixed = mix(docs, labelled, {"x": 0.9, "z": 0.1})
    assert taken.count() == mixed.agg({"copies": "sum"}).first()[0]
