import random
from itertools import combinations

import numpy as np
import pytest

from shoplake.llm.graph import components
from shoplake.llm import near
from shoplake.llm.near import BANDS, ROWS, drop_near_copies, near_groups, scrambled, shingled, signatures
from shoplake.llm.rolling import BLOCK, Joined

EXTRA = "1 as class, 2 as n, 'x' as key, 3 as bucket, 4 as component"


def as_set(text, size):
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def by_hand(pairs, size, percent=80):
    sets = {i: as_set(t, size) for i, t in pairs}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if either and both and 100 * both >= percent * either:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(300)]
    pairs = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([1, 3, 40, 120])))) for i in range(60)]
    for _ in range(140):  # chains of edited copies
        text = pick.choice(pairs)[1].split()
        for _ in range(pick.randint(0, 5)):
            text[pick.randrange(len(text))] = pick.choice(vocabulary).upper()
        pairs.append((len(pairs) + 1000, pick.choice([" ", "\n", "\t "]).join(text)))
    return pairs + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "a b")]


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(documents, size):
    pairs = corpus(size)
    docs = documents(pairs, 7).selectExpr("*", *EXTRA.split(", "))
    found = {r.doc_id: tuple(r)[1:] for r in near_groups(docs, size).collect()}
    assert found == by_hand(pairs, size)


def test_one_large_group_of_near_copies(documents):
    base = [f"word{i}" for i in range(100)]
    pairs = [(9000 - i, " ".join([*base[: i % 100], f"new{i}", *base[i % 100 + 1 :]])) for i in range(700)]
    found = near_groups(documents(pairs, 5), 2).collect()
    assert {r.component_id for r in found} == {9000 - 699}
    assert sum(r.kept for r in found) == 1


def test_repeated_rows_null_ids_long_texts_and_no_rows(documents):
    long = " ".join(f"w{i}" for i in range(60_000))
    pairs = [(3, long), (5, long + " end"), (5, long + " end"), (None, long), (7, None)]
    found = sorted((tuple(r) for r in near_groups(documents(pairs)).collect()), key=str)
    assert found == sorted(
        [(3, 59996, 3, True), (5, 59997, 3, False), (5, 59997, 3, False), (7, 0, 7, True), (None, 59996, None, True)],
        key=str,
    )
    assert near_groups(documents([])).count() == 0
    kept = drop_near_copies(documents(pairs))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 7, None]
    assert kept.columns == documents([]).columns


def test_signatures_are_of_two_permutations():
    places = np.unique(np.random.default_rng(1).integers(0, 2**32, 100_000, dtype=np.uint64))
    assert len(np.unique(scrambled(places.astype(np.uint32)))) == len(places)
    one = np.random.default_rng(2).integers(0, 2**64, 900, dtype=np.uint64)
    rows = signatures([np.unique(one[:850]), np.unique(one[50:])], 2000)
    assert abs((rows[0] == rows[1]).mean() - 800 / 900) < 0.04
    assert (1 - 0.8**ROWS) ** BANDS < 2e-7


def test_window_hashes_do_not_depend_on_where_they_stand():
    text = [b"ab", b"c", b"ab", b"c", b"x" * (BLOCK + 5), b"ab", b"c"]
    joined = Joined.of([[], text, [b"q"], [], [b"ab", b"c"]])
    starts = joined.windows(2)
    hashes = joined.hashes(starts, 2)
    assert starts.tolist() == [0, 1, 2, 3, 4, 5, 8]
    assert hashes[0] == hashes[2] == hashes[5] == hashes[6]
    assert len(set(hashes.tolist())) == 4
    assert len(shingled([None, "", "A b", "a B"], 2)[2]) == 1


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1400)},
    }
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_that_repeat_an_id_go_by_their_own_text(documents):
    pick = random.Random(12)
    one = " ".join(f"w{pick.randrange(900)}" for _ in range(200))
    other = " ".join(f"v{pick.randrange(900)}" for _ in range(200))
    docs = documents([(3, one), (5, one + " end"), (5, other), (6, other + " end"), (None, one)])
    kept = drop_near_copies(docs)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, one), (5, other), (None, one)], key=str
    )
    found = near_groups(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, True), (3, 3, True), (5, 3, False), (5, 5, True), (6, 5, False),
    ]


def template(pick, n, own, shared):
    """Texts that share most of their words, and a near copy of every ninth."""
    text = [f"t{i}" for i in range(shared)]
    pairs = []
    for i in range(n):
        words = [*text, *[f"o{i}x{j}" for j in range(own)]]
        pairs.append((2 * i, " ".join(words)))
        if i % 9 == 0:
            words[pick.randrange(5, shared - 5)] = f"n{i}"
            pairs.append((2 * i + 1, " ".join(words)))
    pick.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("block", [16, 4096])
def test_a_template_with_copies_is_joined_in_full(documents, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    pairs = template(random.Random(4), 140, 24, 100) + corpus(3)[-60:]
    found = {r.doc_id: tuple(r)[1:] for r in near_groups(documents(pairs, 3), 2).collect()}
    assert found == by_hand(pairs, 2)


@pytest.mark.parametrize("percent", [55, 80, 95])
def test_prefixes_name_every_link(spark, percent):
    pick = random.Random(percent)
    sets = {}
    for i in range(160):
        if i and pick.random() < 0.7:
            s = set(sets[pick.randrange(i)])
            s = set(pick.sample(sorted(s), max(1, len(s) - pick.randint(0, 6))))
        else:
            s = set(range(40)) if pick.random() < 0.5 else set()
        sets[i] = s | {pick.randrange(100, 400) for _ in range(pick.randint(1, 9))}
    members = spark.createDataFrame([(i, i % 150, 7) for i in sets], "class bigint, component bigint, hub bigint")
    rows = [(i, sorted(s)) for i, s in sets.items()]
    stored_sets = spark.createDataFrame(rows, near.SETS)
    named = near.pairs_by_prefix(near.prefixes(members, stored_sets, percent), percent)
    found = {tuple(sorted(r)) for r in near.confirmed(named, stored_sets, percent).collect()}
    links = {
        (a, b) for a, b in combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and a % 150 != b % 150
    }
    assert links and found == links
    assert named.count() < 160 * 159 // 2
