import random

import numpy as np
import pytest

from shoplake.llm import substring
from shoplake.llm.substring import repeated, run_starts, sliding_minimum, without_repeats


def by_hand(pairs, size=13):
    texts = [(2**63 if i is None else i, (t or "").encode().split()) for i, t in pairs]
    first = {}
    for i, w in texts:
        for at in range(len(w) - size + 1):
            x = tuple(w[at : at + size])
            first[x] = min(first.get(x, i), i)
    found = []
    for (i, w), (own, _) in zip(texts, pairs):
        gone = [False] * len(w)
        for at in range(len(w) - size + 1):
            if first[tuple(w[at : at + size])] < i:
                gone[at : at + size] = [True] * size
        found.append((own, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(found, key=str)


def corpus(seed, size):
    pick = random.Random(seed)
    passages = [[f"p{n}x{i}" for i in range(pick.randint(size - 2, 4 * size))] for n in range(6)]
    pairs = []
    for i in range(150):
        text = []
        for _ in range(pick.randint(0, 5)):
            text += pick.choices([f"w{n}" for n in range(30)] + ["é", "日本"], k=pick.randint(0, 25))
            text += pick.choice(passages) if pick.random() < 0.5 else []
        pairs.append((pick.randrange(10**6), pick.choice([" ", "\n ", "\t"]).join(text)))
    pairs += [(i, pick.choice(pairs)[1]) for i in range(2_000_000, 2_000_020)]
    loop = " ".join(["again"] * 60)  # a text that repeats itself
    pairs += [(7_000_000, loop), (7_000_001, loop + " end"), (None, loop), (None, "x " + loop)]
    pairs += [(8_000_000, pairs[0][1])] * 3 + [(8_000_000, pairs[1][1]), (9, None), (10, ""), (11, " \n")]
    return pairs


@pytest.mark.parametrize("size", [13, 4, 2, 1])
def test_removals_match_brute_force(documents, size):
    pairs = corpus(size, size)
    docs = documents(pairs, 6).selectExpr("*", "1 as key", "2 as id", "3 as bucket", "4 as data", "5 as spans")
    found = without_repeats(docs, size).collect()
    assert sorted((tuple(r) for r in found), key=str) == by_hand(pairs, size)


def test_many_small_chunks_and_buckets(documents, monkeypatch):
    monkeypatch.setattr(substring, "STEP", 200)
    monkeypatch.setattr(substring, "BUCKET", 40)
    pairs = corpus(99, 13)
    found = without_repeats(documents(pairs, 5)).collect()
    assert sorted((tuple(r) for r in found), key=str) == by_hand(pairs)


def test_a_passage_that_a_third_of_all_documents_share(documents):
    pick = random.Random(1)
    shared = [f"s{i}" for i in range(50)]
    pairs = []
    for i in range(900):
        text = [f"d{i}w{n}" for n in range(20)]
        at = pick.randrange(20)
        pairs.append((i, " ".join(text[:at] + (shared if i % 3 == 0 else []) + text[at:])))
    found = {r.doc_id: r for r in without_repeats(documents(pairs, 8)).collect()}
    assert [found[i].n_removed for i in range(9)] == [0, 0, 0, 50, 0, 0, 50, 0, 0]
    assert sum(r.n_removed for r in found.values()) == 299 * 50


def test_long_texts_and_no_rows(documents):
    long = " ".join(f"w{i}" for i in range(150_000))
    found = {r.doc_id: r for r in without_repeats(documents([(1, long), (2, "new " + long)])).collect()}
    assert (found[1].n_removed, found[2].n_removed, found[2].kept) == (0, 150_000, "new")
    assert without_repeats(documents([])).count() == 0


def test_equal_hashes_of_different_words_are_told_apart():
    texts = [b"a", b"b", b"a", b"b", b"c"]
    hashes = np.array([5, 5, 5, 5, 9], dtype=np.uint64)
    assert repeated(hashes, np.array([3, 2, 4, 1, 0]), texts.__getitem__).tolist() == [False, True, True, False, False]


@pytest.mark.parametrize("width", range(1, 14))
def test_sliding_minimum(width):
    values = np.random.default_rng(width).integers(0, 99, 40).astype(np.uint64)
    expected = [values[i : i + width].min() for i in range(40 - width + 1)]
    assert sliding_minimum(values, width).tolist() == expected


def test_super_k_mers_break_where_the_minimiser_changes():
    begins = run_starts(np.array([0, 1, 2, 5, 6]), np.array([4, 4, 3, 3, 3]), np.array([False] * 4 + [True]))
    assert begins.tolist() == [True, False, True, True, True]
