import random
import zlib

import numpy as np
import pytest

from shoplake.llm.toxicity import Codes, NAMES, described, drop_toxic, score_toxicity, stems, undisguised

LABEL = "doc_id bigint, quality int, toxic int"
INSULTS = ["moronic", "scumbag", "zqworthless"]


def corpus(seed, n=500):
    pick = random.Random(seed)
    common = ["".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(400)]
    pairs, labels = [], []
    for i in range(n):
        text = pick.choices(common, k=pick.randint(5, 200))
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(max(2, len(text) // 15)):
                text.insert(pick.randrange(len(text)), "you " + pick.choice(INSULTS) + pick.choice(["", "!", "s"]))
        pairs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return pairs, labels


@pytest.fixture(scope="module")
def scored(spark):
    pairs, labels = corpus(1)
    pairs += [(9001, None), (9002, ""), (9003, "x " * 100_000), (9004, pairs[0][1]), (9004, pairs[0][1]), (None, "a")]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string").selectExpr(
        "*", "'x' as source", "1 as score", "2 as predicted", "3 as toxic", "4 as part"
    )

    def run(labels):
        return score_toxicity(docs, spark.createDataFrame(labels, LABEL))

    # Labels of held-out rows say the opposite here, and some labels are unusable.
    held = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    return labels, run(labels).collect(), run(held + [(None, 1, 1), (5, 1, 7), (6, 1, None)]).collect()


def test_held_out_accuracy(scored):
    labels, found, _ = scored
    toxic = {i: t for i, _, t in labels}
    held = [r for r in found if r.held_out and r.doc_id in toxic]
    assert {r.doc_id for r in found if r.held_out} == {
        r.doc_id for r in found if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
    }
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_are_never_learned(scored):
    _, found, other = scored
    assert sorted(map(str, found)) == sorted(map(str, other))


def test_every_row_is_scored(scored):
    _, found, _ = scored
    assert len(found) == 506
    by_id = {r.doc_id: r for r in found}
    assert by_id[9001].score == by_id[9002].score < 0.5
    assert by_id[9004].predicted == 1
    assert not by_id[None].held_out


def test_too_few_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    assert {r.score for r in score_toxicity(docs, spark.createDataFrame([], LABEL)).collect()} == {0.0}
    assert {r.score for r in score_toxicity(docs, spark.createDataFrame([(1, 1, 1)], LABEL)).collect()} == {1.0}
    assert score_toxicity(docs.where("false"), spark.createDataFrame([(1, 1, 1)], LABEL)).count() == 0
    kept = drop_toxic(docs, spark.createDataFrame([], LABEL))
    assert (kept.columns, kept.count()) == (["doc_id", "text"], 2)


def test_features():
    codes = Codes({"=idiot": 3.0, "scum": 2.0})
    found = dict(zip(NAMES, described("You 1D1OT! you are scumbags, really NICE", codes)))
    assert found["hit_count"] == pytest.approx(np.log(3))
    assert (found["largest_weight"], found["near_second_person"]) == (3.0, 1.0)
    assert found["disguised_hits"] == pytest.approx(1 / 7)
    assert found["second_person"] == pytest.approx(2 / 7)
    assert described(None, codes) == described(" \n", codes) == [0.0] * len(NAMES)
    assert undisguised("i-d.i0000t") == "idiot"
    assert stems("scumbag") == ["=scumbag", "scum", "scumb", "scumba"]
