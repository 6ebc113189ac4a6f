import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplake.llm.packing import Encoder, filled, pack, pack_documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE = "doc_id bigint, start bigint, length bigint, loss bigint, tag string"


def test_encoder_gives_the_tokenizers_ids():
    pick = random.Random(5)
    letters = list(" \n\t\r  \x85\x1c\x0b'sabé1!?.́日<|>")
    texts = ["".join(pick.choices(letters, k=pick.randrange(40))) for _ in range(3000)]
    texts += ["", " ", "\n\n", "a  b", "it's we'll", "a<|endoftext|>b", "tab\tx ", "word " * 5000]
    encoder, tokenizer = Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    assert encoder.merged
    for text in texts:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        assert encoder.encode(text) == ids.tobytes(), repr(text)


def test_texts_together_have_the_ids_that_they_have_apart():
    pick = random.Random(6)
    letters = [*" \n\t\r\x85\x1c\x0b'sabé1!?日", "\u3000", "  ", "\n\n", " the", "<|endoftext|>"]
    texts = ["".join(pick.choices(letters, k=pick.randrange(30))) for _ in range(2000)]
    texts += ["", " ", "\n", " a", "a ", "a  b", "a\tb c", "x" * 5000]
    encoder, tokenizer = Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for own in (texts, [*texts, "a\0 b\0", "\0"], ["", ""], []):
        ids = [np.array(e.ids, "<u4") for e in tokenizer.encode_batch(own, add_special_tokens=False)]
        assert encoder.encode_all(own) == [i.tobytes() for i in ids]
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.encode_all(["The end", ""]) == [other.whole("The end"), other.whole("")]


def test_distinct_words_are_encoded_at_once():
    encoder, calls = Encoder(VOCABULARY), []
    many = encoder.many
    encoder.many = lambda text: calls.append(text) or many(text)
    texts = [f"some word{i},\nword{i} again" * 50 for i in range(500)]
    assert encoder.encode_all(texts) == [encoder.whole(text) for text in texts]
    assert len(calls) == 1 and len(calls[0]) < 25_000


def test_other_vocabularies_are_left_to_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = Tokenizer.from_file(path).encode("The end", add_special_tokens=False).ids
    assert Encoder(path).encode("The end") == np.array(ids, "<u4").tobytes()


def test_bins_keep_all_limits():
    pick = np.random.default_rng(3)
    tokens = pick.integers(1, 100, 500)
    demands = np.stack([tokens, np.ones_like(tokens), pick.integers(0, tokens + 1)], axis=1)
    limits = np.array([100, 6, 40])
    bins = list(filled(demands, limits))
    assert sorted(i for row in bins for i in row) == list(range(500))
    for row in bins:
        total = demands[row].sum(axis=0)
        assert (total <= limits).all() or len(row) == 1


def test_bins_are_full_when_pieces_are_many():
    tokens = np.random.default_rng(4).integers(1, 2048, 4000)
    demands = np.stack([tokens, np.ones_like(tokens), tokens], axis=1)
    bins = list(filled(demands, np.array([2048, 64, 2048])))
    assert len(bins) * 2048 < 1.02 * tokens.sum()


def test_pack_returns_every_piece_once(spark):
    rows = [(i, 0, 1 + i % 50, i % 20, "x") for i in range(300)] + [(None, 0, 70, 70, None)] * 2
    given = spark.createDataFrame(rows, PIECE).selectExpr("*", "7 as sequence_id", "'x' as offset", "1 as __group")
    found = pack(given, 60, 4, 30, group_size=40).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(rows, key=str)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert len(own) == 1 or sum(r.length for r in own) <= 60
        assert len(own) == 1 or (len(own) <= 4 and sum(r.loss for r in own) <= 30)
    assert pack(spark.createDataFrame([], PIECE), 60, 4, 30).count() == 0


@pytest.mark.parametrize("limit", [16, 2048])
def test_documents_are_cut_into_all_their_tokens(documents, limit):
    pairs = [(1, None), (2, ""), (3, "some words here. " * 400), (4, "x"), (4, "x"), (None, "é  日")]
    docs = documents(pairs).selectExpr("*", "1 as start", "2 as length", "3 as loss")
    found = pack_documents(docs, VOCABULARY, max_tokens=limit).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for doc_id, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = [r for r in found if r.doc_id == doc_id]
        assert sum(r.length for r in own) == len(ids) * sum(p[0] == doc_id for p in pairs)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part.tobytes()), len(ids))
    assert pack_documents(documents([]), VOCABULARY).count() == 0


def by_hand(demands, limits):
    """The same choice over all pieces, one at a time, without shared entries."""
    waiting, bins = list(range(len(demands))), []
    shares = demands / limits
    while waiting:
        room, row = limits.copy(), []
        while True:
            fits = [i for i in waiting if (demands[i] <= room).all()]
            if not fits:
                break
            asked = shares[waiting].sum(axis=0)
            weight = asked / asked.sum() * (room / limits)
            best = max(fits, key=lambda i: (round(float(shares[i] @ weight), 12), tuple(-demands[i]), -i))
            row.append(best)
            waiting.remove(best)
            room = room - demands[best]
        if not row:
            return bins + [[i] for i in waiting]
        bins.append(row)
    return bins


def test_bins_are_those_of_brute_force():
    pick = np.random.default_rng(9)
    for limits in (np.array([100, 6, 40]), np.array([60, 3, 60]), np.array([100, 50, 12])):
        tokens = pick.integers(1, 60, 120)
        demands = np.stack([tokens, np.ones_like(tokens), pick.integers(0, tokens + 1)], axis=1)
        ours, theirs = list(filled(demands, limits)), by_hand(demands, limits)
        kinds = [sorted(map(tuple, demands[row].tolist())) for row in ours]
        alone = [k for k in kinds if (np.array(k[0]) > limits).any()]
        assert [k for k in kinds if k not in alone] == [
            k for k in (sorted(map(tuple, demands[row].tolist())) for row in theirs) if k not in alone
        ]
        # Each limit is the one that stops a bin somewhere.
        used = np.array([demands[row].sum(axis=0) for row in ours])
        assert (used <= limits).all(axis=1).sum() >= len(ours) - len(alone)


def test_there_are_groups_for_all_tasks(spark, monkeypatch):
    from shoplake.llm import packing

    monkeypatch.setattr(packing, "FULL", 50)
    rows = spark.range(400).selectExpr("cast(null as bigint) as doc_id", "0L as start", "10L as length", "9L as loss")
    found = pack(rows, 100, 64, 100).selectExpr("sequence_id", "spark_partition_id() as task")
    assert found.select("task").distinct().count() == 4
