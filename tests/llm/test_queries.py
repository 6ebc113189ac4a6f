"""The registered queries: against their SQL where there is one, else their form."""

import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harness.compare import connect
from shoplake.llm.queries import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in places) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_rows_match_the_sql(spark, name):
    df = queries()[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())


def test_packing_covers_every_document(spark):
    pieces = defaultdict(list)
    for r in queries()["op10_packing"](spark, SF_DIR).collect():
        pieces[r.doc_id].append(r)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert pieces.keys() == {d.doc_id for d in docs}
    for d in docs:
        ids = np.array([*tokenizer.encode(d.text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[d.doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) == own[0].doc_tokens == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_near_duplicates_match_brute_force(spark):
    found = {r.doc_id: r for r in queries()["op7_near_dedup"](spark, SF_DIR).collect()}
    sets = {}
    for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        words = d.text.encode().lower().split()
        sets[d.doc_id] = set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)}
    up = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = up[a], up[b]
                up = {i: min(x, y) if u in (x, y) else u for i, u in up.items()}
    assert {i: r.component_id for i, r in found.items()} == up
    assert all(found[i].n_shingles == len(s) for i, s in sets.items())


def test_every_document_has_a_row_in_scores_and_rates(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name in ("op3_toxicity", "op5_mixing"):
        df = queries()[name](spark, SF_DIR)
        assert df.select("doc_id").distinct().count() == df.count() == docs


def test_scan_finds_the_planted_keys(spark):
    found = queries()["op1_secret_scan"](spark, SF_DIR)
    assert {"doc_id", "word_no", "length", "begins", "sha256", "score", "is_secret"} == set(found.columns)
    text = " ".join(d.text for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert found.where("is_secret").count() >= text.count('token = "')
