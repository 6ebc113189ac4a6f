import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shoplake.llm import merkle
from shoplake.llm.merkle import Tree, fold, manifest, proof, without_line_breaks

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """The digest above the nodes, and the siblings of each of them by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            at = place - place % 3
            path.append((nodes[at:place], nodes[place + 1 : at + 3]))
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        places = [p // 3 for p in places]
    return nodes[0], paths


def by_hand(rows, received):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    ordered = sorted(groups.items(), key=lambda g: (g[0] is not None, (g[0] or "").encode()))
    trees = []
    for _, own in ordered:
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *climb([leaf(r, r[1]) for r in own])))
    root, upper = climb([t[1] for t in trees])
    found = []
    for (own, subroot, paths), above in zip(trees, upper):
        for row, path in zip(own, paths):
            digest = leaf(row, received(row))
            for left, right in path + above:
                digest = sha(*left, digest, *right)
            told = sha(*[d for left, right in path + above for d in left + right])
            found.append((row[0], leaf(row, row[1]), subroot, root, told, digest, digest == root))
    return sorted(found, key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_rows_match_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    pick = random.Random(2)
    sources = ["hot"] * 6 + ["a", "b", "é", "Z", "", None, "日"] + [f"s{i}" for i in range(20)]
    texts = ["", None, "a\nb", "plain", "\n", "x\n" * 50_000, "é"]
    rows = [
        (pick.choice([None, i, i, i, 7]), pick.choice(texts), pick.choice(["en", None]), pick.choice(sources), i % 5)
        for i in range(160)
    ]
    rows += [rows[3]] * 4 + [(900, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    docs = docs.selectExpr("*", "'x' as leaf", "1 as root", "2 as tree", "3 as index", "'g' as `group`")
    cleared = F.replace("text", F.lit("\n"), F.lit(""))
    found = manifest(docs, received=F.when(F.col("n_chars") < 3, cleared).otherwise(F.col("text")))

    def received(row):
        return row[1].replace("\n", "") if row[1] and row[4] is not None and row[4] < 3 else row[1]

    assert sorted(map(tuple, found.collect()), key=str) == by_hand(rows, received)


def test_a_single_row_is_its_own_root(spark):
    docs = spark.createDataFrame([(1, "t", "en", "s", 1)], SCHEMA)
    (row,) = manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == sha("")


def test_no_rows(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_states_are_resumed_not_made_again():
    digests = [sha(str(i)).encode() for i in range(20)]
    tree = Tree(digests, 20)
    root = tree.levels[-1][0]
    for i, digest in enumerate(digests):
        path = list(tree.path(i))
        assert fold(digest, path) == fold(digest, path) == root
        assert fold(sha("other").encode(), path) != root
        unused = [(state, b"never read", right) for state, _, right in path]
        assert fold(digest, unused) == root
        assert proof(path) == sha(*[(a + b).decode() for _, a, b in path])


def test_damage_is_only_where_the_checksum_says(spark):
    docs = spark.createDataFrame([(i, "a\nb", "en", "s", 3) for i in range(40)], SCHEMA)
    found = manifest(docs, received=without_line_breaks(docs)).collect()
    hit = {r.i for r in spark.range(40).selectExpr("id as i", "crc32(string(id)) % 2 = 0 as hit").where("hit").collect()}
    assert {r.doc_id for r in found if not r.verified} == hit
    assert 0 < len(hit) < 40
