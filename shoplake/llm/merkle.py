"""Merkle manifest of a dataset: a hash tree whose nodes keep copied hash states.

A parent's digest is the hash of its children's digests, one after the other. Before each
child goes in, the parent keeps a copy of its hash state. When a child is replaced, its parent
is not hashed from the start: the copy from before that child's slot is resumed with the
replacement and with the siblings to its right. Repeated up to the top this is the folded
root; it equals the root exactly if the leaf is as it was.

Leaves are in trees by group, and the trees' roots, in the order of the groups, are the leaves
of one more tree. Rows are numbered by a sort over ranges, so neither a large group nor many
small ones come together in one task. A tree is cut into blocks of ``FANOUT ** LEVELS`` leaves
and each block is hashed by one task, then blocks of blocks, until one node is left. On the
way back every block is given the path above it once, for all its leaves: the states before
its slots are made for that block and resumed for each of its leaves.
"""

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import stored, tasks

FANOUT = 3
LEVELS = 6
BLOCK = FANOUT**LEVELS
ROWS = 4096  # given back at a time
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree bigint, index bigint, total bigint, digest string"
PATHS = "tree bigint, index bigint, digest string, path array<string>, subroot string, root string"
LEAVES = """doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,
    folded_root string, verified boolean"""

Sibling = tuple["hashlib._Hash", bytes, bytes]  # the state before a slot, what is left and right of it


def fields_digest(fields: Sequence[Column]) -> Column:
    """Each field as its size in bytes, a colon and itself, or a hyphen if null; hashed."""
    texts = [field.cast("string") for field in fields]
    told = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(t, F.lit("-")) for t in told]), 256)


class Tree:
    """Nodes of a block, level by level, with the hash state before each of them."""

    def __init__(self, digests: list[bytes], total: int):
        self.levels = [digests]
        self.states: list[list] = []
        height = LEVELS if total > BLOCK else None
        while len(self.states) < height if height else len(self.levels[-1]) > 1:
            below, parents, states = self.levels[-1], [], []
            for at in range(0, len(below), FANOUT):
                state = hashlib.sha256()
                for digest in below[at : at + FANOUT]:
                    states.append(state.copy())
                    state.update(digest)
                parents.append(state.hexdigest().encode())
            self.states.append(states)
            self.levels.append(parents)

    def path(self, leaf: int) -> Iterator[Sibling]:
        for level, states in zip(self.levels, self.states):
            at = leaf - leaf % FANOUT
            yield states[leaf], b"".join(level[at:leaf]), b"".join(level[leaf + 1 : at + FANOUT])
            leaf //= FANOUT


def fold(digest: bytes, path: Sequence[Sibling]) -> bytes:
    """The root above, with ``digest`` in the place that the path starts from."""
    for state, _, right in path:
        resumed = state.copy()
        resumed.update(digest + right)
        digest = resumed.hexdigest().encode()
    return digest


def proof(path: Sequence[Sibling]) -> str:
    return hashlib.sha256(b"".join([left + right for _, left, right in path])).hexdigest()


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block; they come in order."""
    held, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != key:
                yield held
                held = []
            key = row["tree"], row["block"]
            held.append(row)
    if held:
        yield held


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held = []
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's top node."""
    texts, numbers = ["digest"], ["tree", "index", "total"]
    schema = pa.schema([(n, pa.int64()) for n in numbers] + [(t, pa.string()) for t in texts])

    def tops() -> Iterator[tuple]:
        for block in blocks(batches):
            tree = Tree([row["digest"].encode() for row in block], block[0]["total"])
            total = -(-block[0]["total"] // BLOCK)
            yield block[0]["tree"], block[0]["block"], total, tree.levels[-1][0].decode()

    return batched(tops(), schema)


def with_states(lefts_and_rights: list[str]) -> list[Sibling]:
    """A path as it travels, left and right siblings in turn, with its states."""
    both = [text.encode() for text in lefts_and_rights]
    return [(hashlib.sha256(left), left, right) for left, right in zip(both[::2], both[1::2])]


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, list[Sibling]]]:
    """Nodes with the row of their block and their path to the root."""
    for above, *nodes in blocks(batches):
        tree = Tree([row["digest"].encode() for row in nodes], nodes[0]["total"])
        upper = with_states(above["path"])
        for i, row in enumerate(nodes):
            yield row, above, [*tree.path(i), *upper]


def descended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node's path, for the block below it."""
    schema = pa.schema(
        [("tree", pa.int64()), ("index", pa.int64()), ("digest", pa.string())]
        + [("path", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())]
    )

    def rows() -> Iterator[tuple]:
        for row, above, path in opened(batches):
            told = [side.decode() for _, left, right in path for side in (left, right)]
            yield row["tree"], row["index"], row["digest"], told, above["subroot"], above["root"]

    return batched(rows(), schema)


def proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf's proof and folded root."""
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = pa.schema(
        [("doc_id", pa.int64()), *[(n, pa.string()) for n in names], ("verified", pa.bool_())]
    )

    def rows() -> Iterator[tuple]:
        for row, above, path in opened(batches):
            folded = fold(row["received"].encode(), path).decode()
            ends = above["subroot"], above["root"], proof(path), folded, folded == above["root"]
            yield row["doc_id"], row["digest"], *ends

    return batched(rows(), schema)


def numbered(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """The rows with ``index``, their number in their group in the given order, nulls first,
    and ``total``, the size of the group. Equal rows may change places."""
    columns = rows.columns
    keys = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + order]
    # Rows that are equal in all of these are told apart, or they would be one task's.
    salted = rows.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    keys.append(F.col("__salt").asc())
    in_order = salted.repartitionByRange(tasks(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    # The place is the task's number, and the row's number within the task.
    placed = stored(in_order.withColumn("__place", F.monotonically_increasing_id()).drop("__salt"))
    task = F.shiftright("__place", 33)
    group_of = F.col(group) if group else F.lit(0)
    # A row per task and group that it has rows of.
    runs = placed.groupBy(task.alias("__task"), group_of.alias("__group"))
    runs = runs.agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("__group")
    before = F.sum("__rows").over(whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "__task",
        "__group",
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("total"),
    )
    own = (task == F.col("__task")) & group_of.eqNullSafe(F.col("__group"))
    index = (F.col("__place") + F.col("__shift")).alias("index")
    return placed.join(runs, own).select(*columns, index, "total")


def by_block(rows: DataFrame) -> DataFrame:
    """Blocks, each in one task and in order, after the path above the block if there is one."""
    in_tasks = rows.repartition(tasks(rows.sparkSession), "tree", "block")
    return in_tasks.sortWithinPartitions("tree", "block", F.col("index").asc_nulls_first())


def in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("index") / BLOCK))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Nodes in blocks, the tops of these blocks in blocks, and so on up to one node a tree."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    levels = [nodes]
    while True:
        given = in_blocks(levels[-1].select("tree", "index", "total", "digest"))
        levels.append(stored(by_block(given).mapInArrow(climbed, NODES)))
        most = -(-most // BLOCK)
        if most <= 1:
            return levels


def below(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes in blocks, each block after the row that has its path."""
    above = paths.select("tree", F.col("index").alias("block"), "path", "subroot", "root")
    return by_block(in_blocks(nodes).unionByName(above, allowMissingColumns=True))


def manifest(
    docs: DataFrame,
    received: Column | None = None,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    A leaf is the hash of the row's ``fields``. Leaves of a group are in the order of their
    ids, null ids first, equal ids by the leaf's digest; the null group is the first one. A
    tree of a single leaf has this leaf as its subroot. ``received`` is the text as it is
    found when the manifest is checked (the text itself if it is not given): the folded root
    is computed from a leaf with that text in place of the text, and ``verified`` says whether
    it is the root. ``proof_sha256`` is the hash of all siblings from the leaf to the root.
    Nulls are told from empty texts. Repeated rows are leaves each; as they are equal, which
    of them has which place makes no difference to the set of rows. Other columns play no
    part, whatever their names. No rows in, no rows out.
    """

    def leaf(text: Column) -> Column:
        return fields_digest([text if f == text_col else F.col(f) for f in fields])

    found = F.col(text_col) if received is None else received
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(group_col).cast("string").alias("group"),
        leaf(F.col(text_col)).alias("digest"),
        F.when(~found.eqNullSafe(F.col(text_col)), leaf(found)).alias("received"),
    )
    rows = stored(rows.withColumn("received", F.coalesce("received", "digest")))
    leaves = numbered(rows, "group", ["doc_id", "digest", "received"])
    groups = stored(numbered(rows.select("group").distinct(), None, ["group"]))
    trees = groups.select(F.col("group").alias("__group"), F.col("index").alias("tree"))
    leaves = stored(leaves.join(trees, F.col("group").eqNullSafe(F.col("__group"))).drop("group", "__group"))

    lower = climb(leaves)
    size = groups.select(F.col("index").alias("at"), F.col("total").alias("groups"))
    subroots = lower[-1].join(size, F.col("tree") == F.col("at"))
    subroots = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("index"), F.col("groups").alias("total"), "digest"
    )
    upper = climb(stored(subroots))

    none = F.array().cast("array<string>")
    paths = upper[-1].select(
        "tree", "index", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")
    )
    for nodes in reversed(upper[:-1]):
        paths = stored(below(nodes, paths).mapInArrow(descended, PATHS))
    zero = F.lit(0).cast("bigint")
    paths = paths.select(F.col("index").alias("tree"), zero.alias("index"), "path", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(lower[1:-1]):
        paths = stored(below(nodes, paths).mapInArrow(descended, PATHS))
    return below(leaves, paths).mapInArrow(proven, LEAVES)


def without_line_breaks(docs: DataFrame) -> Column:
    """Texts as they come back damaged: where 2 divides the id's checksum, without \\n."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


# The checksum of the decimal id, bit by bit; then both trees upwards, and per leaf its
# siblings by level, from which the proof and, level by level, the folded root follow.
SQL = """
with recursive hits as (
    select *, xor(list_reduce(list_prepend(4294967295::bigint,
            list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda x, c: list_reduce(list_prepend(xor(x, c), range(8)),
            lambda v, k: xor(v >> 1, case when v & 1 = 1 then 3988292384::bigint else 0::bigint end))
        ), 4294967295) % 2 = 0 as hit
    from documents),
told as (
    select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
        replace(text, chr(10), '') as cleared
    from hits),
hashed as (
    select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        case when hit then sha256(head || coalesce(strlen(cleared) || ':' || cleared, '-'))
            else sha256(head || coalesce(strlen(text) || ':' || text, '-')) end as received
    from told),
leaves as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
        count(*) over (partition by source) as n,
        dense_rank() over (order by source nulls first) - 1 as tree,
        row_number() over () as row_id
    from hashed),
lower_nodes as (
    select tree, 0 as level, i, leaf as digest, n from leaves
    union all
    select tree, level + 1, i // 3, sha256(string_agg(digest, '' order by i)), (any_value(n) + 2) // 3
    from lower_nodes where n > 1 group by tree, level, i // 3),
subroots as (
    select tree, level as height, digest as subroot, (select count(distinct tree) from leaves) as n
    from lower_nodes where n = 1),
upper_nodes as (
    select 0 as level, tree as i, subroot as digest, n from subroots
    union all
    select level + 1, i // 3, sha256(string_agg(digest, '' order by i)), (any_value(n) + 2) // 3
    from upper_nodes where n > 1 group by level, i // 3),
top as (select digest as root from upper_nodes where n = 1),
siblings as (
    select l.row_id, u.level, u.i, u.digest, u.i < l.i // (3 ** u.level)::bigint as is_left
    from leaves l join lower_nodes u on l.tree = u.tree and u.n > 1
        and u.i // 3 = l.i // (3 ** (u.level + 1))::bigint and u.i <> l.i // (3 ** u.level)::bigint
    union all
    select l.row_id, s.height + u.level, u.i, u.digest, u.i < l.tree // (3 ** u.level)::bigint
    from leaves l join subroots s using (tree) join upper_nodes u on u.n > 1
        and u.i // 3 = l.tree // (3 ** (u.level + 1))::bigint
        and u.i <> l.tree // (3 ** u.level)::bigint),
heights as (
    select l.row_id, l.received, s.subroot,
        s.height + (select max(level) from upper_nodes) as height
    from leaves l join subroots s using (tree)),
sides as (
    select row_id, level, coalesce(string_agg(digest, '' order by i) filter (is_left), '') as l,
        coalesce(string_agg(digest, '' order by i) filter (not is_left), '') as r
    from siblings group by row_id, level),
folds as (
    select row_id, 0 as level, received as digest, height from heights
    union all
    select f.row_id, f.level + 1, sha256(coalesce(s.l, '') || f.digest || coalesce(s.r, '')), f.height
    from folds f left join sides s on s.row_id = f.row_id and s.level = f.level
    where f.level < f.height),
proofs as (select row_id, string_agg(digest, '' order by level, i) as told from siblings group by row_id)
select l.doc_id, l.leaf, h.subroot, top.root, sha256(coalesce(p.told, '')) as proof_sha256,
    f.digest as folded_root, f.digest = top.root as verified
from leaves l join heights h using (row_id) join folds f on f.row_id = l.row_id and f.level = f.height
    left join proofs p on p.row_id = l.row_id cross join top
"""
