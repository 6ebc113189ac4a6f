"""Near duplicates: circulant MinHash, bands, and an exact check of every link.

A document is the set of its distinct word shingles, as 64-bit hashes. Two permutations give
the whole signature: the first scatters the shingles over 2^32 places, and coordinate k is the
smallest value of the second, shifted round by k, over these places. ``ROWS`` coordinates make
a band; documents that agree in a band meet in its bucket. A pair of Jaccard similarity s
misses all buckets with probability (1 - s^ROWS)^BANDS, 1.3e-7 at 0.8.

Documents with the same set are one class, with its smallest id. Links are sought in three
steps, so that a bucket of m near copies takes some m comparisons, and no pairs within a group
are listed:
1. every class with the busiest class it meets anywhere (the one that meets most others);
2. with the busiest class of each of its buckets;
3. where that leaves more than one component in a bucket: with all classes that have the same
   busiest class, and with classes of another one in the same bucket. Classes of the same
   busiest class are compared in blocks of ``BLOCK`` by ``BLOCK``, each within a task, which
   returns links only. Where they are more than a block, only classes that share one of their
   rarest shingles are compared (a prefix filter, which loses no link), unless so many do that
   the blocks are less work.
Steps 2 and 3 leave out pairs that the links found so far already connect, and sizes that rule
a link out. Each pair is confirmed on the two full sets.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import cut, mixed, short_batches, slices, stored, words
from shoplake.llm.graph import components
from shoplake.llm.rolling import Joined

ROWS, BANDS = 5, 40
BLOCK = 512  # classes
NUMBERED = -(1 << 62)  # from here down numbers stand for classes, not ids of documents
STEP = 1 << 21  # bytes of text at a time, about

SIGNED = "doc_id bigint, n_shingles bigint, key binary, bands array<bigint>, mark bigint"
SETS = "doc_id bigint, shingles array<bigint>"


def shingled(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = Joined.of([words(t.lower() if t and t.isascii() else lowered(t)) for t in texts])
    starts = joined.windows(size)
    hashes = joined.hashes(starts, size)
    cuts = np.searchsorted(starts, joined.begin)
    ends = np.searchsorted(starts, joined.begin + joined.counts)
    found = [np.unique(hashes[a:b]) for a, b in zip(cuts, ends)]
    for i in np.flatnonzero((joined.counts > 0) & (joined.counts < size)):
        found[i] = joined.hashes(joined.begin[i : i + 1], int(joined.counts[i]))
    return found


def lowered(text: str | None) -> str:
    # Bytes change A-Z only.
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def scrambled(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` coordinates for each set; the sets must not be empty."""
    begin = np.cumsum([0] + [len(s) for s in sets])[:-1]
    # The hashes are scrambled already: their upper half is the first permutation's place.
    places = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    rows = np.empty((len(sets), size), dtype=np.uint32)
    for k in range(size):
        rows[:, k] = np.minimum.reduceat(scrambled(places - np.uint32(k)), begin)
    return rows


def banded(rows: np.ndarray, per_band: int) -> np.ndarray:
    """One 64-bit number per band, that names the band as well."""
    parts = rows.reshape(len(rows), -1, per_band).astype(np.uint64)
    found = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for i in range(per_band):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return found.view(np.int64)


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signed(size: int, per_band: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part, texts in slices(batch.column(1), STEP):
                sets = shingled(texts, size)
                full = [s for s in sets if len(s)]
                keys = iter(banded(signatures(full, per_band * bands), per_band) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[part],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                        batch.column(2)[part],
                    ],
                    names=["doc_id", "n_shingles", "key", "bands", "mark"],
                )

    return run


def as_sets(size: int):
    """Rows of ``class, text, key`` to the sets that have the key, one for each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for part, texts in slices(batch.column(1), STEP):
                found: dict[tuple[int, bytes], np.ndarray] = {}
                for doc_id, key, hashes in zip(ids[part], keys[part], shingled(texts, size)):
                    if digest(hashes) == key and (doc_id, key) not in seen:
                        found[doc_id, key] = hashes.view(np.int64)
                seen.update(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id for doc_id, _ in found], pa.int64()),
                        pa.array(list(found.values()), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "shingles"],
                )

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    ours = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one"))
    theirs = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(ours, "a").join(theirs, "b")
    common = F.size(F.array_intersect("one", "two"))
    measured = both.select("a", "b", common.alias("i"), (F.size("one") + F.size("two") - common).alias("u"))
    return measured.where(100 * F.col("i") >= percent * F.col("u")).select("a", "b")


def linked_in_block(percent: int):
    """Links of the probes of a block to its targets, one for each component they lead to."""

    def run(block: pa.Table) -> pa.Table:
        classes, parts = (block.column(n).to_numpy() for n in ("class", "component"))
        probing = block.column("probe").to_numpy(zero_copy_only=False)
        sets = block.column("shingles").combine_chunks()
        ends, tokens = sets.offsets.to_numpy(), sets.values.to_numpy()
        sizes = np.diff(ends)
        targets = np.flatnonzero(~probing)
        owner = np.repeat(np.arange(len(targets)), sizes[targets])
        pool = np.concatenate([tokens[ends[t] : ends[t + 1]] for t in targets] or [tokens[:0]])
        order = np.argsort(pool, kind="stable")
        pool, owner = pool[order], owner[order]
        links = []
        for p in np.flatnonzero(probing):
            own = tokens[ends[p] : ends[p + 1]]
            low, high = np.searchsorted(pool, own, "left"), np.searchsorted(pool, own, "right")
            many = high - low
            at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            common = np.bincount(owner[at], minlength=len(targets))
            either = sizes[p] + sizes[targets] - common
            near = targets[(100 * common >= percent * either) & (parts[targets] != parts[p])]
            _, one = np.unique(parts[near], return_index=True)
            links += [(int(classes[near[i]]), int(classes[p])) for i in one]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The shingles by which ``class, component, hub`` are looked up within their hub.

    A set's shingles are ranked from the rarest in its hub to the commonest. Of two sets that are
    similar enough, the first shingle they share is among the first ``n - percent % of n + 1`` of
    the larger one, and even among the first ``n - 2 * percent / (100 + percent) of n + 1`` of
    the smaller one: these are marked ``short``. Only shingles of several components are given.
    """
    own = sets.select(F.col("doc_id").alias("class"), "shingles")
    each = members.select("class", "component", "hub").join(own, "class")
    each = each.select("class", "component", "hub", F.explode("shingles").alias("token"))
    several = F.min("component") != F.max("component")
    often = each.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("often"), several.alias("several"))
    ranked = each.join(often, ["hub", "token"]).groupBy("hub", "class", "component").agg(
        F.sort_array(F.collect_list(F.struct("often", "token", "several"))).alias("tokens")
    )
    n = F.size("tokens")
    long = n - F.expr(f"int(({percent} * size(tokens) + 99) div 100)") + 1
    short = n - F.expr(f"int(({2 * percent} * size(tokens) + {99 + percent}) div {100 + percent})") + 1
    first = F.posexplode(F.slice("tokens", F.lit(1), long)).alias("place", "token")
    looked = ranked.select("hub", "class", "component", n.alias("n"), short.alias("short"), first)
    return looked.where("token.several").select(
        "hub", "class", "component", "n", "place", F.col("token.token").alias("token"),
        (F.col("place") < F.col("short")).alias("short"),
    )


def pairs_by_prefix(looked: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components that share a prefix shingle in their hub, where
    sizes and places leave room for enough others."""
    small = looked.where("short").select(
        "hub", "token", *[F.col(c).alias(f"{c}_") for c in ("class", "component", "n", "place")]
    )
    room = F.least(F.col("n") - F.col("place"), F.col("n_") - F.col("place_"))
    close = (100 + percent) * room >= percent * (F.col("n") + F.col("n_"))
    ordered = F.struct("n_", "class_") < F.struct("n", "class")
    met = looked.join(small, ["hub", "token"])
    met = met.where((F.col("component") != F.col("component_")) & ordered & close)
    return met.select(F.col("class").alias("a"), F.col("class_").alias("b")).distinct()


def linked_in_hubs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between ``class, component, hub, hub_component`` of the same hub.

    Hubs of more than a block of classes go by prefixes where these name fewer pairs than the
    blocks would move sets; the others go by blocks.
    """
    sizes = members.groupBy("hub").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("m")
    )
    each = cut(members.join(sizes, "hub"))
    large = each.where("blocks > 1")
    if large.isEmpty():
        return linked_by_blocks(each, sets, percent)
    looked = stored(prefixes(large, sets, percent))
    met = looked.groupBy("hub", "token").agg(
        (F.count(F.lit(1)) * F.count_if("short")).alias("pairs")
    )
    met = met.groupBy("hub").agg(F.sum("pairs").alias("pairs"))
    hubs = large.select("hub", "blocks", "m").distinct().join(met, "hub", "left")
    sparse = cut(hubs.where("2 * coalesce(pairs, 0) <= m * blocks").select("hub"))
    found = confirmed(pairs_by_prefix(looked.join(sparse, "hub", "left_semi"), percent), sets, percent)
    rest = each.join(sparse, "hub", "left_anti")
    return found.unionByName(linked_by_blocks(rest, sets, percent))


def linked_by_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between ``class, component, hub, hub_component, blocks`` of the same hub.

    Of two classes in different components one at least is not in the hub's, so only those
    are probes; they meet all others of their hub.
    """
    shingles = sets.select(F.col("doc_id").alias("class"), "shingles")
    each = members.join(shingles, "class")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    probe = F.col("component") != F.col("hub_component")
    columns = ["hub", "class", "component", "shingles"]
    probes = each.where(probe).select(*columns, own.alias("i"), other.alias("j"))
    targets = each.select(*columns, own.alias("j"), other.alias("i"))
    both = probes.withColumn("probe", F.lit(True)).unionByName(targets.withColumn("probe", F.lit(False)))
    blocks = both.groupBy("hub", "i", "j")
    return blocks.applyInArrow(linked_in_block(percent), "a bigint, b bigint")


def _near_groups(
    docs: DataFrame, shingle: int, percent: int, rows: int, bands: int, id_col: str, text_col: str
) -> DataFrame:
    """As ``near_groups``, with the mark of each row's text."""
    short_batches(docs.sparkSession)
    doc_id, text = F.col(id_col).cast("bigint"), F.col(text_col).cast("string")
    given = docs.select(doc_id.alias("doc_id"), text.alias("text"), text_mark(text).alias("mark"))
    read = stored(given.mapInArrow(signed(shingle, rows, bands), SIGNED))
    linkable = read.where("doc_id is not null and n_shingles > 0")
    classes = linkable.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # A class goes by its smallest id. Rows that repeat an id may be of several classes; all but
    # one of these go by a number of their own.
    place = F.row_number().over(Window.partitionBy("least").orderBy("key"))
    number = F.lit(NUMBERED) - F.monotonically_increasing_id()
    classes = classes.withColumn("place", place)
    classes = classes.withColumn("class", F.when(F.col("place") == 1, F.col("least")).otherwise(number))
    classes = stored(classes.drop("place"))
    buckets = classes.select(F.explode("bands").alias("bucket"), "class", "n")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = stored(buckets.join(shared, "bucket"))
    busy = met.groupBy("class").agg(F.sum("m").alias("meets"))
    ranked = met.select("bucket", "class", "n").join(busy, "class")
    hub = F.max(F.struct("meets", (-F.col("class")).alias("least"))).alias("hub")
    hubs = ranked.groupBy("bucket").agg(hub).select("bucket", "hub.meets", (-F.col("hub.least")).alias("a"))
    starred = cut(
        ranked.select("bucket", F.col("class").alias("b")).join(hubs, "bucket").where("a <> b")
        .groupBy("a", "b").agg(F.max("meets").alias("meets"))
    )

    wanted = classes.join(met.select("class").distinct(), "class", "left_semi")
    wanted = wanted.select(F.col("least").alias("doc_id"), "class", "key")
    texts = given.join(wanted, "doc_id").select("class", "text", "key")
    sets = stored(texts.mapInArrow(as_sets(shingle), SETS))

    first = starred.groupBy("b").agg(F.max(F.struct("meets", (-F.col("a")).alias("a"))).alias("hub"))
    links = cut(confirmed(first.select((-F.col("hub.a")).alias("a"), "b"), sets, percent))

    # Pairs that go to the same first hub, or to each other, are connected already.
    one = links.select(F.col("a").alias("ha"), F.col("b").alias("a"))
    two = links.select(F.col("a").alias("hb"), "b")
    pairs = starred.select("a", "b").join(one, "a", "left").join(two, "b", "left")
    pairs = pairs.where(F.coalesce("ha", "a") != F.coalesce("hb", "b")).where("hb is null or hb <> a")
    more = cut(confirmed(pairs.select("a", "b"), sets, percent))
    links = links.unionByName(more)
    found = components(links)

    # Classes of buckets in which more than one component is left.
    known = found.select(F.col("node").alias("class"), "component")
    hub_of = first.select(F.col("b").alias("class"), (-F.col("hub.a")).alias("hub"))
    members = met.select("bucket", "class", "n")
    members = members.join(known, "class", "left").join(hub_of, "class", "left").withColumns(
        {"component": F.coalesce("component", "class"), "hub": F.coalesce("hub", "class")}
    )
    mixed_ = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = cut(members.join(mixed_.where("x <> y").select("bucket"), "bucket", "left_semi"))
    of_hub = known.select(F.col("class").alias("hub"), F.col("component").alias("hub_component"))
    single = open_.select("class", "component", "hub").distinct().join(of_hub, "hub", "left")
    single = single.withColumn("hub_component", F.coalesce("hub_component", "hub"))
    blocked = linked_in_hubs(single, sets, percent)
    # Of two classes with other hubs one at least has not the bucket's commonest.
    common = open_.groupBy("bucket", "hub").agg(F.count(F.lit(1)).alias("m"))
    common = common.groupBy("bucket").agg(F.max(F.struct("m", "hub")).alias("most"))
    other = open_.join(common, "bucket").where("hub <> most.hub")
    other = other.select("bucket", *[F.col(c).alias(f"{c}_") for c in ("class", "n", "component", "hub")])
    close = (100 * F.least("n", "n_") >= percent * F.greatest("n", "n_")) & (
        (F.col("component") != F.col("component_")) & (F.col("hub") != F.col("hub_"))
    )
    rest = open_.join(other, "bucket").where(close)
    rest = rest.select(
        F.least("class", "class_").alias("a"), F.greatest("class", "class_").alias("b")
    ).distinct()
    last = cut(confirmed(rest, sets, percent).unionByName(blocked))
    if not last.isEmpty():
        found = components(links.unionByName(last))

    linked = found.select(F.col("node").alias("class"), F.col("component").alias("first_id"))
    if not classes.where(F.col("class") <= NUMBERED).isEmpty():
        # Components may have been named after a number: they take their smallest id instead.
        least = linked.join(classes.select("class", "least"), "class").groupBy("first_id")
        least = least.agg(F.min("least").alias("least"))
        linked = linked.join(least, "first_id").select("class", F.col("least").alias("first_id"))
    of_class = classes.select("key", "class", "least").join(linked, "class", "left")
    of_class = of_class.select("key", F.coalesce("first_id", "least").alias("least"))
    joined = read.select("doc_id", "n_shingles", "key", "mark").join(of_class, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "mark",
    )


def text_mark(text: Column) -> Column:
    """Tells the texts of rows that repeat an id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_groups(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every input row.

    Words are lower-cased (A-Z) runs of other than ASCII white space; texts with fewer words
    than a shingle count as one shingle. Documents are linked if 100 times the common shingles
    are at least ``percent`` times all; a component is what links connect, and its smallest id
    is kept. Null and empty texts have no shingles and are linked with nothing. Rows that
    repeat an id are judged by their own text each. A null id is linked with nothing, has a null component and is kept. Other
    columns play no part. No rows in, no rows out.
    """
    return _near_groups(docs, shingle, percent, rows, bands, id_col, text_col).drop("mark")


def drop_near_copies(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents that stay, with all their columns: the smallest id of each component.

    Rows that repeat an id stay or go by their own text each. Nulls and the like are as in
    ``near_groups``.
    """
    groups = _near_groups(docs, shingle, percent, ROWS, BANDS, id_col, text_col)
    gone = groups.where("not kept").select("doc_id", "mark").distinct()
    # As one column, so that no name of theirs meets one of these.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        text_mark(F.col(text_col).cast("string")).alias("mark"),
    )
    return rows.join(gone, ["doc_id", "mark"], "left_anti").select("row.*")
