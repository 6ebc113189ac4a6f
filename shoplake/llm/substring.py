"""Removal of repeated passages: exact word windows, found with super-k-mers.

The minimiser of a window is the smallest hash among its ``MMER``-word runs. Neighbouring
windows mostly share it, and windows with the same words always do, so a text is cut where the
minimiser changes, and each cut, a super-k-mer, travels as one string to the minimiser's
bucket: a window costs some three words, not thirteen. A bucket is one task; it sorts the
hashes of its windows, compares the words of those with equal hashes, and finds which windows
start in a document with a smaller id.

Two things keep hot passages from piling up. Windows that a smaller document of the same
chunk has are settled there and don't travel, so a chunk sends any window once. And a
minimiser that a ``1 / (4 * buckets)`` share of all super-k-mers have, counted over the whole
input beforehand, no longer names a bucket: its windows go one by one, by their own hash.
"""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import mixed, slices, stored, tasks, words
from shoplake.llm.rolling import Joined

MMER = 2
STEP = 3 << 20  # bytes of text at a time, about
BUCKET = 100_000  # super-k-mers
LOCAL = 2000  # a minimiser is counted in a chunk if it has this share there: 1 / LOCAL

CUTS = "bucket int, doc_id bigint, key bigint, data binary"
SPANS = "doc_id bigint, key bigint, data binary"


class Chunk:
    """Windows of some texts with their minimisers."""

    def __init__(self, texts: list[str | None], size: int):
        self.joined = Joined.of([words(t) for t in texts])
        self.starts = self.joined.windows(size)
        self.minimiser = np.zeros(0, dtype=np.uint64)
        if len(self.starts):
            short = min(MMER, size)
            at = self.joined.windows(short)
            runs = np.full(len(self.joined.text), np.iinfo(np.uint64).max, dtype=np.uint64)
            runs[at] = self.joined.hashes(at, short)
            self.minimiser = sliding_minimum(runs, size - short + 1)[self.starts]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def run_starts(starts: np.ndarray, minimiser: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Which windows begin a super-k-mer; windows marked ``single`` are one each."""
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = (starts[1:] != starts[:-1] + 1) | (minimiser[1:] != minimiser[:-1])
    return begins | single


def repeated(hashes: np.ndarray, rank: np.ndarray, text) -> np.ndarray:
    """Which windows also occur with a smaller rank. ``text(i)`` gives the words of a window:
    those with equal hashes are compared."""
    found = np.zeros(len(hashes), dtype=bool)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(order)])
    sizes = np.diff(np.append(begins, len(order)))
    least = np.minimum.reduceat(rank[order], begins) if len(order) else rank[:0]
    most = np.maximum.reduceat(rank[order], begins) if len(order) else rank[:0]
    for begin, size, low in zip(*(x[(sizes > 1) & (most > least)].tolist() for x in (begins, sizes, least))):
        own = order[begin : begin + size]
        same = text(own[0])
        if all(text(i) == same for i in own):
            found[own] = rank[own] > low
            continue
        groups: dict[bytes, list[int]] = {}
        for i in own:
            groups.setdefault(text(i), []).append(i)
        for group in map(np.array, groups.values()):
            found[group] = rank[group] > rank[group].min()
    return found


# Of each super-k-mer: its document, the checksum of the text, first word and windows.
KINDS = [np.dtype(k) for k in ("<i8", "<u4", "<i4", "<i4")]


def packed(text: bytes, *numbers: np.ndarray) -> bytes:
    columns = [n.astype(kind).tobytes() for n, kind in zip(numbers, KINDS)]
    whole = struct.pack("<q", len(numbers[0])) + b"".join(columns) + text
    return zstandard.ZstdCompressor(level=3).compress(whole)


def unpacked(data: bytes) -> tuple[bytes, list[np.ndarray]]:
    whole = zstandard.ZstdDecompressor().decompress(data)
    (n,), at, numbers = struct.unpack_from("<q", whole), 8, []
    for kind in KINDS:
        numbers.append(np.frombuffer(whole, dtype=kind, count=n, offset=at).astype(np.int64))
        at += n * kind.itemsize
    return whole[at:], numbers


def spans_by_document(doc_id: np.ndarray, key: np.ndarray, place: np.ndarray) -> Iterator[tuple]:
    """Window places of a document as ``start, count`` pairs of 64-bit numbers."""
    if not len(place):
        return
    order = np.lexsort((place, key, doc_id))
    doc_id, key, place = doc_id[order], key[order], place[order]
    fresh = np.concatenate([[True], (doc_id[1:] != doc_id[:-1]) | (key[1:] != key[:-1])])
    begins = np.flatnonzero(fresh | np.concatenate([[True], place[1:] > place[:-1] + 1]))
    last = place[np.append(begins[1:], len(place)) - 1]
    pairs = np.stack([place[begins], last - place[begins] + 1], axis=1)
    first = np.flatnonzero(fresh[begins])
    for a, b in zip(first, np.append(first[1:], len(begins))):
        yield int(doc_id[begins[a]]), int(key[begins[a]]), pairs[a:b].astype(np.int64).tobytes()


def counted(size: int):
    """Super-k-mers in all (minimiser null) and of the frequent minimisers of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0), STEP):
                chunk = Chunk(texts, size)
                none = np.zeros(len(chunk.starts), dtype=bool)
                own = chunk.minimiser[run_starts(chunk.starts, chunk.minimiser, none)]
                values, counts = np.unique(own, return_counts=True)
                often = counts * LOCAL >= len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None, *values[often].view(np.int64).tolist()], pa.int64()),
                        pa.array([len(own), *counts[often].tolist()], pa.int64()),
                    ],
                    names=["minimiser", "n"],
                )

    return run


def cut_up(size: int, buckets: int, hot: list[int]):
    """Super-k-mers packed by bucket, and the spans settled within the chunk (``doc_id`` set)."""
    hot_values = np.array(hot, dtype=np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy() for i in (0, 1))
            for part, texts in slices(batch.column(2), STEP):
                rows = list(cut_chunk(ids[part], keys[part], texts))
                columns = zip(*rows) if rows else [()] * 4
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                    names=["bucket", "doc_id", "key", "data"],
                )

    def cut_chunk(ids: np.ndarray, keys: np.ndarray, texts: list[str]) -> Iterator[tuple]:
        # Of rows that repeat id and text, one is enough.
        _, once = np.unique(np.stack([ids, keys]), axis=1, return_index=True)
        ids, keys, texts = ids[once], keys[once], [texts[i] for i in once]
        chunk = Chunk(texts, size)
        joined, starts = chunk.joined, chunk.starts
        if not len(starts):
            return
        hashes = joined.hashes(starts, size)
        first, last = joined.first[starts], joined.last[starts + size - 1]
        buffer = joined.buffer
        known = repeated(hashes, ids[joined.text[starts]], lambda i: buffer[first[i] : last[i]])
        settled = starts[known]
        docs = joined.text[settled]
        for doc_id, key, data in spans_by_document(ids[docs], keys[docs], joined.place[settled]):
            yield (doc_id ^ key) % buckets, doc_id, key, data

        starts, hashes, minimiser = starts[~known], hashes[~known], chunk.minimiser[~known]
        single = np.isin(minimiser, hot_values)
        begins = np.flatnonzero(run_starts(starts, minimiser, single))
        ends = np.append(begins[1:], len(starts))
        name = np.where(single, hashes, minimiser)[begins]
        bucket = (mixed(name, 1) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begins, ends, bucket = begins[order], ends[order], bucket[order]
        docs, place = joined.text[starts[begins]], joined.place[starts[begins]]
        low, high = joined.first[starts[begins]], joined.last[starts[ends - 1] + size - 1]
        fresh = np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)]
        cuts = np.append(np.flatnonzero(fresh), len(bucket))
        for a, b in zip(cuts[:-1], cuts[1:]):
            text = b" ".join([buffer[x:y] for x, y in zip(low[a:b].tolist(), high[a:b].tolist())])
            data = packed(text, ids[docs[a:b]], keys[docs[a:b]], place[a:b], (ends - begins)[a:b])
            yield int(bucket[a]), None, None, data

    return run


def matched(size: int):
    """The spans of a bucket's windows that start in a smaller document as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, buffers = [], []
        for batch in batches:
            settled = batch.filter(batch.column("doc_id").is_valid())
            yield settled.select(["doc_id", "key", "data"])
            waiting = batch.filter(batch.column("doc_id").is_null())
            for data in waiting.column("data"):
                text, (ids, keys, place, count) = unpacked(data.as_py())
                joined = Joined(text, count + size - 1)
                starts = joined.windows(size)
                own = joined.text[starts]
                parts.append(
                    (
                        joined.hashes(starts, size),
                        ids[own],
                        keys[own],
                        place[own] + joined.place[starts],
                        np.full(len(starts), len(buffers), dtype=np.int32),
                        joined.first[starts],
                        (joined.last[starts + size - 1] - joined.first[starts]).astype(np.int32),
                    )
                )
                buffers.append(text)
        if not parts:
            return
        hashes, ids, keys, place, source, first, length = map(np.concatenate, zip(*parts))
        parts.clear()
        found = repeated(hashes, ids, lambda i: buffers[source[i]][first[i] : first[i] + length[i]])
        rows = list(spans_by_document(ids[found], keys[found], place[found]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=["doc_id", "key", "data"]
            )

    return run


def without(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                own = words(text.as_py())
                kept, removed = own, 0
                if spans.is_valid and len(spans):
                    gone = np.zeros(len(own), dtype=bool)
                    for data in spans.as_py():
                        for start, count in np.frombuffer(data, dtype=np.int64).reshape(-1, 2).tolist():
                            gone[start : start + count + size - 1] = True
                    removed = int(gone.sum())
                    kept = [w for w, g in zip(own, gone.tolist()) if not g]
                rows.append((len(own), removed, b" ".join(kept).decode("utf-8", "surrogatepass")))
            n, removed, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def without_repeats(
    docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every input row.

    Words are runs of other than ASCII white space, unchanged. A word goes if a window of
    ``size`` words covers it whose words also start in a document with a smaller id; windows
    are judged on the input. ``kept`` has the other words, one space between. Null and empty
    texts have no words. A null id is larger than any other, and two null ids are equal. Rows
    that repeat an id take nothing from each other, and are told apart by a checksum. Other columns play no part. No rows in,
    no rows out.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(2**63 - 1)).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.crc32(F.col("text").cast("binary")))
    counts = stored(given.select("text").mapInArrow(counted(size), "minimiser bigint, n bigint"))
    total = counts.where("minimiser is null").agg(F.sum("n")).first()[0] or 0
    buckets = max(tasks(spark), -(-total // BUCKET))
    often = counts.where("minimiser is not null").groupBy("minimiser").agg(F.sum("n").alias("n"))
    # No more than four per bucket can have so large a share.
    hot = [r[0] for r in often.where(F.col("n") * 4 * buckets >= total).select("minimiser").collect()]
    cuts = given.select("doc_id", "key", "text").mapInArrow(cut_up(size, buckets, hot), CUTS)
    spans = cuts.repartitionById(buckets, "bucket").mapInArrow(matched(size), SPANS)
    spans = stored(spans).groupBy("doc_id", "key").agg(F.collect_list("data").alias("spans"))
    joined = given.join(spans, ["doc_id", "key"], "left").select(F.col("id").alias("doc_id"), "text", "spans")
    return joined.mapInArrow(without(size), "doc_id bigint, n_words bigint, n_removed bigint, kept string")


SQL = """
with texts as (select doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
placed as (select doc_id, unnest(ws) as w, unnest(range(len(ws))) as i, len(ws) as n from texts),
windows as (select *, case when i + 13 <= n then concat_ws(' ', w, lead(w, 1) over d,
    lead(w, 2) over d, lead(w, 3) over d, lead(w, 4) over d, lead(w, 5) over d, lead(w, 6) over d,
    lead(w, 7) over d, lead(w, 8) over d, lead(w, 9) over d, lead(w, 10) over d,
    lead(w, 11) over d, lead(w, 12) over d) end as x
    from placed window d as (partition by doc_id order by i)),
judged as (select *, x is not null and min(doc_id) over (partition by x) < doc_id as again
    from windows),
covered as (select *, max(case when again then 1 else 0 end) over (partition by doc_id
    order by i rows between 12 preceding and current row) as gone from judged),
left_over as (select doc_id, sum(gone) as n_removed,
    string_agg(w, ' ' order by i) filter (gone = 0) as kept from covered group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words,
    cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join left_over using (doc_id)
"""
