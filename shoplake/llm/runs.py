"""Periodic runs: stretches of words that repeat with a period, found by octaves of the period.

For the periods of an octave, from ``2 ** j`` up to twice that, a text is covered by
overlapping tiles, each around boundaries that are two smallest periods apart. A run of four
periods or more crosses at least one of them. For each boundary two Z-functions, one to the
right and one over the reversed words to the left, give for all periods of the octave how far
words a period apart stay equal, within the tile. Boundaries without any square beside them
are passed over: that is seen from the window hashes of a whole tile at once, and hashes only
ever make too many boundaries pass.

So a tile gives fragments of runs, clipped at its ends. Fragments go by document and period
to one place and are stitched where they touch. Short texts are searched by the task that
reads them, many at a time. A text of more than ``LONG`` words is spread over tasks, tile by
tile. Only texts in which a fragment was found are moved, to be written without the repeats.
"""

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import mixed, short_batches, slices, stored, tasks, words
from shoplake.llm.rolling import BASE, powers

# A run has so many periods and so many words at least.
PERIODS = 4
WORDS = 6
STEP = 1 << 20  # bytes of text at a time, about
TILE = 1 << 16  # words between the first and the last boundary of a tile, about
LONG = 1 << 17  # words: longer texts are spread over tasks
TILES = 64  # of a task

FOUND = """key bigint, doc_id bigint, n bigint, plain string, long boolean, text string,
    fragments array<struct<period: bigint, lo: bigint, hi: bigint>>"""
CUT = "key bigint, octave int, base bigint, codes binary"
FRAGMENTS = "key bigint, period bigint, lo bigint, hi bigint"
RUNS = """doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint,
    exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"""

Fragment = tuple[int, int, int]  # period, and from where up to where words equal those a period on


def z_values(own: list[int], upto: int) -> list[int]:
    """How many words from place i on are those from the start on, for each i below ``upto``."""
    size = len(own)
    found = [0] * upto
    left = right = 0
    for i in range(1, upto):
        same = min(right - i, found[i - left]) if i < right else 0
        while i + same < size and own[same] == own[i + same]:
            same += 1
        found[i] = same
        if i + same > right:
            left, right = i, i + same
    return found


def to_the_right(codes: np.ndarray, at: int, top: int, reach: int) -> np.ndarray:
    """For each period below ``top``: how many words from ``at`` on equal those a period on."""
    own = codes[at : at + reach + top].tolist()
    found = np.zeros(top, dtype=np.int64)
    upto = min(top, len(own))
    found[:upto] = z_values(own, upto)
    return np.minimum(found, reach)


def to_the_left(codes: np.ndarray, at: int, top: int, reach: int) -> np.ndarray:
    """For each period below ``top``: how many words before ``at`` equal those a period on."""
    begin = max(0, at - reach)
    before = codes[begin:at][::-1].tolist()
    whole = codes[begin : at + top - 1][::-1].tolist()
    ahead = len(whole) - len(before)
    # A word that is nowhere else keeps the two apart.
    found = z_values([*before, None, *whole], len(before) + 1 + ahead)
    periods = np.zeros(top, dtype=np.int64)
    periods[1 : ahead + 1] = found[len(before) + 1 :][::-1]
    return periods


def primitive(period: int, right: np.ndarray) -> bool:
    """Whether the words of one period are no repetition themselves. ``right``: of a boundary
    that they begin at."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            shorter = period // factor
            if right[shorter] >= period - shorter:
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


class Stretch:
    """Words as numbers, with sums from which windows are compared."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.up = powers(BASE, len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(mixed(codes.astype(np.int64).view(np.uint64)) * self.up[:-1], out=self.sums[1:])

    def squares(self, at: np.ndarray, periods: np.ndarray) -> np.ndarray:
        """Where, from ``at`` on, a period's words are followed by the same words again."""
        size = len(self.codes)
        middle, stop = at + periods, at + 2 * periods
        inside = (at >= 0) & (stop <= size)
        at, middle, stop = (np.clip(x, 0, size) for x in (at, middle, stop))
        sums = self.sums
        first = (sums[middle] - sums[at]) * self.up[np.minimum(periods, size)]
        return inside & (first == sums[stop] - sums[middle])

    def fragments(self, octave: int, boundaries: np.ndarray) -> Iterator[Fragment]:
        """Of the runs that cross one of these boundaries, those of one period in order."""
        low, top, reach = 1 << octave, 2 << octave, 4 << octave
        periods = np.arange(low, top)
        at = boundaries[:, None]
        near = self.squares(at, periods[None, :]) | self.squares(at - periods, periods[None, :])
        for boundary in boundaries[near.any(axis=1)].tolist():
            right = to_the_right(self.codes, boundary, top, reach)
            left = to_the_left(self.codes, boundary, top, reach)
            for period in periods[(left + right)[low:] >= 2 * periods].tolist():
                if primitive(period, right):
                    yield period, boundary - int(left[period]), boundary + int(right[period])


def stitched(fragments: Iterator[Fragment]) -> Iterator[Fragment]:
    """Touching fragments of a period as one; those of a period come in order."""
    held: dict[int, list[int]] = {}
    for period, lo, hi in fragments:
        own = held.get(period)
        if own and lo <= own[1]:
            own[1] = max(own[1], hi)
            continue
        if own:
            yield period, *own
        held[period] = [lo, hi]
    for period, own in held.items():
        yield period, *own


def octaves(size: int) -> range:
    """Those that have a period of which ``size`` words can hold a run."""
    return range((size // PERIODS).bit_length()) if size >= WORDS else range(0)


def numbers(texts: list[list[bytes]]) -> np.ndarray:
    """Texts one after the other, words as numbers; each ends in a number that is nowhere
    else, so that nothing repeats across texts."""
    known: dict[bytes, int] = {}
    found: list[int] = []
    for i, text in enumerate(texts):
        found += [known.setdefault(word, len(known)) for word in text]
        found.append(-1 - i)
    return np.array(found, dtype=np.int64)


def together(texts: list[list[bytes]]) -> list[list[Fragment]]:
    """The fragments of each of some texts."""
    found: list[list[Fragment]] = [[] for _ in texts]
    # Longest first: an octave is only looked for where texts are long enough.
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    begins = np.cumsum([0] + [len(texts[i]) + 1 for i in order])
    stretch = Stretch(numbers([texts[i] for i in order]))
    for octave in octaves(max(map(len, texts), default=0)):
        least = max(WORDS, PERIODS << octave)
        end = begins[sum(len(text) >= least for text in texts)]
        tile = max(TILE, 2 << octave)
        for first in range(0, end, tile):
            boundaries = np.arange(first, min(first + tile, end), 2 << octave)
            for period, lo, hi in stitched(stretch.fragments(octave, boundaries)):
                text = int(np.searchsorted(begins, lo, side="right")) - 1
                found[order[text]].append((period, int(lo - begins[text]), int(hi - begins[text])))
    return found


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def searched(long: int):
    kinds = pa.list_(pa.struct([(n, pa.int64()) for n in ("period", "lo", "hi")]))
    schema = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("plain", pa.string())]
        + [("long", pa.bool_()), ("text", pa.large_string()), ("fragments", kinds)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch.column(2), STEP):
                split = [words(text) for text in texts]
                spread = [len(own) > long for own in split]
                found = together([[] if far else own for own, far in zip(split, spread)])
                moves = [far or bool(own) for own, far in zip(found, spread)]
                plain = [None if m else sha256(b" ".join(own)) for own, m in zip(split, moves)]
                told = [[dict(zip(("period", "lo", "hi"), f)) for f in own] for own in found]
                columns = [batch.column(0)[part], batch.column(1)[part], [len(s) for s in split]]
                columns += [plain, spread, [t if m else None for t, m in zip(texts, moves)], told]
                arrays = [pa.array(c, field.type) for c, field in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long texts, octave by octave, in overlapping tiles."""
    names = ["key", "octave", "base", "codes"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.large_binary()]
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes = numbers([words(text.as_py())])[:-1]
            for octave in octaves(len(codes)):
                tile, reach = max(TILE, 2 << octave), 4 << octave
                for first in range(0, len(codes), tile):
                    begin = max(0, first - reach)
                    own = codes[begin : first + tile + reach + (2 << octave)].astype("<i8").tobytes()
                    columns = [[key], [octave], [first], [own]]
                    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)


def tile_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "period", "lo", "hi"]
    for batch in batches:
        for key, octave, first, data in zip(*(batch.column(i) for i in range(4))):
            octave, first = octave.as_py(), first.as_py()
            stretch = Stretch(np.frombuffer(data.as_buffer(), dtype="<i8"))
            shift = max(0, first - (4 << octave))
            stop = min(first - shift + max(TILE, 2 << octave), len(stretch.codes))
            boundaries = np.arange(first - shift, stop, 2 << octave)
            found = list(stitched(stretch.fragments(octave, boundaries)))
            rows = [(key.as_py(), period, lo + shift, hi + shift) for period, lo, hi in found]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def runs_of(fragments: DataFrame) -> DataFrame:
    """``key, start, length, period``: fragments that touch are one run."""
    own = Window.partitionBy("key", "period").orderBy("lo", "hi")
    reached = F.max("hi").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("lo") <= reached, 0).otherwise(1)
    numbered = fragments.withColumn("begins", begins).withColumn("run", F.sum("begins").over(own))
    whole = numbered.groupBy("key", "period", "run").agg(F.min("lo").alias("start"), F.max("hi").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    found = whole.select("key", "start", length.alias("length"), "period")
    return found.where(F.col("length") >= F.greatest(F.lit(WORDS), PERIODS * F.col("period")))


def described(text: str, runs: list[tuple[int, int, int]]) -> tuple:
    """What ``periodic_runs`` returns of a text and its runs (start, length, period)."""
    own = words(text)
    keep = np.ones(len(own), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    collapsed = sha256(b" ".join([own[i] for i in np.flatnonzero(keep).tolist()]))
    runs = sorted(runs, key=lambda run: (run[0], run[2]))
    told = sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode())
    best: tuple = (None,) * 4
    if runs:
        # The first of the largest is taken; they are in the order of ties.
        start, length, period = max(runs, key=lambda run: Fraction(run[1], run[2]))
        best = (start, length, period, 1000 * length // period)
    return len(runs), *best, told, collapsed


def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    schema = pa.schema(
        [(n, pa.int64()) for n in names] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    )
    for batch in batches:
        rows = []
        for doc_id, text, runs in zip(*(batch.column(i) for i in range(3))):
            own = [(r["start"], r["length"], r["period"]) for r in runs.as_py() or []]
            rows.append((doc_id.as_py(), *described(text.as_py(), own)))
        columns = zip(*rows) if rows else [()] * len(schema)
        arrays = [pa.array(c, field.type) for c, field in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long: int = LONG
) -> DataFrame:
    """The runs of each text, and the text with each run cut down to its first period.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of
    words with smallest period ``q`` (words ``q`` apart are equal), of at least 6 words and 4
    periods, that can't be longer on either side. Returns for every row ``doc_id, n_runs``,
    the run with the most periods (``start, length, period, exponent_milli``; of equal ones
    the first to start, then the shorter period; nulls without a run), ``runs_sha256`` over
    all runs, a line ``start,length,period`` each, and ``collapsed_sha256`` over the words
    that stay, one space between them. Null and empty texts have no words and no runs. Null
    ids stay null, repeated rows get a row each, other columns play no part. Texts of more
    than ``long`` words are searched by several tasks; the result is the same.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    first = stored(rows.mapInArrow(searched(long), FOUND))
    spread = first.where("long").select("key", "text")
    cut = stored(spread.mapInArrow(tiles, CUT))
    parts = max(tasks(docs.sparkSession), cut.count() // TILES)
    of_long = cut.repartition(parts, "key", "octave", "base").mapInArrow(tile_fragments, FRAGMENTS)
    each = first.where("text is not null").select("key", F.explode("fragments").alias("f"))
    of_short = each.select("key", "f.period", "f.lo", "f.hi")
    runs = runs_of(of_short.unionByName(of_long))
    gathered = runs.groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    moved = first.where("text is not null").select("key", "doc_id", "text")
    held = moved.join(gathered, "key", "left").select("doc_id", "text", "runs")
    none = F.lit(None).cast("bigint")
    plain = first.where("text is null").select(
        "doc_id",
        F.lit(0).cast("bigint").alias("n_runs"),
        *[none.alias(n) for n in ("start", "length", "period", "exponent_milli")],
        F.sha2(F.lit(""), 256).alias("runs_sha256"),
        F.col("plain").alias("collapsed_sha256"),
    )
    return plain.unionByName(held.mapInArrow(finished, RUNS))


def with_tail_repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where the id's checksum ends in 0, the words from some place on are
    the first few of them over and over."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(checksum / 10)
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")

    def repeated(own: Column) -> Column:
        n = F.size(own)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        copies = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(own, a + 1, p), copies)), F.lit(1), n - a)
        whole = F.concat_ws(" ", F.concat(F.slice(own, F.lit(1), a), tail))
        return F.when(n > 0, whole).otherwise(F.lit(""))

    # As an element of an array the words are split once.
    told = F.element_at(F.transform(F.array(split), repeated), 1)
    text = F.when((checksum % 10 == 0) & F.col("text").isNotNull(), told).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))
