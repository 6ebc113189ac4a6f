"""URL filters: prefix rules found by a sort-merge range join.

A host turned round (``www.example.com`` becomes ``com.example.www.``) starts with the turned
host of every rule that covers it, so each rule is an interval of the sorted keys, and two
intervals are nested or apart. Pages and rules are dealt to key ranges; a rule goes to every
range that its interval touches. Within a range they are sorted together and swept once: a
stack holds the rules whose intervals are open, the innermost host on top, and a page looks
among them for the longest rule whose path its own path starts with.

The ranges are bounded by a sample of keys (``SAMPLES`` per range, gathered on the driver);
it decides where a page is judged, not how. Keys end in the page's path and a hash of its id,
so that one host, or one URL, that holds a third of all pages still spreads over many ranges.
"""

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import lower_ascii, tasks

SAMPLES = 64  # keys per range
LONGEST = 1024  # characters of a key that bound a range

ROWS = "range int, key string, page_id bigint, host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(authority) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(F.coalesce(authority, F.lit(""))), F.coalesce(path, F.lit(""))


def turned(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def parsed(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    end = F.hex(F.xxhash64("page_id"))
    return rows.withColumn("key", F.concat_ws("\0", turned(F.col("host")), "path", end))


def bounds(keyed: DataFrame, ranges: int) -> list[bytes]:
    """Where ranges of about as many keys each begin."""
    share = min(1.0, SAMPLES * ranges / max(1, keyed.count()))
    picked = keyed.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(2**40)) < int(2**40 * share))
    keys = sorted(r[0].encode() for r in picked.select(F.substring("key", 1, LONGEST)).collect())
    step = len(keys) / ranges
    return sorted({keys[int(step * i)] for i in range(1, ranges)}) if step >= 1 else []


def dealt(edges: list[bytes], whole_interval: bool):
    """Gives each row its range; a rule one row for each range it touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode() for k in batch.column("key").to_pylist()]
            first = [bisect_right(edges, k) for k in keys]
            rows, ranges = list(range(len(keys))), first
            if whole_interval:
                # Up to the first key behind: the closing dot of the host goes up by one.
                spans = [range(a, bisect_right(edges, k[:-1] + b"/") + 1) for a, k in zip(first, keys)]
                rows = [i for i, span in enumerate(spans) for _ in span]
                ranges = [at for span in spans for at in span]
            taken = batch.take(pa.array(rows, pa.int64()))
            columns = [taken.column(n) for n in ("key", "page_id", "host", "path", "verdict")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), *columns],
                names=["range", "key", "page_id", "host", "path", "verdict"],
            )

    return run


class Frame:
    """The open rules of one host: verdicts by path, and the lengths of the paths."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: dict[str, str] = {}
        self.lengths: list[int] | None = None

    def add(self, path: str, verdict: str) -> None:
        # Of equal rules with different verdicts, blocking wins.
        self.paths[path] = max(verdict, self.paths.get(path, verdict))
        self.lengths = None

    def longest(self, path: str) -> str | None:
        if self.lengths is None:
            self.lengths = sorted({len(p) for p in self.paths}, reverse=True)
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.paths), None)


def swept(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Frame] = []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in ("key", "rule", "page_id", "host", "path", "verdict")]
            for key, is_rule, page_id, host, path, verdict in zip(*columns):
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if is_rule:
                    if not stack or stack[-1].key != key:
                        stack.append(Frame(key, host))
                    stack[-1].add(path, verdict)
                    continue
                best: tuple[int, int, str, str] | None = None
                for depth, frame in enumerate(stack):
                    found = frame.longest(path)
                    if found is not None:
                        size = len(frame.host) + len(found)
                        best = max(best or (-1, -1, "", ""), (size, depth, frame.host + found, frame.paths[found]))
                out.append((page_id, host, path, *(best[2:] if best else (None, default))))
            names, kinds = ("page_id", "host", "path", "rule", "verdict"), (pa.int64(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=list(names)
            )

    return run


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule covers its host and all hosts
    below, where the page's path starts with the rule's. The longest rule (characters of host
    and path) wins, then the one with the longer host; of equal rules the one that blocks.
    Without a rule, ``rule`` is null and ``verdict`` is ``default``. Null URLs, and those
    without ``://``, have an empty host and path, and are judged as such. Nulls in a rule
    count as empty text. Repeated pages each get a row. Other columns play no part.
    """
    ranges = tasks(pages.sparkSession)
    keyed = parsed(pages, id_col, url_col).withColumn("verdict", F.lit(None).cast("string"))
    host = lower_ascii(F.coalesce("host", F.lit("")))
    listed = rules.select(
        turned(host).alias("key"),
        F.lit(None).cast("bigint").alias("page_id"),
        host.alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
    edges = bounds(keyed, ranges)
    rows = keyed.mapInArrow(dealt(edges, False), ROWS).withColumn("rule", F.lit(False))
    both = rows.unionByName(listed.mapInArrow(dealt(edges, True), ROWS).withColumn("rule", F.lit(True)))
    # A rule's key is the beginning of the keys it covers, so it sorts before them.
    ordered = both.repartitionById(len(edges) + 1, "range").sortWithinPartitions("key")
    return ordered.mapInArrow(
        swept(default), "page_id bigint, host string, path string, rule string, verdict string"
    )


# The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

SQL = """
with rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3)
    else '' end as rest from pages),
sides as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as authority from cut),
parsed as (select row_number() over () as n, page_id,
    translate(authority, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(authority) + 1), '^[^?#]*') as path from sides),
fits as (select n, page_id, host, path, h || p as rule, v, row_number() over (partition by n
    order by length(h || p) desc, length(h) desc) as place
    from parsed left join rules
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from fits where place = 1
"""
