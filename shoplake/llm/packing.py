"""Packing: documents as token pieces in sequences of fixed length, by vector bin packing.

A document's ids are cut into pieces of the full length, which fill a sequence each, and one
shorter piece. Pieces have three demands: tokens, segments (one each) and loss-bearing tokens.
One sequence is filled at a time: of all pieces that still fit, the next is the one whose
demands have the largest dot product with what is left of the limits, each weighted by how
much of it the waiting pieces ask for. Pieces with equal demands share an entry, so a choice
looks at the distinct demands only.

Only ids' counts and checksums leave the tokenizer's task. Pieces are dealt to groups by a
hash, as many groups as there are tasks if these get ``FULL`` pieces each, and more where a group
would have over ``GROUP``; each fills its own sequences, and only its last few are far from full.
Sequences shorter than the limit are to be padded, except at a power of two.
"""

import json
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from functools import partial
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplake.llm.common import gathered, slices, stored, tasks

GROUP, FULL = 20_000, 4_000  # pieces packed together, at most and at least, about
STEP = 4 << 20  # bytes of text encoded at a time, about
END_OF_TEXT = 1  # Fixed value: the id that closes a document.

PIECES = """doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,
    loss bigint"""
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"

# What the vocabulary's rule for cutting text takes as white space, and words with
# all white space before them. The tokenizer never joins across these cuts.
OTHER = "\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f" \n{OTHER}"
WORD = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# Texts with white space other than single blanks and line breaks, and where those are cut.
SPACED = f"\\A[ \n]|[ \n][ \n]|[{OTHER}]"
EDGES = f"([^{SPACE}])([{SPACE}])"
# Words that white space before them would be joined with, or after them.
APART = f"\\A\\z|\\A[{SPACE}][{SPACE}]|[{SPACE}]\\z"
# Fixed value: how byte-level vocabularies of this kind cut text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def word_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, each with all white space before it; the numbers of the words
    in the texts, one text after the other; and where each text's numbers begin and end."""
    texts = texts.cast(pa.large_string())
    if pc.any(pc.match_substring(texts, "\0")).as_py():
        lists = pa.array([WORD.findall(t) for t in texts.to_pylist()], pa.list_(pa.large_string()))
    else:
        cut = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        spaced = pc.match_substring_regex(texts, SPACED)
        if pc.any(spaced).as_py():
            again = pc.replace_substring_regex(texts.filter(spaced), EDGES, "\\1\0\\2")
            cut = pc.replace_with_mask(cut, spaced, again)
        lists = pc.split_pattern(cut, "\0")
    words = lists.flatten().dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), lists.offsets.to_numpy()


def content(parts: pa.Array, between: str = "") -> pa.Buffer:
    """Texts as one."""
    lists = pa.ListArray.from_arrays([0, len(parts)], parts)
    return pc.binary_join(lists, pa.scalar(between, parts.type))[0].as_buffer()


def binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Values one after the other as byte strings of so many values each."""
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]) * values.itemsize
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)


def joined(parts: pa.Array, numbers: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The parts by their numbers, put together from each place to the next."""
    if not len(numbers):
        return [b""] * (len(at) - 1)
    taken = parts.take(pa.array(numbers))
    _, offsets, data = taken.buffers()
    ends = np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)[at].tolist()
    view = memoryview(data or b"")
    return [bytes(view[a:b]) for a, b in zip(ends, ends[1:])]


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, the same as ``Tokenizer.encode`` gives.

    Words are encoded once for some texts, all at a time, by a faster library from the same
    vocabulary; that holds for byte-level vocabularies whose ids are in the order of the merges,
    and others are encoded by the tokenizer itself. So are whole texts where a special token
    might stand.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.merged = self.in_merge_order(given)
        if self.merged:
            letters = byte_letters()
            added = {t["content"] for t in given["added_tokens"]}
            ranks = {
                bytes(letters[c] for c in token): i
                for token, i in given["model"]["vocab"].items()
                if token not in added
            }
            core = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.many = partial(core.encode_to_numpy, disallowed_special=())
            self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for token, i in ranks.items():
                self.sizes[i] = len(token)

    @staticmethod
    def in_merge_order(given: dict) -> bool:
        before = given.get("pre_tokenizer") or {}
        level = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if given.get("normalizer") or not level or before.get("add_prefix_space"):
            return False
        merges, vocab = given["model"]["merges"], given["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        return all(vocab["".join(m)] == 256 + i for i, m in enumerate(pairs))

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def ids_of_words(self, words: pa.Array) -> pa.Array:
        """Distinct words are one text to the library, with a line break before each: a token
        of its own, as no word that is not encoded apart begins with two white spaces or ends
        with one. The tokens' lengths in bytes say which are whose."""
        apart = pc.match_substring_regex(words, APART).to_numpy(zero_copy_only=False)
        together = words.filter(pa.array(~apart))
        found, counts = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        if len(together):
            found = self.many("\n" + str(content(together, "\n"), "utf-8"))
            sizes = pc.binary_length(together).to_numpy() + 1
            starts = np.cumsum(self.sizes[found]) - self.sizes[found]
            first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
            counts = np.diff(first, append=len(found)) - 1
            found = np.delete(found, first)
        own = [self.many(word) for word in words.filter(pa.array(apart)).to_pylist()]
        ids = np.concatenate([found, *own]).astype("<u4")
        counts = np.concatenate([counts, np.array([len(ids) for ids in own], dtype=np.int64)])
        place = np.argsort(np.argsort(apart, kind="stable"), kind="stable")
        return binary(ids, counts).take(pa.array(place))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if not self.merged:
            return [self.whole(text) for text in texts]
        special = [any(s in text for s in self.special) for text in texts]
        plain = [text for text, own in zip(texts, special) if not own]
        words, numbers, at = word_table(pa.array(plain, pa.large_string()))
        found = iter(joined(self.ids_of_words(words), numbers, at))
        return [self.whole(text) if own else next(found) for text, own in zip(texts, special)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def encoder(path: str) -> Encoder:
    """One for each worker process, which runs many tasks."""
    kept = vars(sys.modules.setdefault("shoplake_encoders", ModuleType("shoplake_encoders")))
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def tokenized(path: str, limit: int):
    end = np.array([END_OF_TEXT], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss"]

    def pieces(doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        for start in range(0, total, limit):
            part = ids[4 * start : 4 * (start + limit)]
            size = len(part) // 4
            # Nothing predicts a document's first token.
            yield doc_id, start, size, zlib.crc32(part), total, size - (start == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path).encode_all
        for batch in gathered(batches, STEP):
            rows = []
            for part, texts in slices(batch.column(1), STEP):
                for doc_id, ids in zip(batch.column(0)[part].to_pylist(), encode_all(texts)):
                    rows += pieces(doc_id, ids + end)
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def filled(demands: np.ndarray, limits: np.ndarray) -> Iterator[list[int]]:
    """Bins as lists of row numbers of ``demands`` (tokens, segments, loss-bearing tokens).

    A piece that breaks a limit on its own gets a bin of its own.
    """
    kinds, members = np.unique(demands, axis=0, return_inverse=True)
    members = members.reshape(-1)
    order = np.argsort(members, kind="stable")
    stop = np.cumsum(np.bincount(members, minlength=len(kinds)))
    at = stop - np.bincount(members, minlength=len(kinds))
    left = stop - at
    shares, columns = kinds / limits, np.ascontiguousarray(kinds.T)
    waiting = (shares * left[:, None]).sum(axis=0)
    while len(kinds):
        room, row = limits.astype(np.int64).copy(), []
        while True:
            fits = left > 0
            for column, most in zip(columns, room):
                fits &= column <= most
            if not fits.any():
                break
            weight = waiting / max(waiting.sum(), 1e-9)
            value = np.where(fits, shares @ (weight * (room / limits)), -1.0)
            kind = value.argmax()
            row.append(int(order[at[kind]]))
            at[kind] += 1
            left[kind] -= 1
            room -= kinds[kind]
            waiting = waiting - shares[kind]
        if not row:
            for kind in np.flatnonzero(left > 0):
                for i in order[at[kind] : stop[kind]]:
                    yield [int(i)]
            return
        yield row
        # Distinct demands that are used up leave the tables now and then.
        some = left > 0
        if some.sum() < 0.9 * len(kinds):
            kinds, shares, left, at, stop = (own[some] for own in (kinds, shares, left, at, stop))
            columns = np.ascontiguousarray(kinds.T)
        elif not some.any():
            return


def packed(limits: tuple[int, int, int], groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        names = ("length", "loss", "__group")
        length, loss, group = (table.column(n).to_numpy() for n in names)
        demands = np.stack([length, np.ones_like(length), loss], axis=1).astype(np.int64)
        for own in np.unique(group):
            rows = np.flatnonzero(group == own)
            picked, sequence, offset = [], [], []
            for number, row in enumerate(filled(demands[rows], np.array(limits))):
                at = 0
                for i in rows[row]:
                    picked.append(i)
                    sequence.append(int(own) + groups * number)
                    offset.append(at)
                    at += int(length[i])
            out = table.drop_columns(["__group"]).take(pa.array(picked, pa.int64()))
            out = out.append_column("sequence_id", pa.array(sequence, pa.int64()))
            yield from out.append_column("offset", pa.array(offset, pa.int64())).to_batches()

    return run


def pack(
    pieces: DataFrame, max_tokens: int, max_segments: int, max_loss: int, group_size: int = GROUP
) -> DataFrame:
    """``pieces`` (doc_id, start, length, loss and others) with ``sequence_id`` and ``offset``.

    No sequence has more than the three limits allow; a piece that breaks one on its own has
    its sequence to itself. Offsets are gapless from 0. Repeated pieces are packed each. Columns
    that are called ``sequence_id``, ``offset`` or ``__group`` already are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset", "__group")
    many = pieces.count()
    groups = max(-(-many // group_size), min(tasks(pieces.sparkSession), many // FULL), 1)
    # Pieces that are alike, such as those without an id, are told apart by their place.
    key = F.xxhash64("doc_id", "start", "length", F.monotonically_increasing_id())
    dealt = pieces.withColumn("__group", F.pmod(key, F.lit(groups)).cast("int"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}"
    # In a fixed order, so that a task that runs again fills the same sequences.
    dealt = dealt.repartitionById(groups, "__group").sortWithinPartitions("__group", *pieces.columns)
    return dealt.mapInArrow(
        packed((max_tokens, max_segments, max_loss), groups),
        f"{schema}, sequence_id bigint, offset bigint",
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: Callable[[], str] | str,
    max_tokens: int = 2048,
    max_segments: int = 256,
    max_loss: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, loss, sequence_id, offset`` per piece.

    ``tokenizer`` is the path of a vocabulary file that all executors have. Null texts count
    as empty: one token, the closing one. Null ids stay null. Repeated rows are packed each.
    All tokens bear loss but a document's first. Other columns play no part.
    """
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    path = tokenizer if isinstance(tokenizer, str) else tokenizer()
    pieces = stored(rows.mapInArrow(tokenized(path, max_tokens), PIECES))
    return pack(pieces, max_tokens, max_segments, max_loss or max_tokens)
