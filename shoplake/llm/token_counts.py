"""Token counts at every prefix of a text, by prefix dynamic programming.

A sequence of byte-pair tokens is the encoding of its bytes exactly if every two neighbours
are: if their bytes together are encoded as these two. So every prefix has one last token
only, the token that ends there and agrees with the last token of the prefix before it, and
its count is one more than that prefix's. One pass from left to right gives the counts of all
prefixes, each as if the prefix were encoded on its own. Words repeat, so what a word adds to
the counts is computed once for some texts; for the pieces of most words byte by byte for many
pieces at once, and for those that begin alike once.

The counts are stored as differences. Whether a text fits, where it must be cut for a budget,
and how many tokens any prefix has are then read from the table; nothing is encoded again.
"""

import json
import re
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterator
from operator import sub
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shoplake.llm.common import gathered, slices
from shoplake.llm.packing import SPACE, Encoder, binary, byte_letters, content, joined, word_table

CACHE = 1 << 20  # pairs of tokens, and characters of words, that a worker remembers
STEP = 8 << 20  # bytes of text at a time, about; characters of a longer text
ROWS, WIDTH = 50_000, 32  # pieces counted at once, and their bytes; longer ones go one by one

# The contractions that are cut off as they are, of which these are longer than
# one letter.
CONTRACTIONS = {"'re", "'ve", "'ll"}
LEAD = re.compile(f"[{SPACE}]*")
EDGE = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
# Most words: letters or digits, and signs before or after them, a piece each. The letters are
# those that all versions of Unicode have as such.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΆΈ-ΊΌΎ-ΡΣ-ϵЀ-ҁҊ-ԣא-תؠ-يぁ-ゖァ-ヺ一-龥가-힣"
SIGNS = "!-/:-@\\[-`{-~"
SIMPLE = (
    f"\\A(?P<line>\n?)(?P<open>(?: ?[{SIGNS.replace('!-/', '!-&(-/')}]+)?)"
    f"(?P<stem> ?(?:[{LETTERS}]+|[0-9]+))(?P<signs>[{SIGNS}]*)\\z"
)

COUNTED = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, prefix_steps binary"


def differences(counts: list[int]) -> bytes:
    return array("h", map(sub, counts, [0, *counts])).tobytes()


class Pairs(dict):
    """Whether two tokens, side by side, are the encoding of their bytes; by both numbers in
    one. The number after the last token's stands for no token."""

    def __init__(self, ranks: dict[bytes, int], names: list[bytes]):
        self.ranks = ranks
        self.names = [*names, b""]
        self.known = np.full(CACHE, -1, dtype=np.int64)

    def merged(self, piece: bytes) -> list[bytes]:
        """Byte-pair encoding as it is defined: the lowest rank is joined first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, sys.maxsize) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == sys.maxsize:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def __missing__(self, key: int) -> bool:
        pair = [self.names[i] for i in divmod(key, len(self.names))]
        found = self.merged(b"".join(pair)) == [token for token in pair if token]
        if len(self) >= CACHE:
            self.clear()
        self[key] = found
        return found

    def all_of(self, keys: np.ndarray) -> np.ndarray:
        """As one by one; by a table in which pairs that share a place replace each other."""
        place = (keys * 0x9E3779B1 >> 12) % len(self.known)
        known = self.known[place]
        new = np.flatnonzero(known >> 1 != keys)
        if len(new):
            found = [2 * key + self[key] for key in keys[new].tolist()]
            known[new] = self.known[place[new]] = found
        return (known & 1).astype(bool)


class PrefixCounter:
    """Counts of a byte-level vocabulary whose ids are in the order of the merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        added = given["added_tokens"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        if not (Encoder.in_merge_order(given) and plain):
            raise ValueError(f"{path} is no byte-level vocabulary in the order of its merges")
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        letters = byte_letters()
        names = [
            bytes(letters[c] for c in token)
            for token, _ in sorted(given["model"]["vocab"].items(), key=lambda item: item[1])
            if token not in special
        ]
        self.tokens = {name: i for i, name in enumerate(names)}
        self.pairs = Pairs(self.tokens, names)
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        # Lengths of the tokens that end in three bytes (or are shorter), longest first.
        ends: dict[bytes, set[int]] = defaultdict(set)
        for name in names:
            ends[name[-3:]].add(len(name))
        for end in list(ends):
            for size in range(1, len(end)):
                if end[-size:] in self.tokens:
                    ends[end].add(size)
        self.lengths = {end: sorted(found, reverse=True) for end, found in ends.items()}
        self.words: dict[str, bytes] = {}
        self.size = 0  # characters of these words
        self.set_backwards(names)
        self.before, self.count, self.last = b"", [0], [len(names)]

    def set_backwards(self, names: list[bytes]) -> None:
        """A tree of the tokens read from their ends, as a sorted table of its edges."""
        edges: dict[int, int] = {}
        tokens = {}
        for i, name in enumerate(names):
            node = 0
            for byte in reversed(name[-WIDTH:]):
                node = edges.setdefault(node << 8 | byte, len(edges) + 1)
            if len(name) <= WIDTH:
                tokens[node] = i
        self.edges = np.array(sorted(edges), dtype=np.int64)
        self.nodes = np.array([edges[key] for key in sorted(edges)], dtype=np.int64)
        self.token_at = np.full(len(edges) + 1, -1, dtype=np.int64)
        self.token_at[list(tokens)] = list(tokens.values())

    def by_byte(self, piece: bytes) -> list[int]:
        """The number of tokens of every prefix of a piece, the empty one first. What the
        piece before began with in the same way is not computed again."""
        token_of, pairs, sizes_of = self.tokens.get, self.pairs, self.lengths.get
        base, same = len(self.tokens) + 1, 0
        for a, b in zip(self.before, piece):
            if a != b:
                break
            same += 1
        count, last = self.count, self.last
        del count[same + 1 :], last[same + 1 :]
        for stop in range(same + 1, len(piece) + 1):
            end = piece[stop - 3 if stop > 3 else 0 : stop]
            sizes = sizes_of(end) or sizes_of(end[-2:]) or (1,)
            for size in sizes:
                begin = stop - size
                if begin >= 0:
                    token = token_of(piece[begin:stop])
                    if token is not None and pairs[last[begin] * base + token]:
                        break
            last.append(token)
            count.append(count[begin] + 1)
        self.before = piece
        return count

    def by_character(self, piece: str) -> list[int]:
        """As ``by_byte``, for the prefixes that end with a character, without the empty one."""
        data = piece.encode()
        counts = self.by_byte(data)
        if len(data) == len(piece):
            return counts[1:]
        ends = [i for i in range(1, len(data)) if data[i] & 0xC0 != 0x80]
        return [counts[i] for i in ends] + counts[-1:]

    def of_word(self, word: str) -> list[int]:
        """Counts at every character of a word with all white space before it.

        A prefix that ends in white space has that white space as its last piece. The whole
        word instead gives its last white space character to what follows, or leaves it alone.
        """
        lead = LEAD.match(word).end()
        counts = self.by_character(word[:lead]) if lead else []
        done = 0
        for _, (start, stop) in self.pieces(word):
            piece = word[start:stop]
            own = self.by_character(piece)
            if piece in CONTRACTIONS:
                own[1] = 2  # without its last letter it is a sign and a word
            counts += [done + n for n in own[max(0, lead - start) :]]
            done += own[-1]
        return counts

    def ending(self, letters: np.ndarray, depth: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        """The tokens that end at places of pieces, and their sizes, place by place and the
        longest first; and where each place's begin and end."""
        at, node = np.arange(len(depth)), np.zeros(len(depth), dtype=np.int64)
        places, sizes, tokens = [], [], []
        for size in range(1, WIDTH + 1):
            inside = depth[at] >= size - 1
            at, node = at[inside], node[inside]
            key = node << 8 | letters[depth[at] - (size - 1), row[at]]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            there = self.edges[edge] == key
            at, node = at[there], self.nodes[edge[there]]
            if not len(at):
                break
            token = self.token_at[node]
            whole = token >= 0
            places.append(at[whole])
            sizes.append(np.full(len(places[-1]), size))
            tokens.append(token[whole])
        place = np.concatenate(places[::-1])
        order = np.argsort(place, kind="stable")
        stops = np.cumsum(np.bincount(place, minlength=len(depth)))
        sizes, tokens = np.concatenate(sizes[::-1])[order], np.concatenate(tokens[::-1])[order]
        return tokens, sizes, np.concatenate([[0], stops])

    def at_once(self, pieces: pa.Array) -> pa.Array:
        """``differences`` of what ``by_character`` gives, of short pieces in order."""
        lengths = pc.binary_length(pieces).to_numpy()
        inside = np.arange(lengths.max())[:, None] < lengths
        letters = np.zeros(inside.shape[::-1], dtype=np.int64)
        letters[inside.T] = np.frombuffer(content(pieces), dtype=np.uint8)
        letters = np.ascontiguousarray(letters.T)
        # Places whose beginning is not that of the piece before.
        new = inside.copy()
        new[:, 1:] &= ~np.logical_and.accumulate(letters[:, 1:] == letters[:, :-1], axis=0)
        depth, row = np.nonzero(new)
        tokens, sizes, ends = self.ending(letters, depth, row)
        base, none = len(self.tokens) + 1, len(self.tokens)
        last = np.full((len(letters) + 1, len(lengths)), none, dtype=np.int64)
        count = np.zeros_like(last)
        begin = np.searchsorted(depth, np.arange(len(letters) + 1))
        for at in range(len(letters)):
            open_, own = np.arange(begin[at], begin[at + 1]), ends[begin[at] : begin[at + 1]]
            while len(open_):
                before = at + 1 - sizes[own], row[open_]
                fits = self.pairs.all_of(last[before] * base + tokens[own])
                fits |= own + 1 == ends[open_ + 1]
                done = before[0][fits], before[1][fits]
                last[at + 1, done[1]] = tokens[own[fits]]
                count[at + 1, done[1]] = count[done] + 1
                open_, own = open_[~fits], own[~fits] + 1
            # The others begin like the last new one before them.
            same = np.maximum.accumulate(np.where(new[at], np.arange(len(lengths)), 0))
            last[at + 1], count[at + 1] = last[at + 1, same], count[at + 1, same]
        after = np.vstack([letters[1:], np.zeros_like(letters[:1])])
        whole = inside & (after & 0xC0 != 0x80)
        counts = count[1:].T[whole.T]
        steps = np.diff(counts, prepend=0)
        chars = whole.sum(axis=0)
        starts = np.cumsum(chars) - chars
        steps[starts] = counts[starts]
        return binary(steps.astype("<i2"), chars)

    def of_pieces(self, pieces: pa.Array) -> pa.Array:
        """``differences`` of what ``by_character`` gives, of distinct pieces."""
        sizes = pc.binary_length(pieces).to_numpy()
        apart = (sizes == 0) | (sizes > WIDTH)
        short = pieces.filter(pa.array(~apart))
        order = pc.sort_indices(short)
        ordered = short.take(order)
        found = [self.at_once(ordered[at : at + ROWS]) for at in range(0, len(ordered), ROWS)]
        own = [differences(self.by_character(piece)) for piece in pieces.filter(pa.array(apart)).to_pylist()]
        places = np.concatenate([np.flatnonzero(~apart)[order.to_numpy()], np.flatnonzero(apart)])
        return pa.concat_arrays([*found, pa.array(own, pa.large_binary())]).take(pa.array(np.argsort(places)))

    def of_words(self, words: pa.Array) -> pa.Array:
        """What each character of distinct words adds to the number of tokens."""
        found = pc.extract_regex(words, SIMPLE)
        simple = pc.and_not(found.is_valid(), pc.starts_with(words, "\n "))
        own = found.filter(simple).flatten()
        parts = pa.concat_arrays(own).dictionary_encode()
        steps = self.of_pieces(parts.dictionary).take(parts.indices)
        many = len(own[0])
        own = [steps[at : at + many] for at in range(0, len(steps), many)] if many else [steps]
        steps = pc.binary_join_element_wise(*own, pa.scalar(b"", pa.large_binary()))
        others = [self.remembered(word) for word in words.filter(pc.invert(simple)).to_pylist()]
        simple = simple.to_numpy(zero_copy_only=False)
        place = np.argsort(np.argsort(~simple, kind="stable"), kind="stable")
        return pa.concat_arrays([steps, pa.array(others, pa.large_binary())]).take(pa.array(place))

    def remembered(self, word: str) -> bytes:
        """``differences`` of what ``of_word`` gives, kept by the word."""
        steps = self.words.get(word)
        if steps is None:
            steps = differences(self.of_word(word))
            if self.size + len(word) > CACHE:
                self.words.clear()
                self.size = 0
            if len(word) <= CACHE:
                self.words[word] = steps
                self.size += len(word)
        return steps

    def ordinary(self, texts: list[str]) -> list[bytes]:
        """What each character adds in texts without special tokens."""
        words, numbers, at = word_table(pa.array(texts, pa.large_string()))
        return joined(self.of_words(words), numbers, at)

    def blocks(self, text: str) -> Iterator[str]:
        """A text, cut before white space."""
        at = 0
        while len(text) - at > STEP and (cut := EDGE.search(text, at + STEP)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def steps(self, text: str) -> bytes:
        """What each character of a text adds to the number of tokens, as 16-bit numbers.

        A special token counts as one where it is whole; a part of it is ordinary text.
        """
        found, done = [], 0
        while match := self.special.search(text, done):
            own = self.steps(text[done : match.end() - 1])
            counts = np.cumsum(np.frombuffer(own, dtype="<i2"), dtype=np.int64)
            size = match.start() - done
            whole = (counts[size - 1] if size else 0) + 1
            found += [own, np.array([whole - counts[-1]], dtype="<i2").tobytes()]
            done = match.end()
        for block in self.blocks(text[done:]):
            found += self.ordinary([block])
        return b"".join(found)

    def steps_of(self, texts: list[str]) -> list[bytes]:
        """As ``steps``, of some texts at once."""
        if len(texts) > 1 and not any(map(self.special.search, texts)):
            return self.ordinary(texts)
        return [self.steps(text) for text in texts]


def counter(path: str) -> PrefixCounter:
    """One for each worker process, which runs many tasks."""
    kept = vars(sys.modules.setdefault("shoplake_counters", ModuleType("shoplake_counters")))
    if path not in kept:
        kept[path] = PrefixCounter(path)
    return kept[path]


def prefixes(steps: bytes) -> np.ndarray:
    """The number of tokens of every prefix of a text, the empty one first."""
    counts = np.cumsum(np.frombuffer(steps, dtype="<i2"), dtype=np.int64)
    return np.concatenate([[0], counts])


def counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]
        names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "prefix_steps"]
        for batch in gathered(batches, STEP):
            for part, texts in slices(batch.column(1), STEP):
                steps = count.steps_of(texts)
                sizes = pc.binary_length(batch.column(1)[part].cast(pa.large_binary()))
                totals = [int(np.frombuffer(s, dtype="<i2").sum(dtype=np.int64)) for s in steps]
                lengths = [len(s) // 2 for s in steps]
                values = [batch.column(0)[part], sizes, lengths, totals, steps]
                columns = [pa.array(c, kind) for c, kind in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def count_prefixes(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_chars, n_tokens, prefix_steps`` for every row.

    ``vocabulary`` is the path of a byte-level vocabulary file that all executors have; one
    that is not byte-level, or whose ids are not in the order of the merges, is refused.
    ``prefix_steps`` holds what each character of the text adds to the number of tokens, in
    little-endian 16-bit numbers: their sum up to a character is the exact number of tokens
    of the text up to there, as the tokenizer gives it without added tokens. ``n_tokens`` is
    the last of these sums. Null texts count as empty: no steps, no tokens. Null ids stay
    null, repeated rows get a row each, other columns play no part. A text is one row and is
    counted by one task; what is kept is two bytes a character.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(counting(vocabulary), COUNTED)


def answering(given: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(batch.schema.get_field_index("__asked")).to_pylist()
            steps = batch.column(batch.schema.get_field_index("prefix_steps"))
            found = []
            for ask, own in zip(asked, steps):
                if ask is None or not own.is_valid:
                    found.append((None, None))
                    continue
                counts = prefixes(own.as_py())
                if given == "characters":
                    at = min(max(ask, 0), len(counts) - 1)
                else:
                    fitting = np.flatnonzero(counts <= ask)
                    at = int(fitting[-1]) if len(fitting) else None
                found.append((at, None if at is None else int(counts[at])))
            out = pa.Table.from_batches([batch]).drop_columns(["__asked"])
            for i, name in enumerate(("cut_chars", "cut_tokens")):
                out = out.append_column(name, pa.array([f[i] for f in found], pa.int64()))
            yield from out.to_batches()

    return run


def _answered(counted: DataFrame, given: str, asked) -> DataFrame:
    rows = counted.drop("cut_chars", "cut_tokens").withColumn("__asked", F.lit(asked).cast("bigint"))
    schema = rows.drop("__asked").schema.add("cut_chars", T.LongType()).add("cut_tokens", T.LongType())
    return rows.mapInArrow(answering(given), schema)


def cut_to_budget(counted: DataFrame, budget) -> DataFrame:
    """The rows with ``cut_chars`` and ``cut_tokens``: the longest prefix whose encoding has at
    most ``budget`` tokens (a number or a column), and how many it has.

    More characters may mean fewer tokens, so it is the longest of all that fit, not the first
    before one that does not. Below a budget of 0 nothing fits: null, as for a null budget.
    """
    return _answered(counted, "budget", budget)


def tokens_before(counted: DataFrame, characters) -> DataFrame:
    """The rows with ``cut_chars`` and ``cut_tokens``: the number of tokens of the first
    ``characters`` (a number or a column, taken as 0 below that and as all beyond the end)."""
    return _answered(counted, "characters", characters)


def counts_of_documents(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, see ``count_prefixes``."""
    counted = count_prefixes(docs, vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
