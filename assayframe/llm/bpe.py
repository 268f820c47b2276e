"""Byte-level BPE encoding and decoding with padded numpy matrices.

``encode`` splits a text by the tokenizer's pattern and merges each piece's
bytes by rank.  Pieces that a worker has not met are gathered, bucketed by
length into padded matrices of token ids, and merged round by round: every row
replaces its leftmost pair of minimum rank, found through a hash table of
pairs, and is compacted by one column.  A row without a known pair is done.

Defined results: a null text has null ids and decodes to null; an empty text
has an empty list.  Repeated rows and any other columns pass through; an
existing column of the output's name is replaced.  A text is encoded whole,
whatever its length.
"""

from __future__ import annotations

import base64
import functools
import gc
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.shared import free_name, short_batches

#: Rows of a matrix and bytes of a piece in it; longer pieces merge through a heap, with the same result.
MATRIX_ROWS, MATRIX_BYTES = 50_000, 256
#: Words whose ids a worker keeps, and their greatest length.
KEPT_WORDS, KEPT_CHARS = 300_000, 64
NONE = np.int32(2**31 - 1)
#: Fixed value: the pattern that cuts a text for the vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_other_space = re.compile(r"[^\S \n]").search
_cut = re.compile(r"(?<=\S) (?=\S)").split


def cut_words(texts: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """The distinct words of ``texts`` that follow a space, without it, and the distinct first words; which of these, in turn, is at each place; each text's number of places.

    Texts are cut at each single space between two characters that aren't space:
    no piece of the pattern spans such a cut, and the space always opens the
    next piece, so words encode apart from each other.
    """
    plain, other = [], []
    for i, x in enumerate(texts):
        (plain if _cut_at_spaces(x) else other).append(i)
    lists = [pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")] if plain else []
    if other:
        lists.append(pa.array([_cut(texts[i]) for i in other], pa.large_list(pa.large_string())))
    if not lists:
        return [], [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
    coded = pa.concat_arrays([x.flatten().cast(pa.large_string()) for x in lists]).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    starts = sizes.cumsum() - sizes
    first, own = np.unique(at[starts], return_inverse=True)
    at[starts] = len(words) + own
    if other and plain:
        back = np.argsort(np.array(plain + other))
        at, sizes = at[spread(starts[back], sizes[back])], sizes[back]
    return words.tolist(), words[first].tolist(), at, sizes


def _cut_at_spaces(text: str) -> bool:
    """Whether every space of a text is a single one between two characters that aren't space."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return text.replace("\n", "").isprintable() or not _other_space(text)  # no space but " " is printable


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that start at ``starts``, one run after the other."""
    before = sizes.cumsum() - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def joined_ids(runs: list[bytes], at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids that the runs at each place give, one after the other, and how many each text has."""
    lengths = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
    return placed_ids(np.frombuffer(b"".join(runs), np.int32), lengths, at, sizes)


def placed_ids(pool: np.ndarray, lengths: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the run at each place, one after the other, and how many each text has; ``pool`` holds runs of ``lengths`` one after the other."""
    own = lengths[at]
    ends = np.concatenate(([0], own.cumsum()))[np.concatenate(([0], sizes.cumsum()))]
    return pool[spread((lengths.cumsum() - lengths)[at], own)], np.diff(ends)


def id_lists(values: np.ndarray, sizes: np.ndarray, null: np.ndarray | None = None) -> pa.ListArray:
    """A list<int32> array of runs of ids."""
    mask = None if null is None else pa.array(null, pa.bool_())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], sizes.cumsum())), pa.int32()), pa.array(values, pa.int32()), mask=mask)


class Vocabulary:
    """Ranks of byte strings, and the hash table of the pairs that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        size = 1 << max(4, (3 * len(pairs)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        left_keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        left_values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(left_keys)
        self.longest_probe = 0
        while len(left_keys):
            self.longest_probe += 1
            free = self.keys[slot] == -1
            self.keys[slot[free]] = left_keys[free]  # of several for one slot, the last stays
            won = self.keys[slot] == left_keys
            self.values[slot[won]] = left_values[won]
            left_keys, left_values, slot = left_keys[~won], left_values[~won], (slot[~won] + 1) & int(self.mask)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(40)) & self.mask).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE where the pair is unknown or padding."""
        keys = (left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)).ravel()
        slot = self._slot(keys)
        out = np.full(len(keys), NONE, np.int32)
        found = self.keys[slot] == keys
        out[found] = self.values[slot[found]]
        todo = np.flatnonzero(~found & (self.keys[slot] != -1))
        at = slot[todo]
        for _ in range(self.longest_probe):
            if not len(todo):
                break
            at = (at + 1) & int(self.mask)
            here = self.keys[at]
            found = here == keys[todo]
            out[todo[found]] = self.values[at[found]]
            go = ~found & (here != -1)
            todo, at = todo[go], at[go]
        return out.reshape(left.shape)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > MATRIX_BYTES:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault((len(piece) + 3) // 4 * 4, []).append(i)
        for width, rows in buckets.items():
            for start in range(0, len(rows), MATRIX_ROWS):
                self._merge_matrix(pieces, rows[start : start + MATRIX_ROWS], width, out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        sizes = np.array([len(pieces[i]) for i in rows])
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        ids = self.byte_ids[raw]
        ids[np.arange(width) >= sizes[:, None]] = -1
        own = np.array(rows)
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(ids):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            line = np.arange(len(ids))
            best = ranks[line, at] if ranks.shape[1] else np.full(len(ids), NONE, np.int32)
            for i in np.flatnonzero(best == NONE):
                out[own[i]] = ids[i][ids[i] >= 0]
            go = best != NONE
            if not go.any():
                return
            ids, ranks, own, at, best = ids[go], ranks[go], own[go], at[go], best[go]
            line = np.arange(len(ids))
            ids[line, at] = best
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(len(ids), -1)
            keep = np.ones(ranks.shape, bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(ids), -1)
            last = ids.shape[1] - 1
            if last:  # only the pairs on both sides of the merge are new
                left = at > 0
                ranks[line[left], at[left] - 1] = self.pair_ranks(ids[line[left], at[left] - 1], ids[line[left], at[left]])
                right = at < last
                ranks[line[right], at[right]] = self.pair_ranks(ids[line[right], at[right]], ids[line[right], at[right] + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        part, get = {i: bytes([b]) for b, i in enumerate(self.byte_ids.tolist())}, self.ranks.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(part[a] + part[b])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            part[rank] = part[a] + part[b]
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := get(part[ids[x]] + part[ids[y]])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes words, keeping the ids of those it has met after a space.

    Two generations are kept: when the younger is full it becomes the older
    one, whose words come back when they are met again, so frequent words stay.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        if pattern != PATTERN:
            raise ValueError("words can only be cut apart for the pattern of this family")
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, words: list[str], firsts: list[str]) -> list[bytes]:
        """The ids of distinct words after a space, then of distinct first words, as int32 in machine order."""
        if len(self.words) > KEPT_WORDS // 2:
            self.words, self.older = {}, self.words
        out = list(map(self.words.get, words))
        new = [i for i, x in enumerate(out) if x is None]
        for i in new:
            out[i] = self.older.get(words[i])
        cut = [self.find(f" {words[i]}") for i in new if out[i] is None] + list(map(self.find, firsts))
        distinct = list(set().union(*cut))
        ids = dict(zip(distinct, (x.tobytes() for x in self.vocabulary.merge([p.encode() for p in distinct]))))
        made = iter([b"".join(map(ids.__getitem__, own)) for own in cut])
        for i in new:
            if out[i] is None:
                out[i] = next(made)
        self.words.update((words[i], out[i]) for i in new if len(words[i]) <= KEPT_CHARS)
        return out + list(made)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.cache
def token_bytes(ranks_path: str) -> dict[int, bytes]:
    """The bytes of each id."""
    return {i: b for b, i in read_ranks(ranks_path).items()}


@functools.cache
def vocabulary(ranks_path: str) -> Vocabulary:
    """The vocabulary of a rank file: a base64 token and its rank a line."""
    return Vocabulary(read_ranks(ranks_path))


@functools.cache
def encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(vocabulary(ranks_path), pattern)


def array_slices(array: pa.Array, most_bytes: int = 2_000_000) -> Iterator[pa.Array]:
    """A string array in runs of about ``most_bytes``."""
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).cumsum()
    start, done = 0, 0
    while start < len(array):
        end = max(start + 1, int(np.searchsorted(sizes, done + most_bytes, "right")))
        yield array.slice(start, end - start)
        start, done = end, int(sizes[end - 1])


def slices(array: pa.Array, most_bytes: int = 2_000_000) -> Iterator[list[str | None]]:
    """The values of a string array in runs of about ``most_bytes``."""
    return map(pa.Array.to_pylist, array_slices(array, most_bytes))


def _batch_ids(batch: pa.Array, own: Encoder) -> pa.ListArray:
    parts = []
    gc.disable()  # a walk over all kept words for each few hundred new ones, and no cycles among them
    for texts in slices(batch):
        words, firsts, at, sizes = cut_words([x or "" for x in texts])
        values, sizes = joined_ids(own.encode(words, firsts), at, sizes)
        parts.append(id_lists(values, sizes, np.array([x is None for x in texts], bool)))
    gc.enable()
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _batch_bytes(ids: pa.ListArray, ranks_path: str) -> pa.Array:
    bytes_of = token_bytes(ranks_path).__getitem__
    return pa.array((None if x is None else b"".join(map(bytes_of, x)) for x in batch_values(ids)), pa.binary())


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Token ids of a text column, array<int>."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def bpe_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _batch_ids(batch, encoder(ranks_path, pattern))

    return bpe_ids(text)


def decode(ids: Column, ranks_path: str) -> Column:
    """The bytes that ids stand for, binary; an unknown id is an error."""

    @F.arrow_udf(T.BinaryType())
    def bpe_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _batch_bytes(batch, ranks_path)

    return bpe_bytes(ids)


def encode_and_decode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Struct of the token ids of a text column and the bytes that they stand for, made by one worker instead of two that run at once."""

    @F.arrow_udf("ids array<int>, bytes binary")
    def bpe_both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = _batch_ids(batch, encoder(ranks_path, pattern))
            yield pa.StructArray.from_arrays([ids, _batch_bytes(ids, ranks_path)], ["ids", "bytes"])

    return bpe_both(text)


def batch_values(batch: pa.ListArray) -> Iterator[list[int] | None]:
    """The lists of a list<int32> array, one at a time."""
    offsets, values, valid = batch.offsets.to_numpy(), batch.values.to_numpy(zero_copy_only=False), batch.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(batch)):
        yield values[offsets[i] : offsets[i + 1]].tolist() if valid[i] else None


def with_tokens(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", to: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of column ``text`` in column ``to``."""
    short_batches(df.sparkSession)
    return df.withColumn(to, encode(F.col(text), ranks_path, pattern))


def with_bytes(df: DataFrame, ranks_path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``df`` with the decoded bytes of column ``ids`` in column ``to``."""
    short_batches(df.sparkSession)
    return df.withColumn(to, decode(F.col(ids), ranks_path))


def with_tokens_and_bytes(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", to: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the token ids of column ``text`` in column ``to`` and their decoded bytes in another."""
    short_batches(df.sparkSession)
    both = free_name(df.columns, "__both")
    rows = df.withColumn(both, encode_and_decode(F.col(text), ranks_path, pattern))
    return rows.withColumns({to: F.col(f"{both}.ids"), decoded: F.col(f"{both}.bytes")}).drop(both)
