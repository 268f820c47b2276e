"""Token ids as Parquet list columns, for selective reads.

``encode`` uses the ``tokenizers`` library's model on the distinct pieces of texts.
``write`` deals documents out by ranges of their key, encodes each range in
order and writes Parquet through Spark's committer: the ids' list column in
dictionary or delta encoding, with row groups and pages of a chosen size, so
the writer's page indexes let a reader skip to the rows it wants and leave the
id pages alone when it reads metadata.  ``read`` gives the documents back with
the place of each in the whole sequence of ids.

Defined results: a null text is an empty one; null keys come first; rows of
equal keys follow a hash of their text, then the text; other columns named in
``keep`` are written too.  An empty table gives an empty file set that reads
back as no rows.  A text that holds an added token's string (as
``<|endoftext|>``) gets that token's id there, as the library does by default.
"""

from __future__ import annotations

import functools
import gc
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from assayframe.llm.bpe import KEPT_CHARS, PATTERN, array_slices, id_lists, placed_ids, spread
from assayframe.llm.shared import short_batches


#: Words in a generation that a worker keeps; other pieces are a tenth of that.
KEPT = 300_000
#: Bytes of text whose distinct words are looked up at once.
SLICE_BYTES = 1_500_000
#: Letters in every version of Unicode: Latin, Greek and Cyrillic; ASCII punctuation.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u04ff]"
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: What a text has that isn't cut at each of its spaces: other white space, or a space that isn't a single one between two characters that aren't space.
UNEVEN = r"[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|  | \n|\n |\A | \z"
_letters_only = re.compile(f"{LETTERS}+").fullmatch
_cut = re.compile(r"(?<=\S) (?=\S)").split


@functools.cache
def _closes_stem() -> np.ndarray:
    """Of each pair of bytes, whether a letter of LETTERS or an ASCII digit ends there, so that punctuation after it is a piece apart."""
    out = np.zeros((256, 256), bool)
    for c in map(chr, range(0x800)):
        if re.match(f"{LETTERS}|[0-9]", c):
            *lead, last = c.encode()
            out[lead or slice(None), last] = True
    return out


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next free code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Kept:
    """The ids that ``make`` gave for strings met lately, packed in one array.

    Two generations of about ``limit`` strings are held: when the younger is
    full it becomes the older one, and strings met again come back from there.
    """

    def __init__(self, make: Callable[[list[str]], list[list[int]]], limit: int):
        self.make, self.limit = make, limit
        self.young = self.old = self._empty()

    @staticmethod
    def _empty() -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """Row of each string, all ids, and each row's number of ids."""
        return {}, np.zeros(0, np.int32), np.zeros(0, np.int64)

    def runs(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct strings, one after the other, and how many each has."""
        if len(self.young[0]) > self.limit or len(self.young[1]) > 8 * self.limit:
            self.young, self.old = self._empty(), self.young
        at, ids, sizes = self.young
        rows = np.fromiter(map(at.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(rows < 0)
        if len(new):
            own = list(map(keys.__getitem__, new.tolist()))
            old_at, old_ids, old_sizes = self.old
            old = np.fromiter(map(old_at.get, own, repeat(-1)), np.int64, len(own))
            made = self.make(list(compress(own, (old < 0).tolist())))
            back = old[old >= 0]
            back_ids, _ = placed_ids(old_ids, old_sizes, back, np.zeros(0, np.int64))
            made_ids, made_sizes = flat(made)
            order = np.concatenate((np.flatnonzero(old >= 0), np.flatnonzero(old < 0)))
            rows[new[order]] = len(sizes) + np.arange(len(new))
            short = [len(k) <= KEPT_CHARS for k in own]
            at.update(zip(own, rows[new].tolist()) if all(short) else zip(compress(own, short), compress(rows[new].tolist(), short)))
            ids, sizes = np.concatenate((ids, back_ids, made_ids)), np.concatenate((sizes, old_sizes[back], made_sizes))
            self.young = at, ids, sizes
        return placed_ids(ids, sizes, rows, np.zeros(0, np.int64))[0], sizes[rows]


class LibraryEncoder:
    """Encodes texts as the library does, asking its model for the ids of each distinct piece.

    Arrow cuts texts into words and the punctuation after these; only distinct
    words that are more than letters go through the pattern.  A text that holds
    one of the tokenizer's added tokens goes to the library whole, which cuts
    it there.
    """

    def __init__(self, path: str, pattern: str):
        if pattern != PATTERN:
            raise ValueError("words can only be cut apart for the pattern of this family")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.find = self.tokenizer.model, regex.compile(pattern).findall
        self.letters = byte_letters() | {0xFF: "\n"}  # no text has this byte, and the line end is no byte's stand-in
        self.words, self.short = Kept(self._words, KEPT), Kept(self._pieces, KEPT // 10)

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece of the pattern."""
        letters = b"\xff".join([x.encode() for x in pieces]).decode("latin1").translate(self.letters)
        return [[t.id for t in tokens] for tokens in map(self.model.tokenize, letters.split("\n"))] if pieces else []

    def _words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word after a space, or after what is before its line end."""
        odd = [not _letters_only(x) for x in words]
        plain = iter(self._pieces([f" {x}" for x, o in zip(words, odd) if not o]))
        cut = iter(self._texts([x if x[:1] == "\n" else f" {x}" for x in compress(words, odd)]))
        return [next(cut if o else plain) for o in odd]

    def _texts(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, cut by the pattern."""
        cut = list(map(self.find, texts))
        distinct = list(set().union(*cut))
        ids, sizes = self.short.runs(distinct)
        ids, ends = ids.tolist(), sizes.cumsum().tolist()
        runs = {x: ids[a:b] for x, a, b in zip(distinct, [0, *ends], ends)}
        return [[*chain.from_iterable(map(runs.__getitem__, own))] for own in cut]

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        texts = texts.cast(pa.large_string())
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        words, sizes = cut_texts(pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts))
        starts = sizes.cumsum() - sizes
        first = np.zeros(len(words), bool)
        first[starts] = True
        stems, marks, marked = stems_and_marks(words.filter(pa.array(~first)))
        stem_ids, stem_sizes = self.words.runs(stems.dictionary.to_numpy(zero_copy_only=False).tolist())
        mark_ids, mark_sizes = self.short.runs(marks.dictionary.to_pylist())
        runs = self._texts(words.take(pa.array(starts)).to_pylist())
        for i in np.flatnonzero(whole).tolist():
            runs[i] = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
        more_ids, more_sizes = flat(runs if end is None else [*runs, [end]])
        pool, lengths = np.concatenate((stem_ids, mark_ids, more_ids)), np.concatenate((stem_sizes, mark_sizes, more_sizes))

        extra = np.zeros(len(words), np.int64)  # runs of each place besides its word's
        extra[~first] = marked
        if end is not None:
            extra[starts + sizes - 1] += 1
        after = (1 + extra).cumsum()
        at = np.empty(int(after[-1]) if len(after) else 0, np.int64)
        place = after - 1 - extra
        at[place[first]] = len(stem_sizes) + len(mark_sizes) + np.arange(len(texts))
        at[place[~first]] = stems.indices.to_numpy()
        at[place[~first][marked] + 1] = len(stem_sizes) + marks.indices.to_numpy()
        ends = after[starts + sizes - 1]
        if end is not None:
            at[ends - 1] = len(lengths) - 1
        return placed_ids(pool, lengths, at, np.diff(ends, prepend=0))


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, one text after the other, and how many each has, one at least.

    Texts are cut at each single space between two characters that aren't space,
    and where all spaces are such also before single line ends: no piece of the
    pattern spans such a cut.  The space, which is left out, opens the piece
    after it; a line end is a piece.
    """
    uneven = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
    even = pc.replace_substring_regex(texts.filter(pa.array(~uneven)), r"([^\n])\n([^\n])", "\\1 \n\\2")
    rest = pa.array([_cut(x) for x in texts.filter(pa.array(uneven)).to_pylist()], pa.large_list(pa.large_string()))
    lists = [pc.split_pattern(even, " "), rest]
    words = pa.concat_arrays([x.flatten().cast(pa.large_string()) for x in lists])
    sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
    if uneven.any():
        back = np.argsort(np.argsort(uneven, kind="stable"))
        words, sizes = words.take(pa.array(spread((sizes.cumsum() - sizes)[back], sizes[back]))), sizes[back]
    return words, sizes


def stems_and_marks(words: pa.Array) -> tuple[pa.DictionaryArray, pa.DictionaryArray, np.ndarray]:
    """Words without the ASCII punctuation at their end, the punctuation of those that have it, and which these are.

    A word whose punctuation may belong to the piece before it stays whole.
    """
    ends = _ends(words)
    stems = pc.ascii_rtrim(words, characters=MARKS)
    sizes = np.diff(_ends(stems))
    marked = sizes < np.diff(ends)
    if not marked.any():
        return words.dictionary_encode(), pa.array([], words.type).dictionary_encode(), marked
    raw = np.frombuffer(words.buffers()[2], np.uint8)
    last = ends[:-1] + sizes - 1
    stays = marked & ~((sizes > 0) & _closes_stem()[raw[np.maximum(last - 1, 0)], raw[np.maximum(last, 0)]])
    if stays.any():
        stems = pc.if_else(pa.array(stays), words, stems)
        marked &= ~stays
    lengths = (np.diff(ends) - sizes)[marked]
    offsets = np.concatenate(([0], lengths.cumsum()))
    data = raw[spread((ends[:-1] + sizes)[marked], lengths)]
    marks = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data))
    return stems.dictionary_encode(), marks.dictionary_encode(), marked


def _ends(strings: pa.Array) -> np.ndarray:
    """Where each of large strings starts in their buffer, and where the last one ends."""
    return np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)


def flat(runs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids one after the other, and how many each has."""
    return np.fromiter(chain.from_iterable(runs), np.int32), np.fromiter(map(len, runs), np.int64, len(runs))


@functools.cache
def library_encoder(path: str, pattern: str) -> LibraryEncoder:
    return LibraryEncoder(path, pattern)


def encode(text: Column, path: str, pattern: str, end_id: int | None = None) -> Column:
    """Struct of the token ids of a text column, array<int>, with ``end_id`` appended, and the number of ids before them in their partition."""
    @F.arrow_udf("token_ids array<int>, part_start long")
    def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, done = library_encoder(path, pattern), 0
        for batch in batches:
            gc.disable()  # no cycles among the kept words, only a long walk over them
            parts = [own.encode(texts, end_id) for texts in array_slices(pc.fill_null(batch, ""), SLICE_BYTES)]
            gc.enable()
            sizes = np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
            lists = id_lists(np.concatenate([np.zeros(0, np.int32), *(v for v, _ in parts)]), sizes)
            yield pa.StructArray.from_arrays([lists, pa.array(done + sizes.cumsum() - sizes, pa.int64())], ["token_ids", "part_start"])
            done += int(sizes.sum())

    return token_ids(text)


def write(
    df: DataFrame,
    out: str,
    tokenizer_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int | None = 0,
    keep: tuple[str, ...] = (),
    delta: bool = False,
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Writes ``key``, ``keep``, ``n_tokens`` and ``token_ids`` to ``out`` in ascending order of ``key``, part by part.

    ``delta``: ids in delta encoding instead of a dictionary.
    """
    short_batches(df.sparkSession)
    rows = df.select(key, *keep, F.coalesce(text, F.lit("")).alias("__text"))
    order = [F.col(key), F.xxhash64("__text")]  # ranges of one key are dealt out by their texts
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "__text")
    rows = rows.withColumn("__ids", encode(F.col("__text"), tokenizer_path, pattern, end_id))
    writer = rows.select(F.spark_partition_id().alias("part"), "__ids.part_start", key, *keep, F.size("__ids.token_ids").cast("long").alias("n_tokens"), "__ids.token_ids").write
    writer = writer.option("compression", "lz4_raw").option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes).option("parquet.dictionary.page.size", 1 << 20)
    if delta:
        writer = writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary#token_ids.list.element", "false")
    writer.parquet(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``write``, with ``start``: the number of ids of all documents before each.

    The parts' offsets come from the metadata columns alone.  They are one row
    for each part that was written, the only rows that meet in one place, and
    small enough to broadcast at any size of the input.
    """
    docs = spark.read.parquet(path)
    sums = docs.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(offsets), "part").withColumn("start", F.col("base") + F.col("part_start")).drop("part", "part_start", "base")


@F.arrow_udf(T.LongType())
def ids_crc32(batch: pa.Array) -> pa.Array:
    """Unsigned crc32 of each list's ids as little-endian unsigned 32-bit integers; null of null."""
    offsets = batch.offsets.to_numpy()
    raw = np.ascontiguousarray(batch.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
    crcs = [zlib.crc32(raw[offsets[i] : offsets[i + 1]]) for i in range(len(batch))]
    return pa.array(crcs, pa.int64(), mask=batch.is_null().to_numpy(zero_copy_only=False))
