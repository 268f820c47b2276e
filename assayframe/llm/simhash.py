"""SimHash near-duplicates through Golay-code fuzzy hashing.

``fingerprint`` sums the bits of the XXH64 hashes of a text's word shingles.
Of two fingerprints of 64 bits that differ in at most two, cut into three
segments, at least one segment is the same in both, and the next one differs
in two bits at most.  The perfect Golay code of 23 bits makes the next segment
a fuzzy key: its decoder gives the indices of all codewords at distance four
or less (one of them, or six), and two words of at most two differing bits
always share one, since a word halfway between lies within three bits of some
codeword.  So ``keys`` joins an exact segment with each codeword index near the
next, three times round; candidates meet on a key and are verified.

Keys with many distinct fingerprints are not joined pair by pair: their
members meet on all values one bit away instead, which links exactly the same
components and never puts more than 65 in a group.

Defined results: a null or empty text, or one of white space, has fingerprint
zero, linked like any other; a text of fewer words than a shingle is one
shingle.  Equal fingerprints are one class and are joined once, however many
rows share them.  Rows of a null key get a fingerprint and a component like any
others; a component without any key has a null component id.  An empty table
gives no rows.  Columns other than key and text are not looked at.

``first_of_groups`` takes groups of similar texts (Jaccard similarity of their
word shingles), of which texts of near fingerprints are the first candidates
and texts that share a rare shingle all others.  Texts without words are alike,
and so are texts of no more words than a shingle that have the same ones.  All
columns stay, whatever their names; a group of any size is joined through heads.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.bpe import slices
from assayframe.llm.graph import components
from assayframe.llm.shared import drop_stored, free_name, key_marks, may_hold, settled, short_batches, stored

#: Generator polynomial of the binary Golay code of 23 bits, its length and its message length.
GOLAY, GOLAY_N, GOLAY_K = 0b101011100011, 23, 12
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Keys of more distinct fingerprints than this are linked through single-bit neighbours.
PAIRED = 32
ROWS = 1 << 16


def shingle_bits(text: str, width: int, seed: int) -> int:
    """The fingerprint of a text, unsigned."""
    words = text.encode().translate(_LOWER).split()  # bytes split at ASCII white space alone
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = iter((hashed(b" ".join(words), seed),))
    else:
        hashes = (hashed(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(width))))
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, ROWS):
        some = np.fromiter(hashes, "<u8", min(ROWS, n - start))
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: Column, width: int = 3, seed: int = 42) -> Column:
    """64-bit SimHash of a text column as a (signed) long."""

    @F.arrow_udf(T.LongType())
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bits = [shingle_bits(x or "", width, seed) for texts in slices(batch) for x in texts]
            yield pa.array(np.array(bits, np.uint64).view(np.int64))

    return simhash(text)


@functools.cache
def _near() -> tuple[np.ndarray, np.ndarray]:
    """Of each syndrome: the error patterns of up to four bits that have it (six at most, padded with zeros), and their number."""
    words = np.concatenate([np.array([sum(1 << i for i in c) for c in combinations(range(GOLAY_N), k)], np.int64) for k in range(5)])
    syndromes = _syndrome(words)
    patterns, found = np.zeros((1 << (GOLAY_N - GOLAY_K), 6), np.int64), np.zeros(1 << (GOLAY_N - GOLAY_K), np.int64)
    for word, s in zip(words.tolist(), syndromes.tolist()):
        patterns[s, found[s]] = word
        found[s] += 1
    return patterns, found


def _syndrome(words: np.ndarray) -> np.ndarray:
    left = words.copy()
    for bit in range(GOLAY_N - 1, GOLAY_N - GOLAY_K - 1, -1):
        left ^= np.where(left >> bit & 1, GOLAY << (bit - (GOLAY_N - GOLAY_K)), 0)
    return left


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within four bits of each word (padded), and their number."""
    patterns, found = _near()
    s = _syndrome(words)
    return (words[:, None] ^ patterns[s]) >> (GOLAY_N - GOLAY_K), found[s]


def key_lists(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each fingerprint, one after the other, and their number."""
    parts = [(prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys, valid = [], []
    for i, exact in enumerate(parts):
        index, found = codewords(parts[(i + 1) % 3])
        keys.append(i << 40 | exact[:, None] << GOLAY_K | index)
        valid.append(np.arange(6) < found[:, None])
    valid = np.concatenate(valid, axis=1)
    return np.concatenate(keys, axis=1)[valid], valid.sum(axis=1)


@F.arrow_udf(T.ArrayType(T.LongType()))
def keys(prints: pa.Array) -> pa.Array:
    """The Golay keys of each fingerprint: two of them share a key if they differ in two bits at most."""
    own, counts = key_lists(prints.to_numpy(zero_copy_only=False).view(np.uint64))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], counts.cumsum())), pa.int32()), pa.array(own))


def links(prints: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints in column ``fp`` of at most two differing bits.

    Keys of up to PAIRED fingerprints give all their verified pairs, the others a
    connected set of links for each value one bit away; every link is a true one.
    """
    keyed = prints.select("fp", F.explode(keys("fp")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(keyed.join(sizes, "key"), "simhash-keys")
    few = shared.where(F.col("n") <= PAIRED).select("key", "fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    many = shared.where(F.col("n") > PAIRED).select("fp").distinct()
    around = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    meeting = many.select("fp", F.explode(around).alias("mid")).groupBy("mid").agg(F.collect_set("fp").alias("own")).where(F.size("own") > 1)
    stars = meeting.select(F.array_min("own").alias("a"), F.explode("own").alias("b")).where("a != b")
    return pairs.union(stars).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``key, fp, component_id`` for every row: the smallest key that links of at most two differing bits reach."""
    short_batches(df.sparkSession)
    docs = stored(df.select(F.col(key).alias("key"), fingerprint(F.col(text), width, seed).alias("fp")), "simhash")
    classes = docs.groupBy("fp").agg(F.min("key").alias("least"))
    roots = components(links(docs.select("fp").distinct()), "a", "b")
    linked = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = stored(linked, "simhash-classes")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    found = docs.join(linked.join(least, "root").select("fp", "component_id"), "fp")
    return found.select(F.col("key").alias(key), "fp", "component_id")


# Groups of similar texts


def word_bits(words: list[bytes], seed: int = 42) -> int:
    """The fingerprint of the distinct words of a text, unsigned: of texts with few words changed it differs in few bits."""
    own = set(words)
    if not own:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in own), "<u8", len(own))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), ROWS):
        ones += np.unpackbits(hashes[start : start + ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def shingles(words: list[bytes], width: int) -> Iterator[bytes]:
    """Runs of ``width`` words, repeats included; the whole sequence if it has no more."""
    if len(words) <= width:
        return iter((b" ".join(words),))
    return map(b" ".join, zip(*(words[i:] for i in range(width))))


def shingle_tokens(words: list[bytes], width: int) -> np.ndarray:
    """Hashes of the distinct ``shingles`` of a text, ascending."""
    found = np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, width)), np.uint64)
    return np.unique(found & np.uint64((1 << TOKEN_BITS) - 1)).view(np.int64)


def token_bits(tokens: np.ndarray) -> np.ndarray:
    """SKETCH bits of a set of shingles, each of which sets one: two sets differ in as many shingles as bits, or more."""
    bits = np.zeros(SKETCH, np.uint8)
    bits[tokens & (SKETCH - 1)] = 1
    return np.packbits(bits).view(np.int64)


def least_apart(a: Column, b: Column) -> Column:
    """In how many shingles two sets differ at least, by their ``token_bits``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def rare_length(n, least: float):
    """So many first shingles of n, in any order common to all texts, hold one that a text of at least that similarity has among its own first ones."""
    return n - np.ceil(least * n - 1e-9).astype(np.int64) + 1


def marks(text: Column, common: np.ndarray, width: int, least: float) -> Column:
    """Struct of a text's word fingerprint, its number of distinct shingles, their ``token_bits`` and the first ``rare_length`` of them; ``common`` ones (ascending frequency) come last."""
    known = np.sort(common)
    place = np.argsort(common)

    @F.arrow_udf("fp long, n int, bits array<long>, rare array<long>")
    def text_marks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            prints, sizes, bits, firsts = [], [], [], []
            for texts in slices(batch):
                for x in texts:
                    words = (x or "").encode().translate(_LOWER).split()
                    own = shingle_tokens(words, width)
                    n = len(own)
                    bits.append(token_bits(own))
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        own = np.sort(np.where(known[at] == own, (1 << TOKEN_BITS) + place[at], own))
                    prints.append(word_bits(words))
                    sizes.append(n)
                    firsts.append(own[: int(rare_length(np.float64(n), least))])
            ends = np.cumsum([0, *map(len, firsts)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *firsts])))
            maps = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * (SKETCH // 64), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *bits])))
            yield pa.StructArray.from_arrays([pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), maps, lists], ["fp", "n", "bits", "rare"])

    return text_marks(text)


def common_tokens(rows: DataFrame, width: int) -> np.ndarray:
    """The commonest shingles of some of the texts in column ``text``, ascending: they only order shingles, so the result doesn't depend on them."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def tokens(batch: pa.Array) -> pa.Array:
        own = [shingle_tokens((x or "").encode().translate(_LOWER).split(), width) for texts in slices(batch) for x in texts]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *own])))

    some = rows.sample(min(1.0, SAMPLED / max(1, rows.count())), 42)
    counts = some.select(F.explode(tokens("text")).alias("token")).groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") >= COMMON)
    found = counts.orderBy(F.desc("c"), "token").limit(LISTED).collect()
    return np.array([r.token for r in reversed(found)], np.int64)


def resemblance(a: Column, b: Column, width: int) -> Column:
    """Jaccard similarity of the word shingles of two texts."""

    @F.arrow_udf(T.DoubleType())
    def jaccard(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, q = None, frozenset()
        own = lambda x: frozenset(shingles((x or "").encode().translate(_LOWER).split(), width))
        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                x, y = x.as_py(), y.as_py()
                if y != last:  # rows come in order of the right text
                    last, q = y, own(y)
                p = own(x)
                both = len(p & q)
                out.append(both / (len(p) + len(q) - both))
            yield pa.array(out, pa.float64())

    return jaccard(a, b)


#: Documents whose shingles are counted for the order of shingles, how often one is common, and the most that are listed (8 bytes each).
SAMPLED, COMMON, LISTED = 4_000, 4, 20_000
#: Shingle hashes have so many bits; the common ones follow all others.
TOKEN_BITS = 62
#: Shingles of more texts than this are crowded, and so is a camp of more; of so little similarity to all references is no text in its camp.
CROWD, LIKE_HEAD = 64, 0.4
#: References of a camp at most, the similarity to the text that one is made around, and the sample they are made from: texts, and shingles in all.
REFERENCES, LIKE_SEED, SAMPLE_TEXTS, SAMPLE_TOKENS = 8, 0.5, 256, 400_000
#: Shingles whose holders are in memory as a matrix at once.
REFERENCE_COLUMNS = 4096
#: Bits by which pairs of texts too far apart are told without their texts.
SKETCH = 4096
#: Texts of a camp that a task measures at once.
CHUNK_BYTES = 4 << 20
#: Row ids, of 8 bytes each or 16 with another, are broadcast up to this number, keys with digests up to another, and texts of heads up to so many bytes; else they are joined by a shuffle.
BROADCAST_IDS, BROADCAST_NAMES, BROADCAST_TEXTS = 500_000, 150_000, 8 << 20


def _small(ids: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if it has no more rows than BROADCAST_IDS."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


@dataclass
class Texts:
    """The texts of a table by their ids: read where they are, never copied as a whole."""

    given: DataFrame  # key, digest, text: of all rows
    named: DataFrame  # id, key, digest: of one row of each text
    bits: DataFrame  # id, n, bits
    repeated: bool  # rows may have key and digest in common

    def of(self, ids: DataFrame, name: str) -> DataFrame:
        """``ids`` (stored, with other columns) with their ``text``, stored."""
        wanted = stored(self.named.join(_small(ids), "id"), f"{name}-named")
        given, names = self.given, wanted.withColumnsRenamed({"key": "__key", "digest": "__digest"})
        if wanted.count() <= BROADCAST_NAMES:
            names = F.broadcast(names)
        else:  # the others' texts aren't shuffled
            given = may_hold(given, stored(key_marks(wanted, "key", "digest"), f"{name}-marks"), "key", "digest")
        held = given.join(names, F.col("key").eqNullSafe(F.col("__key")) & (F.col("digest") == F.col("__digest"))).select(*ids.columns, "text")
        return stored(held.dropDuplicates(["id"]) if self.repeated else held, f"{name}-texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def _with_texts(pairs: DataFrame, texts: Texts, name: str) -> DataFrame:
    """Stored pairs ``a, b`` of ids with their texts ``x, y``."""
    held = texts.of(stored(_ends(pairs), f"{name}-ids"), name)
    left = held.withColumnsRenamed({"id": "a", "text": "x"})
    heads = stored(held.join(_small(stored(pairs.select(F.col("b").alias("id")).distinct(), f"{name}-heads")), "id", "left_semi"), f"{name}-head-texts")
    size = heads.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    right = heads.withColumnsRenamed({"id": "b", "text": "y"})
    return pairs.join(left, "a").join(F.broadcast(right) if size <= BROADCAST_TEXTS else right, "b")


def _possible(pairs: DataFrame, bits: DataFrame, least: float, name: str) -> DataFrame:
    """The pairs ``a, b`` of ids that can be as similar by what their ``bits`` differ in: no other is, so that their texts needn't be moved."""
    pairs = stored(pairs, f"{name}-candidates")
    held = stored(bits.join(_small(stored(_ends(pairs), f"{name}-candidate-ids")), "id", "left_semi"), f"{name}-bits")
    both = pairs.join(held.withColumnsRenamed({"id": "a", "n": "x", "bits": "p"}), "a").join(held.withColumnsRenamed({"id": "b", "n": "y", "bits": "q"}), "b")
    return both.where(least_apart(F.col("p"), F.col("q")) <= _ratio(least) * (F.col("x") + F.col("y")) + 1e-9).select("a", "b")


def _verified(pairs: DataFrame, texts: Texts, width: int, least: float, name: str) -> DataFrame:
    """The pairs ``a, b`` of ids whose texts resemble each other, stored; nothing else that it takes stays."""

    def links() -> DataFrame:
        possible = settled(lambda: _possible(pairs.select("a", "b"), texts.bits, least, name), f"{name}-pairs")
        return _with_texts(possible, texts, name).where(resemblance(F.col("x"), F.col("y"), width) >= least).select("a", "b")

    return settled(links, f"{name}-links")


def _rooted(texts: DataFrame, links: DataFrame) -> DataFrame:
    """``texts`` (column ``id``) with ``root``: the smallest id that links reach."""
    roots = _small(stored(components(links, "a", "b"), "similar-roots"))
    return texts.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")


def _sized(least: float) -> Column:
    """Texts of x and y shingles can be as similar."""
    return F.least("x", "y") >= least * F.greatest("x", "y") - 1e-9


def _mixed(rooted: DataFrame) -> DataFrame:
    """``token, id, n, root, crowded`` of the rare shingles that texts of several groups have among theirs; ``crowded`` ones are of more than CROWD texts."""
    keyed = rooted.select("id", "n", "root", F.explode("rare").alias("token"))
    several = keyed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    several = stored(several.select("token", F.when(F.col("size") > CROWD, F.col("size")).alias("crowded")), "similar-several")  # so that the tokens aren't shuffled for both at once
    return keyed.join(several, "token")


def _best_heads(mixed: DataFrame, least: float) -> DataFrame:
    """Pairs ``a, b``: each text and that head of its buckets with which it shares most of them; a bucket's head is its text of the smallest root.

    Crowded buckets have their camps' heads.
    """
    mixed = mixed.where("crowded is null")
    heads = mixed.groupBy("token").agg(F.min(F.struct("root", "id", "n")).alias("head"))
    met = mixed.join(heads, "token").where(F.col("root") != F.col("head.root"))
    met = met.select(F.col("id").alias("a"), F.col("n").alias("x"), F.col("head.id").alias("b"), F.col("head.n").alias("y")).where(_sized(least))
    counted = met.groupBy("a", "b").agg(F.count("*").alias("c"))
    return counted.groupBy("a").agg(F.max(F.struct("c", "b")).alias("best")).select("a", "best.b")


def _tokens(texts: pa.ChunkedArray, width: int) -> Iterator[np.ndarray]:
    return (shingle_tokens((x.as_py() or "").encode().translate(_LOWER).split(), width) for x in texts)


def references(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Up to REFERENCES sets of shingles that are central among given ones: what most of those hold that are like the one with the most like it, over and over with the rest."""
    ends = np.cumsum([0, *map(len, sets)])
    every, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both, sizes = np.zeros((len(sets), len(sets)), np.float32), np.diff(ends).astype(np.float32)
    np.fill_diagonal(both, sizes)
    shared = np.flatnonzero(times > 1)
    order = np.argsort(place, kind="stable")  # sets' numbers, token by token
    owner, first = np.repeat(np.arange(len(sets)), np.diff(ends))[order], np.concatenate(([0], np.cumsum(times)))
    for start in range(0, len(shared), REFERENCE_COLUMNS):  # of all tokens at once the matrix would take hundreds of MB
        some = shared[start : start + REFERENCE_COLUMNS]
        held = np.zeros((len(sets), len(some)), np.float32)
        for column, k in enumerate(some.tolist()):
            held[owner[first[k] : first[k + 1]], column] = 1
        part = held @ held.T
        np.fill_diagonal(part, 0)
        both += part
    like = both >= LIKE_SEED * (sizes[:, None] + sizes[None, :] - both)
    free, out = np.ones(len(sets), bool), []
    while free.any() and len(out) < REFERENCES:
        own = free & like[int((like[:, free].sum(axis=1) * free).argmax())]
        if out and own.sum() < max(2, len(sets) // 32):
            break
        most = np.bincount(np.concatenate([place[ends[i] : ends[i + 1]] for i in np.flatnonzero(own)]), minlength=len(every))
        out.append(every[most * 2 > own.sum()])
        free &= ~own
    return out


def _members(mixed: DataFrame, texts: Texts) -> DataFrame:
    """``id, camp, chunk, text``: the texts of crowded buckets, in camps of over CROWD texts and chunks of about CHUNK_BYTES.

    A text's camp is the head of most of its crowded buckets, a bucket's head
    the text whose rare shingles are the most crowded ones.
    """
    crowded = mixed.where("crowded is not null").select("token", "id", "n", "crowded")
    central = _small(stored(crowded.groupBy("id").agg((F.sum(F.log("crowded")) / F.max("n")).alias("central")), "similar-central"))
    heads = crowded.join(central, "id").groupBy("token").agg(F.max(F.struct("central", "id")).alias("head")).select("token", F.col("head.id").alias("camp"))
    counted = crowded.join(_small(stored(heads, "similar-crowd-heads")), "token").groupBy("id", "camp").agg(F.count("*").alias("c"))
    members = stored(counted.groupBy("id").agg(F.max(F.struct("c", "camp")).alias("best")).select("id", "best.camp"), "similar-members")
    large = members.groupBy("camp").agg(F.count("*").alias("c")).where(F.col("c") > CROWD).select("camp")
    held = texts.of(stored(members.join(large, "camp"), "similar-large-camps"), "similar-camp")
    sizes = held.groupBy("camp").agg(F.count("*").alias("texts"), F.ceil(F.sum(F.octet_length("text") + 64) / CHUNK_BYTES).alias("chunks"))
    held = held.join(_small(stored(sizes, "similar-camp-sizes")), "camp").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
    return held.select("id", "camp", "text", "texts", "chunks", "chunk")


def _central_sets(held: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """``camp, ref, tokens, bits``: the references of each camp, from a bounded sample of its texts; ``known`` has ``id, n, bits, camp, texts``."""

    def chosen(drawn: pa.Table) -> pa.Table:
        drawn = drawn.take(pa.array(np.argsort(drawn.column("id").to_numpy())))
        sets, room = [], SAMPLE_TOKENS
        for own in _tokens(drawn.column("text"), width):
            room -= len(own)
            if room < 0 and sets:
                break
            sets.append(own)
        found = references(sets)
        return pa.table({"camp": pa.array([drawn.column("camp")[0].as_py()] * len(found), pa.int64()), "ref": pa.array(range(len(found)), pa.int32()), "tokens": pa.array(found, pa.list_(pa.int64())), "bits": pa.array([token_bits(x) for x in found], pa.list_(pa.int64()))})

    def sociable(drawn: pa.Table) -> pa.Table:
        drawn = drawn.take(pa.array(np.argsort(drawn.column("id").to_numpy())))
        n = drawn.column("n").to_numpy()
        bits = np.unpackbits(np.array(drawn.column("bits").to_pylist(), np.int64).view(np.uint8), axis=1).astype(np.float32)
        apart = bits.sum(axis=1)[:, None] + bits.sum(axis=1)[None, :] - 2 * (bits @ bits.T)
        like = apart <= _ratio(LIKE_SEED) * (n[:, None] + n[None, :])
        np.fill_diagonal(like, False)
        keep = like.any(axis=1)
        keep[0] |= not keep.any()
        kept = np.flatnonzero(keep)
        keep[kept[1:]] = n[kept].cumsum()[1:] <= SAMPLE_TOKENS  # the references are made from no more
        return drawn.select(["id"]).filter(pa.array(keep))

    # a text that by its bits is like no other of the sample has no part in a reference
    drawn = known.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) * F.col("texts") < F.lit(SAMPLE_TEXTS << 20))
    wanted = stored(drawn.select("id", "camp", "n", "bits").groupBy("camp").applyInArrow(sociable, "id long"), "similar-sample")
    drawn = held.select("id", "camp", "text").join(_small(wanted), "id", "left_semi")
    return drawn.groupBy("camp").applyInArrow(chosen, "camp long, ref int, tokens array<long>, bits array<long>")


def _for_chunks(sets: DataFrame, held: DataFrame) -> DataFrame:
    """References of camps once for each ``chunk``."""
    chunks = held.groupBy("camp").agg(F.max("chunks").alias("chunks")).withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)"))).drop("chunks")
    return sets.join(chunks, "camp")


def _by_chunk(held: DataFrame, sets: DataFrame, width: int, to: str, told) -> DataFrame:
    """What ``told`` gives of each text of a chunk, its shingles and its camp's references."""

    def chunk(texts: pa.Table, refs: pa.Table) -> pa.Table:
        central = dict(zip(refs.column("ref").to_pylist(), (np.array(x, np.int64) for x in refs.column("tokens").to_pylist())))
        rows = [row for at, own in enumerate(_tokens(texts.column("text"), width)) for row in told(texts, at, own, central)]
        return pa.table({f.name: pa.array([row[f.name] for row in rows], f.type) for f in schema})

    schema = pa.schema(TOLD[to])
    held, sets = held.drop("texts", "chunks"), sets.drop("bits")
    return held.groupBy("camp", "chunk").cogroup(sets.groupBy("camp", "chunk")).applyInArrow(chunk, ", ".join(f"{f.name} {SQL_TYPES[f.type]}" for f in schema))


TOLD = {
    "distances": [("id", pa.int64()), ("camp", pa.int64()), ("n", pa.int32()), ("far", pa.list_(pa.int32())), ("of", pa.list_(pa.int32()))],
    "differences": [("id", pa.int64()), ("ref", pa.int32()), ("only", pa.list_(pa.int64()))],
}
SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>"}


def _distances(texts: pa.Table, at: int, own: np.ndarray, central: dict[int, np.ndarray]) -> list[dict]:
    """In how many shingles a text differs from each reference, in their order."""
    refs = [central[k] for k in sorted(central)]
    far = [len(own) + len(c) - 2 * len(np.intersect1d(own, c, assume_unique=True)) for c in refs]
    return [{"id": texts.column("id")[at].as_py(), "camp": texts.column("camp")[at].as_py(), "n": len(own), "far": far, "of": [len(c) for c in refs]}]


def _differences(texts: pa.Table, at: int, own: np.ndarray, central: dict[int, np.ndarray]) -> list[dict]:
    """In which shingles a text differs from the references wanted."""
    return [{"id": texts.column("id")[at].as_py(), "ref": k, "only": np.setxor1d(own, central[k], assume_unique=True)} for k in texts.column("wanted")[at].as_py()]


def _ratio(least: float) -> float:
    """As similar texts of x and y shingles differ in this times (x + y) at most."""
    return (1 - least) / (1 + least)


def _placed(held: DataFrame, known: DataFrame, sets: DataFrame, width: int, least: float) -> DataFrame:
    """``id, camp, ref, n, d, over, nearest, best``: how far each text of a camp is from each reference, ``over`` what texts alike may differ in.

    ``best`` is the least ``over`` of any text at the reference.  Texts that are
    unlike all references are in no camp.
    """
    # texts that by their bits are unlike all references are in no camp, so they aren't moved
    refs = sets.groupBy("camp").agg(F.collect_list(F.struct(F.size("tokens").alias("of"), "bits")).alias("refs"))
    may = F.exists("refs", lambda x: least_apart(F.col("bits"), x["bits"]) <= _ratio(LIKE_HEAD) * (F.col("n") + x["of"]))
    likely = stored(known.select("id", "camp", "n", "bits").join(_small(stored(refs, "similar-reference-bits")), "camp").where(may).select("id"), "similar-likely")
    far = stored(_by_chunk(held.join(_small(likely), "id", "left_semi"), _for_chunks(sets, held), width, "distances", _distances), "similar-distances")
    each = far.select("id", "camp", "n", F.posexplode(F.arrays_zip("far", "of")).alias("ref", "p"))
    each = each.select("id", "camp", "n", "ref", F.col("p.far").alias("d"), (F.col("p.far") - _ratio(least) * F.col("n")).alias("over"), (F.col("p.far") <= _ratio(LIKE_HEAD) * (F.col("n") + F.col("p.of"))).alias("like"))
    near = each.where("like").groupBy("id").agg(F.min(F.struct("d", "ref"))["ref"].alias("nearest"))
    each = each.join(near, "id").drop("like")
    best = each.groupBy("camp", "ref").agg(F.min(F.struct("over", "id")).alias("best"))
    return each.join(best, ["camp", "ref"])


def _within_camps(held: DataFrame, sets: DataFrame, placed: DataFrame, roots: DataFrame, width: int, least: float) -> DataFrame:
    """Pairs ``a, b`` of texts of one camp and different groups that can be as similar.

    What two texts differ in is in what each differs from a reference, but not
    in both.  So a and b share at least (over_a + over_b) / 2 of these
    differences, and if that is none they are alike: all such texts are in the
    group of the reference's ``best`` one.  A pair of two groups has a side that
    this group doesn't hold, at the reference next to either; it shares more
    than that side's part with ``best``, and so one of the rarest differences.
    A text comes to a reference next to others only if it is near enough to be
    like one of these.
    """
    r, slack, at = _ratio(least), 1e-9, ["camp", "ref"]
    rooted = placed.join(roots.select("id", "root"), "id").join(roots.select(F.col("id").alias("best_id"), F.col("root").alias("of_best")), F.col("best.id") == F.col("best_id"))
    rooted = rooted.withColumns({"left": F.col("root") != F.col("of_best"), "home": F.col("ref") == F.col("nearest")})
    reach = F.max(F.when(F.col("home"), F.col("d") + r * F.col("n")))
    reached = rooted.groupBy(at).agg(reach.alias("any"), F.max(F.when(F.col("home") & F.col("left"), F.col("d") + r * F.col("n"))).alias("ours"), F.count_if("left").alias("k")).where("k > 0")
    rooted = rooted.join(reached, at).where(F.col("home") | (F.col("over") <= F.when(F.col("left"), F.col("any")).otherwise(F.col("ours")) + slack))
    asks = F.greatest(F.lit(1), F.ceil((F.col("over") + F.col("best.over")) / 2 - slack))
    asked = F.greatest(F.lit(1), F.floor((F.col("over") - F.col("best.over")) / 2 - slack) + 1)
    rooted = rooted.withColumn("asking", F.when(F.col("left"), F.col("d") - asks + 1).otherwise(0)).withColumn("asked", F.col("d") - asked + 1)
    # two texts that the group doesn't hold need no more than what is asked of either, and ask each other once
    rooted = rooted.withColumn("asked", F.when(F.col("left"), F.least("asking", "asked")).otherwise(F.col("asked"))).where("greatest(asking, asked) > 0")
    rooted = stored(rooted.select("id", "camp", "ref", "root", "n", "left", "d", "asking", "asked"), "similar-askers")
    wanted = rooted.groupBy("id").agg(F.collect_list("ref").alias("wanted"))
    only = _by_chunk(held.join(_small(stored(wanted, "similar-wanted")), "id"), _for_chunks(sets, held), width, "differences", _differences)
    each = stored(rooted.join(only, ["id", "ref"]), "similar-differences").withColumn("token", F.explode("only")).drop("only")
    shared = each.groupBy(*at, "token").agg(F.count("*").alias("f"), F.count_if("left").alias("k")).where("f > 1 and k > 0").select(*at, "token", "f")
    own = Window.partitionBy("id", "ref")
    each = each.join(shared, [*at, "token"]).withColumn("at", F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("f", "token")))
    each = stored(each.where(F.col("at") <= F.greatest("asking", "asked")), "similar-rarest")
    side = lambda names: each.select(*at, "token", *(F.col(k).alias(v) for k, v in names.items()))
    left = side({"id": "a", "root": "p", "n": "x", "d": "dx", "asking": "most", "asked": "fewer", "at": "place", "left": "asks"}).where("asks")
    right = side({"id": "b", "root": "q", "n": "y", "d": "dy", "asked": "held", "at": "there", "left": "too"}).where("there <= held")
    fits = F.when(F.col("too"), (F.col("a") < F.col("b")) & (F.col("place") <= F.col("fewer"))).otherwise(F.col("place") <= F.col("most"))
    met = left.join(right, [*at, "token"]).where((F.col("p") != F.col("q")) & fits)
    met = met.withColumn("rest_a", F.col("dx") - F.when(F.col("too"), F.col("fewer")).otherwise(F.col("most"))).withColumn("rest_b", F.col("dy") - F.col("held"))
    pairs = met.groupBy(*at, "a", "b", "x", "y", "dx", "dy", "rest_a", "rest_b").agg(F.count("*").alias("c"))
    enough = 2 * (F.col("c") + F.greatest("rest_a", "rest_b")) >= F.col("dx") + F.col("dy") - r * (F.col("x") + F.col("y")) - slack
    return pairs.where(enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _apart(mixed: DataFrame, least: float) -> DataFrame:
    """Pairs ``a, b`` of texts of different groups, and not of one camp, that can be as similar.

    Texts of that similarity share one of their rare shingles.  Those that follow
    the shorter list can't make up for too few shared ones, so pairs of too few
    are left out.  A pair has a side outside its bucket's main party (a camp, or
    the group of a text in none), so the crowd of that party never meets itself.
    """
    by_party = mixed.groupBy("token", "party").agg(F.count("*").alias("c"))
    tops = by_party.groupBy("token").agg(F.max(F.struct("c", "party")).alias("top"), F.count("*").alias("parties")).where("parties > 1").select("token", F.col("top.party").alias("top"))
    placed = stored(mixed.join(tops, "token").withColumn("main", F.col("party") == F.col("top")).drop("top"), "similar-apart")
    side = lambda names: placed.select("token", *(F.col(k).alias(v) for k, v in names.items()), "main")
    left = side({"id": "a", "n": "x", "root": "p", "party": "k"}).where("not main").drop("main")
    right = side({"id": "b", "n": "y", "root": "q", "party": "l"})
    met = left.join(right, "token").where((F.col("p") != F.col("q")) & (F.col("k") != F.col("l")) & (F.col("main") | (F.col("a") < F.col("b"))) & _sized(least))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).groupBy("a", "b", "x", "y").agg(F.count("*").alias("c"))
    after = lambda n: F.ceil(least * F.col(n) - 1e-9) - 1
    return pairs.where(F.col("c") + F.greatest(after("x"), after("y")) >= least / (1 + least) * (F.col("x") + F.col("y")) - 1e-9).select("a", "b")


def text_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """``key, digest, root`` of each row, stored: the same root for all rows of a group of similar texts.

    Equal texts are one.  Fingerprints of texts' distinct words are linked as
    ``near_duplicates`` does, through their Golay keys, and each text is verified
    against the smallest one that these links reach.  What is still apart meets
    on rare shingles: any two texts of that similarity share one of their
    ``rare_length`` rarest, whatever their fingerprints, so no pair is missed.
    There each text is first verified against one head of its buckets, which
    joins a crowd by as many pairs as it has members.  In crowded buckets texts
    form camps with references, sets of shingles that are central there; the
    text next to each reference joins most of them, and the rest meets on what
    it differs from the references in.  Then every text is verified against all
    texts of other groups with which it shares enough.

    ``df`` is read several times, by digests of its texts, and no copy of it is made: what is
    expensive or gives other rows each time is better written first.
    """
    short_batches(df.sparkSession)
    given = df.select(F.col(key).alias("key"), _digest(F.col(text)).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return settled(lambda: _groups(given, width, least), "similar-groups")


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _groups(given: DataFrame, width: int, least: float) -> DataFrame:
    """``key, digest, root`` of the rows ``key, digest, text``."""
    common = common_tokens(given.select("text"), width)

    marked = given.select("key", "digest", F.monotonically_increasing_id().alias("id"), marks(F.col("text"), common, width, least).alias("of"))
    marked = stored(marked.select("key", "digest", "id", "of.*"), "similar-marks")
    classes = marked.groupBy("digest").agg(F.min(F.struct("id", "key")).alias("own"), F.first("fp").alias("fp"), F.count("*").alias("rows"))
    classes = stored(classes.select("digest", "own.*", "fp", "rows"), "similar-classes")
    rows = stored(marked.select("key", "digest"), "similar-keys")
    # of each text the first row's marks; the rare shingles are dropped as soon as they have met
    own = marked.drop("key", "digest", "fp").join(_small(classes.select("id")), "id", "left_semi")
    bits = stored(own.select("id", "n", "bits"), "similar-bits")
    lists = own.select("id", "n", "rare")
    twice = stored(classes.where("rows > 1").select("digest"), "similar-copied")
    repeated = bool(rows.join(_small(twice), "digest", "left_semi").groupBy("key", "digest").agg(F.count("*").alias("c")).where("c > 1").head(1))
    texts = Texts(given, classes.select("id", "key", "digest"), bits, repeated)

    prints = components(settled(lambda: links(classes.select("fp").distinct()), "simhash-links"), "a", "b")
    near = classes.join(prints, F.col("fp") == F.col("node"), "left").select("id", F.coalesce("root", "fp").alias("root"))
    heads = near.groupBy("root").agg(F.min("id").alias("b"), F.count("*").alias("of")).where("of > 1")
    found = _verified(near.join(heads, "root").where("id != b").select(F.col("id").alias("a"), "b"), texts, width, least, "prints")

    mixed = settled(lambda: _mixed(_rooted(lists, found)), "similar-tokens")
    drop_stored(marked)
    held = settled(lambda: _members(mixed, texts), "similar-chunks")
    known = bits.join(_small(held.select("id", "camp", "texts")), "id")
    sets = settled(lambda: _central_sets(held, known, width), "similar-references")
    placed = settled(lambda: _placed(held, known, sets, width, least), "similar-placed")
    alike = placed.where((F.col("over") + F.col("best.over") <= 1e-9) & (F.col("id") != F.col("best.id")))
    found = found.union(_verified(alike.select(F.col("id").alias("a"), F.col("best.id").alias("b")).distinct(), texts, width, least, "best"))
    found = found.union(_verified(_best_heads(mixed, least), texts, width, least, "heads"))
    roots = stored(_rooted(classes.select("id"), found), "similar-rooted")
    met = settled(lambda: _within_camps(held, sets, placed, roots, width, least), "similar-met")
    drop_stored(held)
    found = found.union(_verified(met, texts, width, least, "camp"))

    parties = _small(stored(placed.select("id", "camp").distinct(), "similar-parties"))
    mixed = _rooted(mixed.drop("root", "crowded"), found).join(parties, "id", "left").withColumn("party", F.coalesce(-1 - F.col("camp"), "root")).drop("camp")
    met = settled(lambda: _apart(mixed, least), "similar-apart-met")
    found = found.union(_verified(met, texts, width, least, "apart"))
    return rows.join(_rooted(classes.select("digest", "id"), found).select("digest", "root"), "digest")


def similar_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """``key, digest, component_id`` of every row: groups that texts of at least ``least`` shingle similarity link, by their smallest key."""
    rows = text_groups(df, key, text, width, least)
    ids = rows.groupBy("root").agg(F.min("key").alias("component_id"))
    return rows.join(ids, "root").select(F.col("key").alias(key), "digest", "component_id")


def first_of_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """``df`` with one row of each group of similar texts: that of the smallest key (a null one last), of equal keys that of the least text digest, then the first.

    A key alone never decides: rows that share one, or have none, stay if their texts are of different groups.
    """
    rows = text_groups(df, key, text, width, least)

    def others() -> DataFrame:
        """``__key, __digest, __rest`` of the rows to drop, and of those to keep once (``__rest``), since several have key and digest in common."""
        ends = rows.groupBy("root").agg(F.min(F.struct(F.col("key").isNull(), "key", "digest")).alias("end")).select("root", F.col("end.key").alias("k"), F.col("end.digest").alias("d"))
        each = rows.groupBy("root", "key", "digest").agg(F.count("*").alias("c"))
        many = rows.groupBy("root").agg(F.count("*").alias("of")).where("of > 1")
        told = each.join(many, "root", "left_semi").join(ends, "root").withColumn("rest", F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")))
        return told.where("not rest or c > 1").select(F.col("key").alias("__key"), F.col("digest").alias("__digest"), F.col("rest").alias("__rest"))

    told = settled(others, "similar-others")
    drop_stored(rows)
    own = free_name(df.columns, "__own")
    named = df.withColumn(own, _digest(F.col(text)))
    same = named[key].eqNullSafe(F.col("__key")) & (named[own] == F.col("__digest"))
    few = told.count() <= BROADCAST_NAMES
    if few:
        single = named.join(F.broadcast(told), same, "left_anti")
    else:  # texts of rows that are surely kept aren't shuffled
        spots = stored(key_marks(told, "__key", "__digest"), "similar-other-marks")
        single = may_hold(named, spots, F.col(key), F.col(own), without=True).union(may_hold(named, spots, F.col(key), F.col(own)).join(told, same, "left_anti"))
    once = told.where("__rest")
    if not once.head(1):
        return single.drop(own)
    place = free_name(named.columns, "__place")
    several = named.withColumn(place, F.monotonically_increasing_id())
    several = several.join(F.broadcast(once) if few else once, several[key].eqNullSafe(F.col("__key")) & (several[own] == F.col("__digest")), "left_semi")
    first = several.groupBy(several[key], several[own]).agg(F.min_by(F.struct(*(several[c] for c in named.columns)), several[place]).alias("first"))
    return single.union(first.select("first.*")).drop(own)


def hex_print(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
