import base64
import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayframe.llm import bpe, chat, decontaminate, graph, shared, simhash, token_output, warc_zip
from assayframe.llm.shared import shared_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "a", "A b  c\t d \n e", "¡Qué! 中文 🎉 x", "x" * 3000, "ab" * 400 + " " * 300 + "z", "it's 12345 <|endoftext|>", "same", "same"]
ALPHABET = "ab  \n\t 1'sd!é中 . x\x1c\x85\r　"


def frame(spark, texts, extra="lang string, token_ids string, n_hit int"):
    rows = [(i, t, "en", "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


# WARC


def test_warc_round_trip(spark):
    pages = [(3, "u3", "same"), (1, "u1", "same"), (2, None, None), (4, "u4", ""), (5, "u5", "é" * 5000), (None, "u6", "other"), (7, "u7", "same"), (7, "u7", "same")]
    df = spark.createDataFrame([(*p, "x", b"y") for p in pages], "page_id long, url string, html string, payload string, sha1 binary")
    got = warc_zip.round_trip(df).select(warc_zip.key_of("record_id").cast("long").alias("page_id"), "url", "record_type", warc_zip.key_of("refers_to").cast("long").alias("refers_to"), "payload_bytes", "payload_digest", "payload").collect()
    first = {}
    for k, _, h in pages:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    want = []
    for k, u, h in pages:
        body = (h or "").encode()
        revisit = (h or "") in first and first[h or ""] != k
        want.append((k, u, "revisit" if revisit else "response", first[h or ""] if revisit else None, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), b"" if revisit else body))
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r[:6]) + (bytes(r[6]),) for r in got), key=key) == sorted(want, key=key)


def test_warc_of_any_url_and_key(spark):
    urls = ["http://a\r\n\r\nb", "http://a\r\nX-Payload-Length: 9", " lead ", "a\n b", "http://a/%0A?q=%25", "", "\u3000x\x85", "é 中"]
    df = spark.createDataFrame([(f"k {i}\r\n>+%", u, f"p{i % 3}") for i, u in enumerate(urls)], "page_id string, url string, html string")
    got = warc_zip.resolved(warc_zip.round_trip(df)).select(warc_zip.key_of("record_id").alias("k"), "url", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == sorted((f"k {i}\r\n>+%", u, 2) for i, u in enumerate(urls))


def test_warc_revisits_are_resolved(spark):
    rows = [("a", None, "response", None, 3, "D", b"xyz"), ("b", None, "revisit", "a", 99, "D", b"")]
    schema = "record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    assert [r.payload_bytes for r in warc_zip.resolved(spark.createDataFrame(rows, schema)).collect()] == [3, 3]
    with pytest.raises(Exception, match="no record of its digest"):
        warc_zip.resolved(spark.createDataFrame([*rows, ("c", None, "revisit", "a", 3, "E", b"")], schema)).collect()


def test_warc_empty_table_and_least_bytes(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.round_trip(df).count() == 0
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], "page_id long, url string, html string")
    assert {r.record_type for r in warc_zip.round_trip(df, least_bytes=3).collect()} == {"response"}


def test_zip64_and_comment(tmp_path):
    data = warc_zip.record(1, "http://a", b"body", hashlib.sha1(b"body").digest(), None)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"PK\x05\x06 not the end"
        with z.open("archive/data.warc", "w", force_zip64=True) as m:
            m.write(data)
        z.writestr(zipfile.ZipInfo("indexes/index.cdxj"), '"http://a" 1970 {"offset": "0", "length": "%d", "filename": "data.warc"}\n' % len(data))
    path = tmp_path / "p.wacz"
    path.write_bytes(raw.getvalue())
    with warc_zip.Package(str(path)) as p:
        assert [m["name"] for m in p.members()] == ["archive/data.warc", "indexes/index.cdxj"]
        [(start, size)] = p.places()
        headers, body = warc_zip.parse(p.range(start, size))
    assert body == b"body" and headers["warc-target-uri"] == "http://a"
    # the same directory behind a ZIP64 end record and locator, with full fields in the ordinary end
    import struct

    plain = raw.getvalue()
    with warc_zip.Package(str(path)) as p:
        start, size = p.directory()
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 2, 2, size, start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, start + size, 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path.write_bytes(plain[: start + size] + end64 + locator + end)
    with warc_zip.Package(str(path)) as p:
        assert p.directory() == (start, size) and len(p.members()) == 2
    path.write_bytes(b"no package")
    with pytest.raises(ValueError, match="ZIP"), warc_zip.Package(str(path)) as p:
        p.members()


# Chats


def test_chat_round_trip(spark):
    texts = ["plain", None, "", "a<|turn|>b<|end|>", "</s>[INST] ok [/INST]", "\\<|\\\\|>", "<<SYS>> x <</SYS>>", "<|", "|>", "<", "multi\nline"]
    rows = [(c, t, role, x) for c, order in ((1, texts), (2, texts[::-1])) for t, (role, x) in enumerate(zip(("user", "assistant", "system", "assistant") * 3, order))]
    rows += [(None, 0, None, "no id"), (3, None, "assistant", "first"), (3, 0, "user", "x"), (3, 0, "user", "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_chats(df).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    for c in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[c].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[c].loss == "".join(r[3] or "" for r in own if r[2] == "assistant")
        spans = [got[c].formatted[s.start : s.start + s.length] for s in got[c].loss_spans]
        assert "".join(re.sub(r"(?s)\\(.)", r"\1", s) for s in spans) == got[c].loss
        inner = got[c].formatted.replace("<|turn|>", "").replace("<|text|>", "").replace("<|end|>", "")
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", inner)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see ", None, None, None, None, None), ("image", None, "i.png", 28, 15, None, None), ("audio", None, "a.wav", None, None, 2.5, None), ("text", "<|x", None, None, None, None, None), ("document", None, "d.pdf", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn int, role string, text {chat.PARTS}")
    r = chat.format_chats(df).first()
    assert r.formatted == "<|turn|>user<|text|>see <|image|><|audio|><\\|x<|document|><|end|><|turn|>assistant<|text|><|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "i.png", 4), ("audio", "a.wav", 63), ("document", "d.pdf", 1536)]
    assert r.expanded_tokens == 1603


# Decontamination


def word_list(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]


def contamination(texts, items):
    windows = {}
    for i, t in items:
        w = word_list(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add("" if i is None else str(i))
    out = []
    for t in texts:
        w, hit, held = word_list(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    held |= windows[tuple(w[s : s + n])]
        out.append((len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_against_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    rng = random.Random(3)
    vocabulary = ["a", "B", "é", "c3", "dd", "E"]
    say = lambda n: rng.choice((" ", ", ", "-")).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 15, 30, 12, 7])] + [(20, None), (21, ""), (None, say(12)), (11, say(13)), (11, say(13))]
    texts = [say(rng.randint(0, 60)) for _ in range(25)] + [items[11][1], f"x y {items[9][1]} z", "É", None, "", "...", "zz " * 2000, items[10][1].upper()]
    got = decontaminate.decontaminate(frame(spark, texts), spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, window int")).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in decontaminate.RESULT) for r in got] == contamination(texts, items)
    assert got[0].lang == "en" and got[0].token_ids == "clash"


def test_decontamination_shares_long_spans_only(spark):
    item = " ".join(f"w{i}" for i in range(40))
    nine, ten = " ".join(f"w{i}" for i in range(9)), " ".join(f"w{i}" for i in range(5, 15))
    got = decontaminate.decontaminate(frame(spark, [f"q {nine} q", f"q {ten} q"]), spark.createDataFrame([(1, item)], "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_hit, r.contaminated) for r in got] == [(0, False), (10, True)]


def test_decontamination_of_a_text_made_of_items(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(15))) for i in range(20)]
    text = " ".join(items[i % 20][1] for i in range(400))
    got = decontaminate.decontaminate(frame(spark, [text, "w1x1 " * 3]), spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [(6000, 6000, 20), (3, 0, 0)]


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, ["a b", None]), none).collect()
    assert [r.contaminated for r in got] == [False, False]
    assert decontaminate.decontaminate(frame(spark, ["x"]).limit(0), none).count() == 0


def moved_bytes(spark, act):
    """Bytes of shuffles that ``act`` writes."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(spark._jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (stages.apply(i) for i in range(stages.size()))}

    before = written()
    act()
    return sum(n for stage, n in written().items() if stage not in before)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_moves_no_clean_text(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    rng = random.Random(8)
    item = " ".join(f"w{i}" for i in range(30))
    texts = [" ".join(f"{rng.getrandbits(480):x}" for _ in range(60)) for _ in range(300)]
    texts[7] += f" {item}"
    docs, items = frame(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")
    threshold, got = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        moved = moved_bytes(spark, lambda: got.extend(decontaminate.decontaminate(docs, items).where("contaminated or doc_id = 3").orderBy("doc_id").select("doc_id", "n_hit", F.length("text").alias("n")).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [(r.doc_id, r.n_hit, r.n) for r in got] == [(3, 0, len(texts[3])), (7, 30, len(texts[7]))]
    assert moved < 0.4 * sum(map(len, texts))


@pytest.mark.parametrize("slots", [1, 1 << 18])
def test_marks_hold_every_key(spark, monkeypatch, slots):
    monkeypatch.setattr(shared, "SLOTS", slots)
    keys = spark.createDataFrame([(None, 1), (5, 2), (5, 2), (-7, 3)], "id long, h long")
    rows = spark.createDataFrame([(i, 2) for i in range(300)] + [(None, 1), (None, 2), (-7, 3), (None, 1)], "id long, h long")
    marks = shared.key_marks(keys, "id", "h")
    held, rest = shared.may_hold(rows, marks, "id", "h").collect(), shared.may_hold(rows, marks, "id", "h", without=True).collect()
    assert Counter(map(tuple, held + rest)) == Counter(map(tuple, rows.collect()))
    assert not {tuple(r) for r in rest} & {(None, 1), (5, 2), (-7, 3)} and len(rest) > 200
    assert shared.may_hold(rows, marks.limit(0), "id", "h").count() == 0 and shared.may_hold(rows, marks.limit(0), "id", "h", without=True).count() == rows.count()


# Token output


def test_token_output_against_the_library(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(9)
    odd = ODD + ["<|endoftext|>", "a <|endoftext|><|endoftext|> b", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(60))]
    rows = [(i * 7 % len(odd), t) for i, t in enumerate(odd)] + [(None, "null key")]
    for delta in (False, True):
        out = shared_path(spark, "test-tokens")
        df = spark.createDataFrame([(*r, "keep", 1) for r in rows], "doc_id long, text string, lang string, part_start int").repartition(3)
        token_output.write(df, out, TOKENIZER, public_tokenizers.PATTERN, keep=("lang",), delta=delta, row_group_bytes=1 << 16)
        got = {(r.doc_id, r.n_tokens): r for r in token_output.read(spark, out).withColumn("crc", token_output.ids_crc32("token_ids")).collect()}
        start = 0
        for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
            r = got[key, len(ids)]
            assert (r.token_ids, r.start, r.crc) == (ids, start, zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)
    out = shared_path(spark, "test-tokens")
    token_output.write(df.limit(0), out, TOKENIZER, public_tokenizers.PATTERN)
    assert token_output.read(spark, out).count() == 0


PIECES = ["foo", "The", "schö", "é", "Привет", "ÿ", "µ", "×", "中文", "12", "٣", "don't", "we'll", "'s", "'", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "\u00a0", "\u200b", "\u3000", "\x00", "\x1c", "\x85", ".", "...", "***", "…", "»", "_", "😀", "<|endoftext|>", "<|"]


@pytest.mark.parametrize("end", [None, 0])
def test_token_output_encoder_on_odd_texts(monkeypatch, end):
    monkeypatch.setattr(token_output, "KEPT", 40)  # generations of kept words pass
    tokenizer, own, rng = Tokenizer.from_file(TOKENIZER), token_output.LibraryEncoder(TOKENIZER, public_tokenizers.PATTERN), random.Random(13)
    for n in [0, 1, *[25] * 30]:
        texts = ["".join(rng.choice(PIECES) + rng.choice(["", " ", "", ".\nIt "]) for _ in range(rng.randint(0, 20))) for _ in range(n)]
        texts += [" ".join(rng.choice(PIECES[:15]) + rng.choice(["", ",", "***", "…", "»."]) for _ in range(20)) for _ in range(n)]
        ids, sizes = own.encode(pa.array(["cut off", *texts]).slice(1), end)
        want = [tokenizer.encode(x, add_special_tokens=False).ids + ([] if end is None else [end]) for x in texts]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_token_output_looks_at_a_word_once_whatever_follows_it():
    own, rng = token_output.LibraryEncoder(TOKENIZER, public_tokenizers.PATTERN), random.Random(14)
    stems = list({"".join(rng.choice("abcdeöéß") for _ in range(9)) for _ in range(500)})
    texts = [" ".join(["It", *(s + mark for s in stems)]) + "\n" + "\n".join(stems) for mark in ("", ".", "***", "&&&", ",")]
    cut, asked, find, model = [], [], own.find, own.model

    class Model:
        def tokenize(self, letters):
            asked.append(letters)
            return model.tokenize(letters)

    own.find, own.model = lambda x: cut.append(x) or find(x), Model()
    ids, _ = own.encode(pa.array(texts), None)
    assert ids.tolist() == [i for x in texts for i in Tokenizer.from_file(TOKENIZER).encode(x, add_special_tokens=False).ids]
    assert len(asked) < 2.1 * len(stems) + 50 and len(cut) < len(stems) + 50  # with a space before it or a line end, whatever marks follow


# SimHash


def expected_components(prints):
    ids = list(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_against_definition():
    rng = random.Random(1)
    for text in ["", " \n", "One", "one two", "A b C d e a b c", "é É x " * 50, " ".join(rng.choice("abcdef") for _ in range(500))]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert simhash.shingle_bits(text, 3, 42) == want


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    other = prints.copy()
    for i in range(len(other)):
        for bit in rng.choice(64, rng.integers(0, 3), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    keys, counts = simhash.key_lists(np.concatenate([prints, other]))
    parts = np.split(keys, counts.cumsum()[:-1])
    assert all(set(a.tolist()) & set(b.tolist()) for a, b in zip(parts[:2000], parts[2000:]))


@pytest.mark.parametrize("paired", [32, 1])
def test_links_connect_the_same_components(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(paired)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base[:12]:
        x = b
        for _ in range(8):
            x ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
            prints.add(x & (2**64 - 1))
    signed = {p - 2**64 if p >= 2**63 else p: p for p in prints}
    links = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    assert all((signed[r.a] ^ signed[r.b]).bit_count() <= 2 for r in links.collect())
    roots = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
    want = expected_components(signed)
    groups = lambda of: {frozenset(s for s in signed if of(s) == r) for r in {of(s) for s in signed}}
    assert groups(lambda s: roots.get(s, s)) == groups(lambda s: want[s])


def test_near_duplicates_edges(spark):
    texts = ["the cat sat on the mat", "the cat sat on the mat", None, "", " \n", "other words here now", "The CAT sat on the mat"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "lonely text stands here", 1, 2)], "doc_id long, text string, fp int, component_id int")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert got == {0: 0, 1: 0, 6: 0, 2: 2, 3: 2, 4: 2, 5: 5, None: None}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# Byte-level BPE


def test_bpe_against_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    df = bpe.with_bytes(bpe.with_tokens(frame(spark, texts), RANKS, public_tokenizers.PATTERN), RANKS)
    for r in df.collect():
        text = texts[r.doc_id]
        assert r.token_ids == (None if text is None else own.encode_ordinary(text))
        assert (None if r.decoded is None else bytes(r.decoded)) == (None if text is None else text.encode())
    assert bpe.with_tokens(frame(spark, ["x"]).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
