import itertools
import datetime
import hashlib
import random
import re
import tracemalloc
import uuid
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayframe.llm import graph, html_text, permutation_index, pii, quality, queries, shared, simhash

# Pseudonyms


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_feistel(key, kind, x, y, a, b):
    for i in range(pii.ROUNDS):
        draw = lambda v: int(hashlib.sha256(f"{key}|{kind}|{i}|{v}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        if i % 2 == 0:
            x = (x + draw(y)) % a
        else:
            y = (y + draw(x)) % b
    return x, y


def test_pseudonyms_against_brute_force(spark):
    rng = random.Random(4)
    numbers = []
    while len(numbers) < 60:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn_ok(digits):
            numbers.append(digits)
    dates = [(datetime.date(1900, 1, 1) + datetime.timedelta(days=rng.randrange(50000))).isoformat() for _ in range(60)]
    addresses = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(60)]
    rows = [(n, d, a) for n, d, a in zip(numbers, dates, addresses)]
    df = spark.createDataFrame(rows, "n string, d string, a string")
    for r in df.select("n", "d", "a", pii.card("k", F.col("n")).alias("n2"), pii.date("k", F.col("d")).alias("d2"), pii.ip("k", F.col("a")).alias("a2")).collect():
        x, y = brute_feistel("k", "card", int(r.n[4:9]), int(r.n[9:15]), 10**5, 10**6)
        body = f"{r.n[:4]}{x:05d}{y:06d}"
        assert r.n2[:15] == body and luhn_ok(r.n2)
        day = datetime.date.fromisoformat(r.d)
        first = datetime.date(day.year // 100 * 100, 1, 1)
        days = [first + datetime.timedelta(days=i) for i in range(36525)]
        own = [d for d in days if d.year // 100 == day.year // 100 and (d.day <= 12) == (day.day <= 12)]
        kind, a, b = ("date", 120, 120) if day.day <= 12 else ("late date", 125, 177)
        n = own.index(day)
        while True:
            x, y = brute_feistel("k", kind, *divmod(n, b), a, b)
            n = x * b + y
            if n < len(own):
                break
        assert r.d2 == own[n].isoformat()
        o = list(map(int, r.a.split(".")))
        x, y = brute_feistel("k", "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        assert r.a2 == f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"


def test_small_domains_are_permuted(spark):
    for width in (1, 2, 3):
        df = spark.range(10**width).select(F.lpad(F.col("id").cast("string"), width, "0").alias("d"))
        got = [r[0] for r in df.select(pii.permute_digits("k", "x", F.col("d"))).collect()]
        assert sorted(got) == [f"{i:0{width}d}" for i in range(10**width)]
    for year, n in ((2000, 36525), (1900, 36524)):
        days = spark.range(n).select(F.date_add(F.lit(f"{year}-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
        assert days.select(pii.date("k", F.col("d").cast("string"))).distinct().count() == n
        for form, least in (("MM/dd/yyyy", 1), ("dd/MM/yyyy", 13), ("dd.MM.yyyy", 1), ("dd-MM-yyyy", 1), ("yyyy/MM/dd", 1)):
            written = days.where(F.day("d") >= least).select(F.date_format("d", form).alias("s"))
            moved = written.select("s", pii.date("k", F.col("s")).alias("t"))
            assert moved.select("t").distinct().count() == written.count() == moved.where(pii.is_date(F.col("t"))).count()
            assert least == 1 or moved.where(F.substring("t", 1, 2) <= "12").count() == 0
    slashed = days.select(F.explode(F.array(F.date_format("d", "MM/dd/yyyy"), F.date_format("d", "dd/MM/yyyy"))).alias("s")).distinct()
    assert slashed.select(pii.date("k", F.col("s"))).distinct().count() == slashed.count() > 58_000
    linked = spark.createDataFrame([("2003-05-21", "05/21/2003", "21/05/2003", "21.05.2003")], "a string, b string, c string, d string")
    one = linked.select(*(pii.date("k", F.col(c)).alias(c) for c in "abcd")).first()
    y, m, d = one.a.split("-")
    assert (one.b, one.c, one.d) == (f"{m}/{d}/{y}", f"{d}/{m}/{y}", f"{d}.{m}.{y}")
    ssn = spark.sql("select concat('', lpad(a.id, 3, '0'), '-', lpad(b.id, 2, '0'), '-0001') as s from range(1, 900) a cross join range(1, 100) b where a.id <> 666")
    moved = ssn.select(pii.ssn("k", F.col("s")).alias("s"))
    assert moved.distinct().count() == ssn.count() and moved.where(~pii.is_ssn(F.col("s"))).count() == 0


def test_pseudonyms_in_texts(spark):
    texts = [
        "call +1 (743) 555-3824 or (743) 555-3824, +4915112345678.",
        "from 10.0.0.1: 4111 1111 1111 1111 4111111111111111 and 4111111111111112",
        "mail Ana.B-1@mail2.example.com&&& é@x.org; not@this",
        "1987-02-28 12/31/1999 25/12/1999 03.04.2001 but 2020-02-31 and 1.2.3.4.5",
        "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 123-45-6789 000-12-3456",
        None,
        "",
        "no data at all",
        "12 apples, 3.14, v1.2.3",
        "x" * 50000 + " 10.0.0.1 " + "9" * 40,
    ]
    df = spark.createDataFrame([(i, t, "kept", 9) for i, t in enumerate(texts)], "doc_id long, text string, kind string, n_ip int")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k").collect()}
    counts = lambda i: {k: got[i][f"n_{k}"] for k in pii.KINDS if got[i][f"n_{k}"]}
    assert counts(0) == {"phone": 3} and counts(1) == {"ip": 1, "card": 2} and counts(2) == {"email": 2}
    assert counts(3) == {"date": 4} and counts(4) == {"iban": 2, "ssn": 1} and counts(9) == {"ip": 1}
    assert [got[i].text for i in (5, 6, 7, 8)] == texts[5:9] and not any(counts(i) for i in (5, 6, 7, 8))
    spaced, plain = re.search(r"(4111(?: \d{4}){3}) (\d{16})", got[1].text).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111" and luhn_ok(plain)
    assert "4111111111111112" in got[1].text and "2020-02-31" in got[3].text and "000-12-3456" in got[4].text and "1.2.3.4.5" in got[3].text
    assert re.fullmatch(r"mail [A-Z][a-z]{2}\.[A-Z]-\d@mail2\.example\.com&&& [à-ÿ]@x\.org; not@this", got[2].text)
    again = re.search(r"from ([\d.]+):", got[1].text)[1]
    assert f" {again} " in got[9].text and got[9].text.endswith("9" * 40) and got[0].kind == "kept"
    assert pii.pseudonymise(df, "other").where("doc_id = 1").first().text != got[1].text
    assert pii.pseudonymise(df.limit(0), "k").count() == 0


def brute_digits(kind, digits):
    half = len(digits) // 2
    x, y = brute_feistel("k", kind, int(digits[:half] or 0), int(digits[half:] or 0), 10**half, 10 ** (len(digits) - half))
    return (f"{x:0{half}d}" if half else "") + f"{y:0{len(digits) - half}d}"


def brute_email(local):
    half = len(local) // 2
    parts = [local[:half], local[half:]]
    for i in range(pii.ROUNDS):
        by = hashlib.sha256(f"k|email|{i}|{parts[1 - i % 2]}".encode()).hexdigest()
        out = ""
        for j, c in enumerate(parts[i % 2]):
            own = next((a for a in pii.ALPHABETS if c in a), None)
            out += own[(own.index(c) + int(by[j * 2 % 64 : j * 2 % 64 + 2], 16)) % len(own)] if own else c
        parts[i % 2] = out
    return "".join(parts)


def test_other_kinds_against_brute_force(spark):
    rng = random.Random(12)
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for _ in range(25):
        local = "".join(rng.choice("abcXYZ019._-") for _ in range(rng.randint(1, 14)))
        area = rng.choice([n for n in range(1, 900) if n != 666])
        ssn = f"{area:03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
        phone, world = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{digit(4)}", f"+49 {digit(3)} {digit(4)}"
        body = digit(18)
        check = 98 - int(body + "131400") % 97  # DE stands for 1314
        iban = f"DE{check:02d} " + " ".join(body[i : i + 4] for i in range(0, 18, 4))
        row = spark.createDataFrame([(f"{local}@x.org", ssn, phone, world, iban)], "e string, s string, p string, w string, i string")
        r = row.select(*(make("k", F.col(c)).alias(c) for c, make in (("e", pii.email), ("s", pii.ssn), ("p", pii.phone), ("w", pii.phone), ("i", pii.iban)))).first()
        assert r.e == brute_email(local) + "@x.org"
        x, y = brute_feistel("k", "ssn", (area - 1 - (area > 666)) * 99 + int(ssn[4:6]) - 1, int(ssn[7:]) - 1, 898 * 99, 9999)
        area = x // 99 + 1 + (x // 99 >= 665)
        assert r.s == f"{area:03d}-{x % 99 + 1:02d}-{y + 1:04d}"
        own = re.sub(r"\D", "", phone)
        x, y = brute_feistel("k", "phone", int(own[:3]) - 200, int(own[3:]) - 2_000_000, 800, 8_000_000)
        d = f"{x + 200}{y + 2_000_000}"
        assert r.p == f"({d[:3]}) {d[3:6]}-{d[6:]}"
        d = brute_digits("phone", world[4:].replace(" ", ""))
        assert r.w == f"+49 {d[:3]} {d[3:]}"
        d = brute_digits("iban", body)
        assert r.i == f"DE{98 - int(d + '131400') % 97:02d} " + " ".join(d[i : i + 4] for i in range(0, 18, 4))


# Pages


def test_main_text_of_pages(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><a href="/">Site</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies to make this page work well for you.</p></div>
    <article><h1>A title &amp; more</h1><p>First   paragraph with <b>bold</b>
    and <a href=/c>a link</a>.<p>Second one &lt;here&gt;, caf&eacute;.<br>Next line.</p>
    <div class="ad"><p>Buy this thing now, it is very cheap.</p></div><ul><li>An item of the list.</li></ul></article>
    <aside class="sidebar"><h3>Popular</h3><p>Read these other things too.</p></aside>
    <section id="comments"><div class="comment"><p>I like this article very much, thank you.</p></div></section>
    <form class="search"><label>Search</label><input><button>Go</button></form><footer>&copy; 2020 Someone.</footer></body></html>"""
    rows = [(1, page), (2, None), (3, ""), (4, "<p>"), (5, "plain words only, no tags."), (6, page[: page.index("Second one") + 20]), (1, page)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, html string, text int")
    got = html_text.with_text(df).collect()
    want = "A title & more\n\nFirst paragraph with bold and a link.\n\nSecond one <here>, café. Next line.\n\nAn item of the list."
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == 7 and by_id[1] == want and by_id[2] == by_id[3] == by_id[4] == ""
    assert by_id[5] == "plain words only, no tags."
    assert by_id[6].endswith("\n\nSecond one <here&")  # the cut-off reference stays as it is
    assert html_text.with_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<html><body><div>First sentence here, with words. And a second.</div><div>More text stands here.</div></body></html>", "First sentence here, with words. And a second.\n\nMore text stands here."),
    ("<div>Only one short sentence stands here.</div>", "Only one short sentence stands here."),
    ("<nav><a href=/>Home</a></nav><article><dl><dt>Term</dt><dd>What it means, in a sentence.</dd></dl></article><footer>&copy; x</footer>", "Term\n\nWhat it means, in a sentence."),
    ('<article><h1>On things</h1><p>Intro text stands here, long enough.</p><section class="related-work"><h2>Related work</h2><p>Others did much of this before us.</p></section></article>', "On things\n\nIntro text stands here, long enough.\n\nRelated work\n\nOthers did much of this before us."),
    ('<p>Some text here. <a title="foo>bar</a> goes on, with words.</p>', "Some text here. bar goes on, with words."),
    ('<p title="a > b">Some text <i data-x=\'"\'>here</i>, with words.</p>', "Some text here, with words."),
    ("<table><tr><td><a href=/a>One</a><br><a href=/b>Two</a></td><td><p>The story goes here in a long sentence.</p></td></tr></table>", "The story goes here in a long sentence."),
    ("<nav><ul><li><a href=/>Home</a></ul></nav><footer>&copy; 2020 us</footer>", ""),
    ("<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Blog</a></li></ul></nav><article><h1>Bread</h1><ul><li>Flour</li><li>Water</li><li>Salt</li></ul><ol><li>Mix.</li><li>Bake.</li></ol></article><footer>&copy; 2020 us</footer></body></html>", "Bread\n\nFlour\n\nWater\n\nSalt\n\nMix.\n\nBake."),
    ("<html><body><header><a href=/>Site</a></header><article><h1>Reading</h1><p>Some books I liked this year.</p><ul><li><a href=/1>War and Peace</a></li><li><a href=/2>Emma</a></li><li><a href=/3>Ulysses</a></li></ul></article><div class=sidebar><a href=/x>More</a></div></body></html>", "Reading\n\nSome books I liked this year.\n\nWar and Peace\n\nEmma\n\nUlysses"),
    ("<html><body><div class=nav><a href=/>Home</a> <a href=/a>About</a></div><div class=content><div>It rained.</div><div>We stayed in.</div><div>He slept.</div><div>Then it stopped.</div></div><div class=footer>All rights reserved</div></body></html>", "It rained.\n\nWe stayed in.\n\nHe slept.\n\nThen it stopped."),
    ("<html><body><nav><a href=/>Home</a></nav><article><h1>Trip</h1><figure><img src=a><figcaption>The lake</figcaption></figure><figure><img src=b><figcaption>The hut</figcaption></figure><figure><img src=c><figcaption>Snow</figcaption></figure></article><footer>Contact</footer></body></html>", "Trip\n\nThe lake\n\nThe hut\n\nSnow"),
    ("<html><body><nav><a href=/>Home</a></nav><main><h1>FAQ</h1><h3>Why?</h3><p>Because.</p><h3>When?</h3><p>Soon.</p><h3>Who?</h3><p>Nobody knows.</p></main><footer>Imprint</footer></body></html>", "FAQ\n\nWhy?\n\nBecause.\n\nWhen?\n\nSoon.\n\nWho?\n\nNobody knows."),
    ("<html><body><nav><a href=/>Home</a></nav><article><h1>Results</h1><table><tr><th>Year</th><th>Tons</th></tr><tr><td>1999</td><td>12.5</td></tr><tr><td>2000</td><td>13</td></tr></table></article><aside><p>Subscribe now and save a lot of money.</p></aside></body></html>", "Results\n\nYear\n\nTons\n\n1999\n\n12.5\n\n2000\n\n13"),
    ("<html><body><header><p>Poems of the world</p></header><article><h1>Rain</h1><p>Drops fall<br>on tin<br>all night</p><p>no sleep<br>no dream</p></article><footer>&copy; P</footer></body></html>", "Rain\n\nDrops fall on tin all night\n\nno sleep no dream"),
    ("<body><article><h1>News</h1><p>One thing happened today in the city.</p><div class=comments><h3>Comments</h3><div class=comment><b>Bob</b> <p>I like this a lot, thanks.</p></div></div></article><form><label>Name</label><button>Send</button></form></body>", "News\n\nOne thing happened today in the city."),
])
def test_main_text_of_plain_layouts(page, want):
    assert html_text.main_texts([page], html_text.fit()) == [want]


def test_held_out_layout_families():
    """Text runs of layouts of a family that no fitted page had."""
    for family, least in (("article", 0.97), ("parts", 0.9), ("bare", 0.87), ("table", 0.8), ("plain", 0.95)):
        model, right, all_ = html_text.fit(600, 11, tuple(f for f in html_text.FAMILIES if f != family)), 0, 0
        for nodes, state in html_text.labelled_pages(60, 5, (family,)):
            for node, s, own in zip(nodes, state, model.marginals([nodes])[0]):
                if node.tag == html_text.TEXT:
                    right, all_ = right + ((own >= 0.5) == (s == html_text.ALL)), all_ + 1
        assert right / all_ >= least, family


def test_broken_deep_markup_takes_linear_time():
    assert len(html_text.parse("<div><b>" * 20_000 + "</i></p></td>" * 20_000)) == 40_001


class Runs(HTMLParser):
    """Text runs of a page and the number of block tags before each, by another parser."""

    def __init__(self, page):
        super().__init__()
        self.runs, self.block = [], 0
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        self.block += tag not in html_text.INLINE

    def handle_endtag(self, tag):
        self.block += tag not in html_text.INLINE

    def handle_data(self, data):
        self.runs.append((self.block, data))


@pytest.mark.parametrize("page", [
    "<div><p>One two three.<a href=x>y</a></p><ul class=menu><li>z</li></ul></div>",
    "<nav><a href=/>Home</a></nav><p>Words <b>stand</b> here, and more.</p><footer>Legal text</footer>",
    "<div class=ad>Buy this</div><div>Text one is here.</div><div class=comments><p>Nice one!</p></div>",
])
def test_main_text_against_enumeration(page):
    """All assignments of states to a small page's nodes, by the model's own numbers; text runs and blocks by another parser."""
    model, nodes = html_text.fit(), html_text.parse(page)
    own = html_text.features(nodes)
    full = [i for i in range(len(nodes)) if own[i]]
    local = {i: np.sum([np.zeros(3), *(model.emissions.get(f, (0, 0, 0)) for f in own[i])], axis=0) for i in full}
    total, on = 0.0, np.zeros(len(nodes))
    for states in itertools.product(range(3), repeat=len(full)):
        s = dict(zip(full, states))
        if any(nodes[i].tag == html_text.TEXT and s[i] == html_text.MIXED or i and s[nodes[i].parent] != html_text.MIXED and s[i] != s[nodes[i].parent] for i in full):
            continue
        log = sum(local[i][s[i]] for i in full) + sum(model.transitions.get(nodes[i].tag, (0, 0, 0))[s[i]] for i in full if i and s[nodes[i].parent] == html_text.MIXED)
        total += np.exp(log)
        on += np.exp(log) * np.array([s.get(i) == html_text.ALL for i in range(len(nodes))])
    assert np.allclose(model.marginals([nodes])[0], on / total)
    kept = iter((on / total)[[i for i in full if nodes[i].tag == html_text.TEXT]] >= 0.5)
    blocks = {}
    for block, run in Runs(page).runs:
        if next(kept):
            blocks[block] = blocks.get(block, "") + run
    assert html_text.main_texts([page], model) == ["\n\n".join(" ".join(x.split()) for x in blocks.values())]


# Quality


def test_quality_on_held_out_documents(spark):
    df = queries.op9_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = df.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93
    assert all(0 <= r.score <= 1 for r in rows) and df.count() == 1000


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, "fine words stand here" if i % 2 else "$$$ !!! $$$", i % 2) for i in range(40)] + [(90, None, 0), (91, "", 1)], "doc_id long, text string, label int")
    labels = docs.select("doc_id", F.when(F.col("doc_id") == 3, None).otherwise(F.col("doc_id") % 2).alias("quality"))
    model = quality.fit(quality.labelled_sample(docs, labels))
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert got[5] > 0.7 > 0.3 > got[4] and got[90] == got[91]
    one = quality.fit(quality.labelled_sample(docs, labels.where("quality = 1")))
    assert len({r.score for r in quality.scored(docs, one).collect()}) == 1
    none = quality.fit(quality.labelled_sample(docs, labels.limit(0)))
    assert {round(r.score, 6) for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_dual_descent_reaches_the_optimum():
    """The loss that descent ends at is that of plain subgradient steps over dense vectors, and no weights are better."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 8)).astype(np.int32) for _ in range(60)]
    labels = np.array([int(0 in r or 1 in r or rng.random() < 0.1) for r in rows])
    own = [rng.normal(size=len(r)) for r in rows]
    weights, bias = quality.descend(own, rows, labels, seed=7, tolerance=1e-4)
    x = np.zeros((60, 41))
    for i, (r, v) in enumerate(zip(rows, own)):
        x[i, r], x[i, 40] = v, 1
    y, cost = 2 * labels - 1, quality.costs(labels)
    loss = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    found = np.append(weights[:40], bias)
    w, best = np.zeros(41), np.inf
    for t in range(1, 60_000):
        w -= (w - ((cost * y * (y * (x @ w) < 1)) @ x)) / (t + 10)
        best = min(best, loss(w))
    assert loss(found) == pytest.approx(best, rel=2e-3) and loss(found) <= best * (1 + 1e-6)
    assert all(loss(found + 0.02 * rng.normal(size=41)) > loss(found) for _ in range(200))


def test_quality_of_repeated_long_and_clashing_rows(spark, monkeypatch):
    long = "word and other words, " * 40_000
    rows = [(i % 30, "fine words stand here" if i % 2 else "$$$ !!! $$$", 1, "x") for i in range(60)] + [(50, long, 1, "x"), (50, long, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, places string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    model = quality.fit(quality.labelled_sample(docs, labels))
    got = quality.scored(docs, model)
    assert got.columns == ["doc_id", "text", "score", "places"] and got.count() == 62
    assert len({(r.text, r.score) for r in got.collect()}) == 3
    monkeypatch.setattr(quality, "MOST_PLACES", 300)
    small = quality.fit(quality.labelled_sample(docs, labels))
    assert 0 < np.count_nonzero(small.weights) <= np.count_nonzero(model.weights)


# Neighbours


def exact(vectors, ids, q, k=5):
    unit = permutation_index.unit(np.array(vectors, float))
    s = unit @ unit[q]
    rest = [i for i in range(len(ids)) if ids[i] != ids[q]]
    return [(ids[i], s[i]) for i in sorted(rest, key=lambda i: (-s[i], ids[i]))[:k]]


def test_search_of_few_vectors_is_exact(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=4).tolist() for _ in range(120)]
    vectors[10] = vectors[20] = vectors[30] = vectors[50]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(200, None, 1), (250, [0.0] * 4, 1), (300, [1.0, None, 2.0, 3.0], 1), (350, [1.0, float("nan"), 2.0, 3.0], 1), (400, [1.0, 2.0], 1), (None, [1.0, 2.0, 3.0, 4.0], 1), (50, vectors[50], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = permutation_index.search(df, F.col("vec_id") % 50 == 0, candidates=100).collect()
    assert {r.query_id for r in got} == {0, 50, 100} and len(got) == 15
    ids, all_vectors = [*range(120), -1], [*vectors, [1.0, 2.0, 3.0, 4.0]]
    for q in (0, 50, 100):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        want = exact(all_vectors, ids, q)
        assert [(-1 if r.vec_id is None else r.vec_id) for r in own] == [w[0] for w in want]
        assert np.allclose([r.score for r in own], [w[1] for w in want])
    assert permutation_index.search(df.limit(0), F.lit(True)).count() == 0
    assert permutation_index.search(df.where("vec_id = 50").limit(1), F.lit(True)).count() == 0


def test_equal_vectors_come_in_the_order_of_their_ids(spark, monkeypatch):
    """Copies at all places of several shards, asked by vectors that are none of them; few candidates, so products and cuts are of many sizes."""
    monkeypatch.setattr(permutation_index, "SHARD", 64)
    rng = np.random.default_rng(8)
    own = [rng.normal(size=33).tolist() for _ in range(6)]
    rows = [(int(i), own[i % 6] if i % 50 else (np.array(own[i // 50 % 6]) + rng.normal(size=33) * 0.2).tolist()) for i in rng.permutation(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = permutation_index.search(df, F.col("vec_id") % 50 == 0).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r.rank):
        by_query.setdefault(r.query_id, []).append(r)
    assert len(by_query) == 12
    for q, hits in by_query.items():
        k = q // 50 % 6
        near = [i for i in range(600) if i % 50 and i % 6 == k]
        same = [r for r in hits if r.vec_id % 50]
        assert len({r.score for r in same}) == 1 and [r.vec_id for r in same] == near[: len(same)]


def recall(got, vectors, ids, asked):
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in asked}
    return sum(len(found[q] & {w[0] for w in exact(vectors, ids, ids.index(q))}) for q in asked) / 5 / len(asked)


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_of_the_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    got = permutation_index.search(df, F.col("vec_id") % 50 == 0).collect()
    assert recall(got, vectors, ids, [i for i in ids if i % 50 == 0]) >= 0.9


def test_recall_of_a_full_shard(spark, monkeypatch):
    """Random vectors without any groups, the hardest case: one shard of 32,000, and the same rows however they are partitioned and sent."""
    vectors = np.random.default_rng(3).normal(size=(32_000, 64))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(32_000), "embedding": vectors.tolist()}), "vec_id long, embedding array<double>")
    asked = F.col("vec_id") % 1000 == 0
    got = permutation_index.search(df.repartition(1), asked).collect()
    assert recall(got, vectors, list(range(32_000)), range(0, 32_000, 1000)) >= 0.9
    files = permutation_index.Shard(np.arange(32_000), permutation_index.unit(vectors), permutation_index.unit(vectors[:2048]), 40)
    assert (files.starts[1:] - files.starts[:-1]).mean() * 40 < 32_000  # places that a query visits
    monkeypatch.setattr(permutation_index, "QUERY_BLOCK", 20)
    assert sorted(permutation_index.search(df.repartition(40), asked).collect()) == sorted(got)


# Similar texts


def shingle_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_groups(texts, least=0.8):
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def groups_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    return [got[i] for i in range(len(texts))]


def lengthened(rng, n, k):
    """A text and one with k words more at its end."""
    words = [f"w{rng.randrange(10**9)}" for _ in range(n + k)]
    return " ".join(words[:n]), " ".join(words)


def test_bits_of_shingles_lose_no_pair(spark):
    rng = random.Random(12)
    say = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [""] + [" ".join(say(n)) for n in (1, 5, 60, 900, 6000)]
    for base in texts[3:]:
        words = base.split()
        texts += [" ".join(w if rng.random() > share else "x" for w in words) for share in (0.002, 0.01, 0.03, 0.2)]
    sets = [simhash.shingle_tokens(t.encode().split(), 5) for t in texts]
    rows = spark.createDataFrame([(i, t, len(s), simhash.token_bits(s).tolist()) for i, (t, s) in enumerate(zip(texts, sets))], "id long, text string, n int, bits array<long>")
    pairs = rows.select(F.col("id").alias("a")).crossJoin(rows.select(F.col("id").alias("b"))).where("a < b")
    got = {tuple(r) for r in simhash._possible(pairs, rows, 0.8, "test").collect()}
    alike = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert alike and alike <= got and len(got) < pairs.count() / 4  # of unlike pairs few are left whose texts are moved
    apart = rows.alias("p").crossJoin(rows.alias("q")).select("p.id", F.col("q.id").alias("b"), simhash.least_apart(F.col("p.bits"), F.col("q.bits")).alias("d"))
    assert all(r.d <= len(np.setxor1d(sets[r.id], sets[r.b])) for r in apart.collect())


def test_similar_texts_of_far_fingerprints(spark):
    rng, pairs, apart = random.Random(3), [], []
    while len(pairs) < 12:
        x, y = lengthened(rng, 44, 9)  # 40 of 49 shingles
        bits = (simhash.word_bits(x.encode().split()) ^ simhash.word_bits(y.encode().split())).bit_count()
        if bits > 12:
            pairs.append((x, y))
        elif len(apart) < 12:
            apart.append(lengthened(rng, 43, 10))  # 39 of 49
    short = [("A b c", "a  B c"), ("d", "D"), ("", " ")]
    other = [("a b c d e", "a b c d f"), ("e", "f")]
    texts = [t for p in pairs + short + apart + other for t in p]
    joined = 2 * (len(pairs) + len(short))
    assert groups_of(spark, texts) == [i - i % 2 if i < joined else i for i in range(len(texts))]


def test_edited_short_texts(spark):
    """Texts of few words with one changed at an end, where fingerprints differ in many bits: as brute force says, all of them."""
    rng, texts = random.Random(7), []
    for n in (5, 6, 10, 14, 14, 20, 20, 30, 30, 60):
        for _ in range(6):
            words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            texts += [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(["y", *words[1:]])]
    want = brute_groups(texts)
    assert 60 < len(set(want)) < len(texts) and groups_of(spark, texts) == want


@pytest.mark.parametrize("crowd, base_too", [(64, True), (64, False), (5, True), (5, False)])
def test_a_crowd_beside_a_passage(spark, monkeypatch, crowd, base_too):
    """Many copies of one text, each edited elsewhere, some too much to be like it, and many texts that only share a passage."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(6)
    base, passage = [f"w{i}" for i in range(80)], [f"p{i}" for i in range(40)]
    texts = [" ".join(base)] * base_too
    for i in range(150):
        own = list(base)
        for at in rng.sample(range(0, 80, rng.choice((1, 13))), rng.randrange(1, 6)):
            own[at] = f"x{i}" if rng.random() < 0.7 else f"y{at}"
        if i % 10 == 0:  # far from the base, near each other
            for at in range(i // 10, 80, 14):
                own[at] = f"z{i}"
            texts.append(" ".join([*own[:79], "end"]))
        texts += [" ".join(own), " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(40)])]
    want = brute_groups(texts)
    assert 10 < sum(want.count(r) > 1 for r in set(want)) < 20
    assert groups_of(spark, texts) == want


@pytest.mark.parametrize("common", [0, 4_000])
def test_rare_shingles_meet(spark, monkeypatch, common):
    """All pairs of that similarity, by shingles alone: no text has a near fingerprint, some share a common passage."""
    monkeypatch.setattr(simhash, "links", lambda prints: prints.selectExpr("fp as a", "fp as b").limit(0))
    monkeypatch.setattr(simhash, "LISTED", common)
    rng, texts = random.Random(5), []
    passage = [f"p{i}" for i in range(30)]
    for _ in range(40):
        words = passage * rng.randrange(2) + [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(4, 60))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            other = list(words)
            for _ in range(rng.randrange(1, 3)):
                other[rng.randrange(len(other))] = "x"
            texts.append(" ".join(other + words[: rng.randrange(4)]))
    want = brute_groups(texts)
    assert len(set(want)) < len(want) and groups_of(spark, texts) == want


@pytest.mark.parametrize("small", [True, False])
def test_similar_groups_against_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(simhash, "BROADCAST_IDS", -1)
        monkeypatch.setattr(simhash, "BROADCAST_TEXTS", -1)
        monkeypatch.setattr(simhash, "CROWD", 3)
    rng = random.Random(8)
    say = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = [say(rng.choice((3, 40, 150, 400))) for _ in range(25)]
    for base in texts[:12]:
        own = base
        for _ in range(8):
            own = [w if rng.random() > 0.012 else f"x{rng.randrange(999)}" for w in own]
            texts.append(own)
    texts = [" ".join(t) for t in texts] + [None, "", " ", "one", "ONE"]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in enumerate(texts)], "doc_id long, text string, digest int, row int")
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()} == dict(enumerate(brute_groups(texts)))
    assert simhash.similar_groups(df.limit(0)).count() == 0


# The pipeline


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    return out


def test_each_stage_does_its_work(spark, sf_dir, stages):
    first, good, single, clean, private, tokens = ({r.doc_id: r for r in s} for s in stages)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = [d in good for d in first if labels.get(d) == 1]
    assert sum(kept) / len(kept) > 0.95 and set(good) <= set(first)
    ids = sorted(good)
    assert set(single) == {ids[i] for i, r in enumerate(brute_groups([good[d].text for d in ids])) if r == i}
    from tests.llm.test_text_operators import contamination

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = contamination([r.text for r in single.values()], items)
    assert set(clean) == {d for d, h in zip(single, hit) if not h[4]}
    assert set(private) == set(clean) == set(tokens) and all(r.decodes for r in tokens.values())
    for d, r in private.items():
        if not re.search(r"[0-9@]", clean[d].text):
            assert r.text == clean[d].text
        assert r.n_chars == len(r.text)
    assert [len(s) for s in stages[1:]] == [len(x) for x in (good, single, clean, private, tokens)]


def test_near_copies_with_null_and_shared_ids(spark):
    rng = random.Random(4)
    one, two, three, four, five = (" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(5))
    rows = [(None, one), (None, two), (None, two + " more"), (None, two), (1, three), (1, four), (0, four + " more"), (2, five), (2, five), (None, None), (3, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], schema).repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    twos = [r for r in got if r[1] in (two, two + " more")]
    assert len(twos) == 1 and twos[0][0] is None
    assert sorted((r for r in got if r not in twos), key=str) == sorted([(None, one), (1, three), (0, four + " more"), (2, five), (3, "")], key=str)


def test_near_dedup_leaves_no_copy_of_the_texts(spark, monkeypatch, tmp_path):
    """What it writes on the way is dropped, so are shuffle files, and of rows alike in id and text the first stays."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(200)) for _ in range(60)]
    rows = [(i, t, "en", "s", i) for i, t in enumerate(texts)] + [(0, texts[0], "fr", "s", 1), (7, texts[7] + " more", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    for module in (shared, graph):
        monkeypatch.setattr(module, "shared_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in got if r.doc_id != 7) == [(i, t, "en") for i, t in enumerate(texts) if i != 7]
    assert [r.doc_id for r in got].count(7) == 1
    left = {re.sub("-[0-9a-f]{32}$", "", p.name) for p in tmp_path.iterdir()}
    assert not {x for x in left if re.search("texts|chunks|marks|differences|candidates", x)}, left
    assert "similar-others" in left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def dense_references(sets):
    """As simhash.references, from one matrix of all shingles."""
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros((len(sets), len(every)), np.float32)
    held[np.repeat(np.arange(len(sets)), [len(x) for x in sets]), place] = 1
    both, sizes = held @ held.T, held.sum(axis=1)
    like = both >= simhash.LIKE_SEED * (sizes[:, None] + sizes[None, :] - both)
    free, out = np.ones(len(sets), bool), []
    while free.any() and len(out) < simhash.REFERENCES:
        own = free & like[int((like[:, free].sum(axis=1) * free).argmax())]
        if out and own.sum() < max(2, len(sets) // 32):
            break
        out.append(every[held[own].sum(axis=0) * 2 > own.sum()])
        free &= ~own
    return out


def test_references_without_a_matrix_of_all_shingles(monkeypatch):
    rng = np.random.default_rng(6)
    centres = [rng.choice(1 << 40, 300, replace=False) for _ in range(3)]
    sets = [np.unique(np.concatenate([rng.choice(centres[i % 3], 260, replace=False), rng.integers(0, 1 << 40, 30)])) for i in range(90)]
    for some in (sets, sets[:1], [*sets[:40], np.arange(50)], [rng.integers(0, 1 << 40, 20) for _ in range(9)]):
        some, most = [np.unique(x) for x in some], simhash.REFERENCE_COLUMNS
        for columns in (7, most):
            monkeypatch.setattr(simhash, "REFERENCE_COLUMNS", columns)
            for got, want in zip(simhash.references(some), dense_references(some), strict=True):
                assert got.tolist() == want.tolist()
        monkeypatch.setattr(simhash, "REFERENCE_COLUMNS", 4096)
    tracemalloc.start()
    apart = [np.arange(i * 2000, (i + 1) * 2000) for i in range(200)]
    simhash.references([np.sort(np.append(x, 10**9)) for x in apart])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6  # a matrix of all takes 320 MB


def test_stages_of_odd_rows(spark, sf_dir):
    """Null and repeated ids, null, empty and very long texts, repeated rows, other columns, and no rows at all, in each stage."""
    long = " ".join(f"word{i}" for i in range(30_000))
    texts = [None, "", " ", "A short text.", "A short text.", long, "mail a@b.org or call (212) 555-0100", "é" * 20_000]
    rows = [(d, t, None, "s", None, "own", 1.5) for d in (None, 1, 1, 2) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row string, score double").repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        kept = out.collect()
        assert out.columns[:5] == corpus_pipeline.COLUMNS and (name == "byte-level BPE" or len(out.columns) == 5)
        if name in ("benchmark decontamination", "PII pseudonyms", "byte-level BPE"):
            assert len(kept) == len(rows), name
        elif name == "SimHash near-dedup":
            assert len(kept) == 5 and {r.doc_id for r in kept} == {1}
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, sf_dir).collect()} == {r.doc_id: r.token_ids for r in stages[-1]}


def test_phones_of_both_kinds_never_meet(spark):
    """Ten-digit numbers that can't be North American stay so, so no two numbers get one pseudonym."""
    other = [f"(123) {i:03d}-{(i * 7919) % 10_000:04d}" for i in range(0, 1000, 2)] + [f"(234) {i % 200:03d}-{i:04d}" for i in range(200)] + ["(199) 999-9999", "(000) 000-0000", "(999) 199-9999"]
    american = [f"({i}) {i}-{i:04d}" for i in range(200, 1000, 3)]
    rows = spark.createDataFrame([(x,) for x in other + american], "f string").select("f", pii.phone("key", F.col("f")).alias("p")).collect()
    to = {r.f: r.p for r in rows}
    assert len(set(to.values())) == len(to) and all(re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", p) for p in to.values())
    kind = lambda p: p[1] >= "2" and p[6] >= "2"
    assert all(kind(to[x]) for x in american) and not any(kind(to[x]) for x in other)
