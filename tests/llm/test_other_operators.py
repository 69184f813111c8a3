"""Personal data, WARC, main text, media, language, mixing, URLs."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlas.llm import htmltext, jpeg, langid, media, mixing, pii, queries, urlfilter, warc
from statlas.llm._util import scratch

DATA = "/root/testdata/sf0.001"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            n = sum(c.isdigit() for c in m[0])
            good = kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 14 <= n <= 19 and luhn(m[0])) or (kind == "phone" and 10 <= n <= 15)
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_personal_data_base_spans(spark):
    r = random.Random(1)
    alphabet = "aZ9.@+-% ()é😀0123456789._"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(200))) for _ in range(300)]
    texts += ["é😀 a.b@c-d.e f@g.h%i@j.k", "x@y.z_q@r.s", "ip 001.02.3.255 999.1.1.1 1.2.3.4.5.6.7.8", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 123-4567.", "1" * 5000, "a" * 50000 + "@b", "." * 3000, "1." * 3000, None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    got = {x.doc_id: [(s.start, s.rank, s.end, s.kind) for s in x.pii if s.kind in pii.BASE] for x in pii.with_spans(docs).collect()}
    assert got == {i: base_spans(t or "") for i, t in enumerate(texts)}


def test_personal_data_added_kinds_and_redaction(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33. SSN 123-45-6789; code 123-45-6789. Call (212) 555-0100 or a@b.co"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.with_spans(docs).select("pii", pii.redacted(F.col("text"), F.col("pii")).alias("out")).first()
    assert [(s.kind, s.text) for s in row.pii] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789"), ("local_phone", "(212) 555-0100"), ("email", "a@b.co")]
    assert row.out == "IBAN [IBAN], not GB82 WEST 1234 5698 7654 33. SSN [SSN]; code 123-45-6789. Call [LOCAL_PHONE] or [EMAIL]"


def test_warc_round_trip(spark):
    r = random.Random(2)
    noise = "".join(chr(r.randrange(33, 1000)) for _ in range(300_000))
    rows = [(1, "http://a/ü b", "x"), (2, "http://b", "x"), (3, None, None), (4, "u", ""), (5, "c", noise), (6, "d", noise), (6, "d", noise), (7, "\u0080", "<p>é</p>")]
    rows += [(100 + i, f"http://h/{i}", f"<html>{i}" * r.randrange(2000)) for i in range(60)]
    pages = spark.createDataFrame([(*x, "y") for x in rows], "page_id long, url string, html string, sha1 string").repartition(3)
    path = scratch(spark, "warc")
    warc.write_warc(pages, path)
    for size in (3000, 1 << 20):
        got = warc.read_warc(spark, path, size).collect()
        assert len(got) == len(rows)
        by_payload: dict[bytes, int] = {}
        for i, _, h in rows:
            by_payload[(h or "").encode()] = max(i, by_payload.get((h or "").encode(), -1))
        urls = {i: u for i, u, _ in rows}
        html = {i: (h or "").encode() for i, _, h in rows}
        for x in got:
            body = html[x.page_id]
            assert x.url == urls[x.page_id] and x.payload_bytes == len(body)
            assert x.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
            holder = by_payload[body]
            assert (x.record_type, x.refers_to) == (("response", None) if x.page_id == holder else ("revisit", holder))
            assert x.payload == (body if x.record_type == "response" else None)


def test_warc_without_rows_or_records(spark):
    path = scratch(spark, "warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 0
    assert warc.parse(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n") is None


def test_an_exchange_finds_the_same_references(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "page_id long, url string, html string")
    base = pages.select("page_id", "url", warc.payload_of(F.col("html")).alias("payload")).withColumn("sha1", F.unhex(F.sha1("payload")))
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", -1)
    assert sorted((x.page_id, x.refers_to) for x in warc.references(base).collect()) == [(1, 2), (2, None), (3, None)]


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News, all of it</a></ul></nav><!-- <p>hidden</p> --><div class="cookie-notice"><p>We use cookies, as all do. Accept?</p></div>
<article><h1>A&nbsp;title</h1><p>First  paragraph, with <b>bo</b>ld
text &amp; more.<p>Second &lt;one&gt;.<br>After a break.</p><form><p>Subscribe, please.</p></form><div class=comments><p>I disagree, and strongly so, dear author.</p></div></article>
<aside><p>Related stories, a long list of them, with commas, many.</p></aside><footer>&copy; me, today.</footer></body></html>"""


def test_main_text():
    assert htmltext.main_text(PAGE) == "A title First paragraph, with bold text & more. Second <one>. After a break."
    plain = PAGE.replace("<article>", "<div id=c>").replace("</article>", "</div>")
    assert htmltext.main_text(plain) == "A title First paragraph, with bold text & more. Second <one>. After a break."
    parts = "<body><div id=c><h1>Head line</h1><div class=txt><p>One, two.</p><figure><figcaption>Three.</figcaption></figure><p>Four, five, six.</p></div></div><div hidden>No.</div><footer>f</footer></body>"
    assert htmltext.main_text(parts) == "Head line One, two. Three. Four, five, six."
    open_comments = '<article class="post comments-open"><p>Text, text.</p><article class="comment"><p>Reply, indeed.</p></article></article>'
    assert htmltext.main_text(open_comments) == "Text, text."
    for broken in ("", "<", "<p", "<!-- x", "<script>a", "<p></p>", "</div></p>"):
        assert htmltext.main_text(broken) in ("", "<")
    assert htmltext.main_text("just words") == "just words"


def test_main_text_query(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (2, None, None, 1), (2, None, None, 1)], "page_id long, url string, html string, text int")
    assert sorted((x.page_id, len(x.text)) for x in htmltext.extract(pages).collect()) == [(1, 76), (2, 0), (2, 0)]
    got = {x.page_id: x.text for x in htmltext.extract(spark.read.parquet(f"{DATA}/pages.parquet")).collect()}
    for x in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", x.html, re.S)[1]
        words = re.sub(r"<[^>]*(>|\Z)", " ", article).split()
        assert len(got[x.page_id].split()) == len(words)


def slow_idct(block: np.ndarray) -> np.ndarray:
    out = np.zeros((8, 8))
    for y in range(8):
        for x in range(8):
            for v in range(8):
                for u in range(8):
                    c = (0.5**0.5 if u == 0 else 1) * (0.5**0.5 if v == 0 else 1) / 4
                    out[y, x] += c * block[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16)
    return out


def test_inverse_transform():
    r = np.random.default_rng(1)
    row = r.integers(-60, 60, 64)
    block = np.zeros(64)
    block[jpeg.ZIGZAG] = row
    got = (row.astype(float) @ jpeg.INVERSE / (1 << jpeg.SCALE)).reshape(8, 8)
    assert np.abs(got - slow_idct(block.reshape(8, 8))).max() < 0.3


@pytest.mark.parametrize("seed", range(4))
def test_media_round_trip(seed):
    r = random.Random(seed)
    pools = [bytes(range(256)), b"hhhhhhhhhhhhhhhhhhhhhhhhhhhgi", b"hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh\x00", b"the quick brown fox "]
    payloads = [media.padded(bytes(r.choice(pools[seed]) for _ in range(r.choice([0, 1, 63, 64, 65, 5000, 30000])))) for _ in range(12)]
    files = media.encode(payloads)
    assert files == [media.encode([p])[0] for p in payloads]
    images, coefs = jpeg.coefficients(files)
    assert [media.payload(i, c) for i, c in zip(images, coefs, strict=True)] == payloads
    one = jpeg.coefficients([files[3]])
    assert media.feature(jpeg.rgb(one[0][0], one[1][0])) == media.feature(jpeg.rgb(images[3], coefs[3]))


def test_other_progressive_layouts():
    """A grey image whose height and width are no multiples of 8, whose AC bits come in three passes and with an end-of-band run."""
    r = np.random.default_rng(5)
    coef = (r.integers(-30, 30, (6, 64)) * (r.random((6, 64)) < 0.2)).astype(np.int16)
    coef[1:5, 20:] = 0
    lane = np.zeros(6, int)
    dc = coef[:, 0].astype(np.int64) >> 2
    scans = [(media._sos([1], 0, 0, 0, 2), jpeg.dc_first_bits(dc, np.r_[0, dc[:-1]], lane))]
    scans.append((media._sos([1], 1, 63, 0, 2), jpeg.ac_first_bits(coef, 1, 63, 2, lane)))
    for shift in (1, 0):
        scans.append((media._sos([1], 0, 0, shift + 1, shift), jpeg.Bits((coef[:, 0].astype(np.int64) >> shift & 1).astype(np.uint64), np.ones(6, np.int64), lane)))
        scans.append((media._sos([1], 1, 63, shift + 1, shift), jpeg.ac_refine_bits(coef, 1, 63, shift, lane)))
    body = b"".join(head + jpeg.packed(bits, 1)[0].tobytes() for head, bits in scans)
    frame = bytes([8, 0, 13, 0, 20, 1, 1, 0x11, 0])
    tables = jpeg.segment(0xC4, bytes([0]) + jpeg.DC_TABLE) + jpeg.segment(0xC4, bytes([0x10]) + jpeg.AC_TABLE)
    data = b"\xff\xd8" + media.HEAD + jpeg.segment(0xC2, frame) + tables + body + b"\xff\xd9"
    images, coefs = jpeg.coefficients([data])
    assert (coefs[0] == coef).all()
    picture = jpeg.rgb(images[0], coefs[0])
    assert picture.shape == (13, 20, 3) and (picture[:, :, 0] == picture[:, :, 2]).all()
    # one run that ends the bands of all six blocks: code 1010 is symbol 0x20 in a table of its own
    own = jpeg.table({4: [0x00, 0x20]})
    tables = jpeg.segment(0xC4, bytes([0]) + jpeg.DC_TABLE) + jpeg.segment(0xC4, bytes([0x10]) + own)
    run = media._sos([1], 1, 63, 0, 0) + bytes([0b00011011])  # 0001, two extra bits 10: 4 + 2 blocks, filled up with ones
    data = b"\xff\xd8" + media.HEAD + jpeg.segment(0xC2, frame) + tables + scans[0][0] + jpeg.packed(scans[0][1], 1)[0].tobytes() + run + b"\xff\xd9"
    assert (jpeg.coefficients([data])[1][0][:, 1:] == 0).all()


def test_media_query(spark):
    rows = {x.doc_id: (x.text or "").encode() for x in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for x in queries.op7_media(spark, DATA).collect():
        full = media.padded(rows[x.doc_id])
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(rows[x.doc_id]), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "é" * 5000)], "doc_id long, text string")
    out = {x.doc_id: x for x in media.load(media.store(docs), tensors=True).collect()}
    assert out[1].payload == out[2].payload == bytes(64) and len(out[None].rgb) == out[None].height * out[None].width * 3


def test_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = queries.op8_language(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in got if x.held_out]
    assert len(got) == docs.count() and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    assert sum(x.lang == x.lang_pred for x in held) >= 0.95 * len(held) and all(0 <= x.score <= 1 for x in got)


def test_language_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 0), (2, "", None, 0), (3, "12 %", "de", 0), (4, "éa", "x", 0), (4, "éa", "x", 0)], "doc_id long, text string, lang string, score int")
    model = langid.fit(docs)
    assert model.languages == ["x"]
    assert sorted((x.doc_id, x.lang_pred) for x in langid.identify(docs, model).collect()) == [(1, "und"), (2, "und"), (3, "und"), (4, "x"), (4, "x")]
    assert langid.fit(docs.where("false")) is None
    assert {x.lang_pred for x in langid.identify(docs, None).collect()} == {"und"}


def plain_mix(rows, mix: mixing.Mix) -> dict[int, int]:
    def fill(budget: float, children: dict[str, tuple[float, float]]) -> dict[str, float]:
        left, out = dict(children), {}
        while left:
            level = budget / sum(w for w, _ in left.values())
            full = [k for k, (w, c) in left.items() if c <= level * w + 1e-9]
            if not full:
                return out | {k: level * w for k, (w, _) in left.items()}
            for k in full:
                out[k] = left.pop(k)[1]
                budget -= out[k]
        return out

    leaves: dict[tuple, list] = {}
    for doc_id, text, lang, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        source = source if source is not None else "unknown"
        leaf = (f"d{ord(source[-1]) % 3}", lang if lang is not None else "und", source)
        if n:
            leaves.setdefault(leaf, []).append((doc_id, n))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    top = int(sum(tokens.values()) * mix.share)
    cap = lambda *p: sum(t for leaf, t in tokens.items() if leaf[: len(p)] == p) * mix.max_epochs
    out: dict[int, int] = {}
    first = fill(top, {d: (mix.domains.get(d, 1), cap(d)) for d in {leaf[0] for leaf in leaves}})
    for d, b in first.items():
        second = fill(b, {x: (mix.languages.get(x, 1), cap(d, x)) for x in {leaf[1] for leaf in leaves if leaf[0] == d}})
        for x, c in second.items():
            third = fill(c, {s: (mix.sources.get(s, 1), cap(d, x, s)) for s in {leaf[2] for leaf in leaves if leaf[:2] == (d, x)}})
            for s, amount in third.items():
                docs, budget = leaves[d, x, s], int(amount + 1e-6)
                epochs, rest = divmod(budget, tokens[d, x, s])
                order = sorted(docs, key=lambda i: int(hashlib.md5(f"{mix.seed}:{epochs}:{i[0]}".encode()).hexdigest()[:15], 16))
                upto, last = 0, True
                for doc_id, n in order:
                    upto += n
                    last = last and 2 * upto - n <= 2 * rest and rest > 0
                    if epochs + last:
                        out[doc_id] = int(epochs + last)
    return out


def test_mixing(spark):
    r = random.Random(3)
    rows = [(i, " ".join("w" * r.randrange(1, 60)), r.choice(["en", "de", None]), r.choice(["s1", "s1", "s1", "s2", "s33", None])) for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", "s2")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, source string, copies int").repartition(3)
    for share, epochs in ((0.5, 3), (2.5, 3), (5.0, 2)):
        mix = mixing.Mix(domains={"d0": 5, "d1": 1}, languages={"en": 3}, share=share, max_epochs=epochs)
        got = {x.doc_id: x.copies for x in mixing.mixed(docs, mix).collect()}
        assert got == plain_mix(rows, mix)
    assert mixing.mixed(docs.where("false"), mix).count() == 0


RULES = queries.RULES


def test_urls(spark):
    link = '<html><head><link rel="canonical" href="{}"></head>'
    rows = [
        (1, "http://A.example.ORG/en/5?x#y", ""),
        (2, "https://sub.example.org/es/a", None),
        (3, "https://example.org/en/1", ""),
        (4, "//nothing", ""),
        (5, None, ""),
        (6, "http://shop.net/item", link.format("https://x.com/de/9")),
        (7, "http://other.net/a", "<META content='0; url=http://shop.net/item' http-equiv=refresh>"),
        (8, "http://free.org/ok", link.format("http://other.net/a")),
        (9, "http://far.net", link.format("/b")),
        (10, "http://xorg/", ""),
        (11, "http://other.net/a#part", ""),
    ]
    pages = spark.createDataFrame([(*x, 0) for x in rows], "page_id long, url string, html string, verdict int")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urlfilter.judge(pages, RULES).collect()}
    assert got == {
        1: ("a.example.org", "/en/5", "org/", "allow"),
        2: ("sub.example.org", "/es/a", "example.org/es/", "block"),
        3: ("example.org", "/en/1", "example.org/en/1", "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("shop.net", "/item", None, "block"),
        7: ("other.net", "/a", None, "block"),
        8: ("free.org", "/ok", "org/", "allow"),
        9: ("far.net", "", None, "allow"),
        10: ("xorg", "/", None, "allow"),
        11: ("other.net", "/a", None, "block"),
    }
    assert urlfilter.judge(pages.where("false"), RULES).count() == 0


def test_many_rules_by_join_are_those_compiled(spark, monkeypatch):
    r = random.Random(9)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "y.net"]
    rules = list({(h, p): urlfilter.Rule(r.choice(["allow", "block"]), h, p) for h in hosts for p in ("/", "/a", "/a/b", "/ab", "/é/", "/b/" + "c" * r.randrange(9))}.values())
    rules += [urlfilter.Rule("allow", "org", "/a"), urlfilter.Rule("block", "org", "/a")]  # a tie: the allow counts
    urls = [f"http://{s}{h}{p}" for s in ("", "w.", "W.w.") for h in [*hosts, "aorg", "org."] for p in ("", "/", "/a", "/a/bc", "/abc?x", "/é/ü", "/b/ccc", "/a/" + "b" * 5000)]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(-1, None, None), (0, urls[0], None)], "page_id long, url string, html string")
    one = sorted((x.page_id, str(x.rule), x.verdict) for x in urlfilter.judge(pages, rules).collect())
    monkeypatch.setattr(urlfilter, "COMPILED_RULES", 3)
    assert sorted((x.page_id, str(x.rule), x.verdict) for x in urlfilter.judge(pages, rules).collect()) == one
    assert urlfilter.judge(pages.where("false"), rules).count() == 0


def test_forms_of_links(spark):
    bad, tag = "http://x.com/de/9", '<link rel="{}" href="{}">'
    rows = [
        (1, "http://a.net/p/q/r", tag.format("alternate canonical", "../../hub")),
        (2, "http://a.net/hub", tag.format("canonical", bad)),
        (3, "http://b.net", tag.format("canonical", "http://b.net/")),
        (4, "http://b.net/", tag.format("canonical", bad)),
        (5, "http://c.net/s?id=1", tag.format("canonical", "?id=2")),
        (6, "http://c.net/s?id=2", tag.format("canonical", bad)),
        (7, "http://d.net/", "<!-- " + tag.format("canonical", bad) + " -->"),
        (8, "http://e.net/", "<script>'" + tag.format("canonical", bad) + "'</script>"),
        (9, "http://f.net/", tag.format("noncanonical", bad)),
        (10, "http://g.net/", tag.format("canonical", "#top")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {x.page_id for x in urlfilter.judge(pages, RULES).collect() if x.verdict == "block"}
    assert got == {1, 2, 3, 4, 5, 6}
