import hashlib
import json

import pytest

from paylens.llm import warc
from paylens.llm.html_blocks import FEATURES, blocks, extract, features, keeps, main_text, trained
from paylens.llm.html_labels import PAGES

TREE = trained()
PROSE = "The council met on Monday to talk about the bridge and agreed to wait for another year."


def test_the_tree_fits_its_table():
    pairs = [(keeps(TREE, row), b.labelled) for page in PAGES for b, row in zip(blocks(page), features(blocks(page)))]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.97


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>Title</h1><p>{PROSE}</p></article>", f"Title {PROSE}"),
    (f"<nav><a href=1>Home</a></nav><article><p>{PROSE}</p></article><footer>{PROSE}</footer>", PROSE),
    (f"<article><p>A&nbsp;b &amp;\n\t c&#33;</p><script>if (a<b) x('<p>');</script><p>{PROSE}</p></article>", f"A b & c! {PROSE}"),
    (f"<article><p>one<b>two</b> {PROSE}<div class='ad'>Buy now</div></article>", f"onetwo {PROSE}"),
    (f"<article><p>{PROSE}</p><!-- <p>no</p> --><style>p{{}}</style></article><aside>{PROSE}</aside>", PROSE),
    (f"<article><p>{PROSE}</p></article><div class='comments'><p>{PROSE}</p></div>", PROSE),
    (f"<div class=cookie-banner>{PROSE}</div><main><p>{PROSE}<br>{PROSE}", f"{PROSE} {PROSE}"),
    (f"<article><p>5 < 6 {PROSE}</p></article", f"5 < 6 {PROSE}"),
    (f"<article><p class=advert>Buy!<p>{PROSE}</article>", PROSE),
    ("", ""), ("<html><head><title>x</title></head></html>", ""), ("<" * 50_000, None), ("<a " * 20_000, None), ('<a b="' * 20_000, None),
])
def test_main_text(page, text):
    found = main_text(page, TREE)
    assert text is None or found == text


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/", f"<article><p>{PROSE}</p></article>", "x", "y"), (2, None, None, "x", "y"), (None, "http://b/", "", None, "y"),
            (1, "http://a/", f"<article><p>{PROSE}</p></article>", "x", "y"), (3, "http://c/", f"<main><p>{PROSE * 20_000}", "x", "y")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, id string, record string")


def test_extract_odd_rows(pages):
    rows = extract(pages).collect()
    assert sorted((str(r.page_id), str(r.url), r.n_chars) for r in rows) == sorted(
        [("1", "http://a/", len(PROSE))] * 2 + [("2", "None", 0), ("None", "http://b/", 0), ("3", "http://c/", len(PROSE) * 20_000)])
    assert extract(pages.limit(0)).collect() == []


def test_extract_whole_table(given):
    import re

    pages = given("pages")
    rows = {r.page_id: r for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        import html
        want = " ".join(" ".join(html.unescape(p) for p in re.split(r"</?(?:p|h1|br)>", re.sub("</?b>", "", body))).split())
        assert rows[r.page_id].text == want and rows[r.page_id].n_chars == len(want) and rows[r.page_id].url == r.url


def test_derivatives_of_a_response(pages):
    response, = (r for r in warc.responses(pages.filter("url = 'http://c/'")).collect())
    fields, block = warc.parse(response.record)
    assert fields["warc-type"] == "response" and int(fields["content-length"]) == len(block)
    meta, text = (dict(zip("kind id refers target date payload block size record".split(), row)) for row in warc.derive(response.record))
    assert (meta["kind"], text["kind"]) == ("metadata", "conversion")
    for row in (meta, text):
        own, data = warc.parse(row["record"])
        assert own["warc-refers-to"] == row["refers"] == fields["warc-record-id"]
        assert own["warc-target-uri"] == "http://c/" and own["warc-payload-digest"] == fields["warc-payload-digest"]
        assert own["warc-block-digest"] == warc.digest(data) and int(own["content-length"]) == row["size"] == len(data)
        assert row["record"].endswith(b"\r\n\r\n") and row["id"] != fields["warc-record-id"]
    assert warc.parse(text["record"])[1].decode() == PROSE * 20_000
    about = json.loads(warc.parse(meta["record"])[1])
    assert about["http-headers"]["content-type"] == "text/html; charset=utf-8" and about["warc-headers"] == fields


def test_closed_svg_hides_nothing():
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>One</p><svg width='1'/><p>Two<svg><text>no</text></svg></p>"
    record = warc.serialize([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "http://a/b/"),
                             ("Content-Length", str(len(block)))], block)
    assert warc.parse(warc.derive(record)[1][-1])[1].decode() == "One\nTwo"


def test_links_titles_and_charsets():
    body = "<title>Grüße &amp; mehr</title><a href='/x?a=1&amp;b=2'>x</a><p>Süß".encode("latin-1")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n" + body
    record = warc.serialize([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "http://a/b/"),
                             ("Content-Length", str(len(block)))], block)
    meta, text = warc.derive(record)
    about = json.loads(warc.parse(meta[-1])[1])
    assert (about["title"], about["links"]) == ("Grüße & mehr", ["http://a/x?a=1&b=2"])
    assert warc.parse(text[-1])[1].decode() == "Grüße & mehr\nx\nSüß"
    assert meta[5] == "sha1:" + __import__("base64").b32encode(hashlib.sha1(body).digest()).decode()


@pytest.mark.parametrize("record", [b"", b"\r\n\r\n", b"WARC/1.1\r\nWARC-Type: request\r\n\r\nx", b"WARC/1.1\r\nno colon", b"\xff\xfe"])
def test_other_records_give_nothing(record):
    assert warc.derive(record) == []


def test_derivatives_odd_rows(spark, pages):
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 2 * pages.count()
    assert len({r.record_id for r in rows}) == 2 * (pages.count() - 1)  # repeated rows have the same ids
    records = spark.createDataFrame([("a", None), ("b", bytearray(b""))], "source_id string, record binary")
    assert warc.derivatives(records).collect() == [] and warc.derivatives(records.limit(0)).collect() == []


def used(node):
    return set() if node.feature < 0 else {FEATURES[node.feature]} | used(node.low) | used(node.high)


def test_neighbours_decide():
    assert len(used(TREE) & {"words_before", "links_before", "words_after", "links_after"}) >= 2
    link = "<div><a href=x>Elsewhere</a></div>"
    label = "<div>Three more stories</div>"
    assert main_text(f"{link}{label}{link}<div>{PROSE}</div>{label}<div>{PROSE}</div>{link}", TREE) == f"{PROSE} Three more stories {PROSE}"


@pytest.mark.parametrize("page, text", [
    (f"<svg viewBox='0'/><article><p>{PROSE}<svg><title>t</title><path d='a'/><text>no</text></svg>x</p></article>", f"{PROSE}x"),
    (f"<math/><article><p>{PROSE}</p></article>", PROSE),
    (f"<article><p>{PROSE}<svg><svg></svg> no</svg> yes</p></article>", f"{PROSE} yes"),
    (f"<div><select><option>no</div><article><p>{PROSE}</p></article>", PROSE),
    (f"<div><noscript><p>no</div><article><p>{PROSE}</p></article>", PROSE),
    (f"<article><p>{PROSE}</p><textarea></p></div> no</textarea><p>yes, it goes on</p></article>", f"{PROSE} yes, it goes on"),
    (f"<article><p>{PROSE}</p><script>no <p>{PROSE}", PROSE),
    (f"<form><nav><a href=1>Home</a></nav><div><h1>Late news</h1><p>{PROSE}</p><p>{PROSE}</p></div></form>", f"Late news {PROSE} {PROSE}"),
    (f"<form><div><a href=1>Home</a></div><article><p>{PROSE}</p></article></form>", PROSE),
    (f"<article><p>{PROSE}</p><form><p>{PROSE}</p></form></article>", PROSE),
    (f"<form><p>{PROSE}</p></form>", ""),
    (f"<div class='copyright-law'><article><p>{PROSE}</p></article></div>", PROSE),
    (f"<div class='legal-notice'><p>{PROSE}</p></div><article><p>{PROSE}</p></article>", PROSE),
    ("<select>" * 20_000, None), ("<textarea>" * 20_000, None), ("<svg><p>" * 10_000, None), ("<form><h1>" * 3_000, None),
])
def test_unseen_elements_forms_and_topics(page, text):
    found = main_text(page, TREE)
    assert text is None or found == text
