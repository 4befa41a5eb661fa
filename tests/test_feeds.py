"""Feed payload samples."""

import pytest
from pyspark.sql import functions as F

from pressline.functions.times import published_at
from pressline.sources import feeds

ATOM = '<feed xmlns="http://www.w3.org/2005/Atom">{}</feed>'
RSS = '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>c</title>{}</channel></rss>'

SAMPLES = {
    "rss": RSS.format("<item><title>  First   Item\n Title </title><link>https://Example.COM/a/?utm_source=f"
                      "&amp;id=42#c</link><guid>g1</guid><pubDate>Mon, 01 Jun 2026 12:00:00 GMT</pubDate>"
                      "<description>First.</description></item>"),
    "atom": ATOM.format('<entry><title>Atom</title><id>urn:1</id><link rel="alternate" '
                        'href="https://example.org/1"/><updated>2026-06-02T20:00:00+08:00</updated>'
                        "<summary>Text.</summary></entry>"),
    "content": ATOM.format('<entry><title>C</title><id>a2</id><link href="https://example.org/2"/>'
                           '<content type="html">&lt;p&gt;Body&lt;/p&gt;</content></entry>'),
    "both": ATOM.format("<entry><title>B</title><id>a3</id><summary>wins</summary><content>loses</content>"
                        "</entry>"),
    "guid": RSS.format('<item><title>G</title><guid isPermaLink="false">g7</guid></item>'),
    "permalink": RSS.format("<item><title>P</title><guid>https://example.com/p/</guid></item>"),
    "enclosure": RSS.format('<item><title>E</title><guid isPermaLink="false">e9</guid>'
                            '<enclosure url="https://example.net/ep9.mp3" type="audio/mpeg" length="1"/></item>'),
    "minimal": RSS.format("<item><description>Only.</description></item>"),
    "two": RSS.format("<item><title>one</title></item><item><title>two</title></item>"),
    "media": RSS.replace("<rss ", '<rss xmlns:media="m" xmlns:itunes="i" xmlns:dc="http://purl.org/dc/elements/1.1/" '
                         'xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:atom="http://www.w3.org/2005/Atom" ').format(
        "<item><title>Real</title><media:title>Caption</media:title><atom:link href='https://self.example/'/>"
        "<link>https://example.com/m</link><media:description>Alt</media:description><itunes:summary>S"
        "</itunes:summary><content:encoded><![CDATA[<p>Whole</p>]]></content:encoded>"
        "<dc:date>2026-06-01T12:00:00Z</dc:date></item>"),
    "xhtml": ATOM.format('<entry><title type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">A <b>b</b></div></title>'
                         '<content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml"><p>x</p></div></content>'
                         "</entry>"),
    "prefixed": '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>P</a:title></a:entry></a:feed>',
    "other prefixes": RSS.replace("<rss ", '<rss xmlns:body="http://purl.org/rss/1.0/modules/content/" '
                                  "xmlns:d.c='http://purl.org/dc/elements/1.1/' xmlns:content='urn:other' ").format(
        "<item><title>O</title><content:encoded>not this</content:encoded><body:encoded><![CDATA[<body:b> <content:x> "
        "]]>tail</body:encoded><!-- <body:encoded> --><d.c:date>2026-06-01T12:00:00Z</d.c:date></item>"),
    "prefixed with tags in CDATA": '<?xml version="1.0"?><!-- c --><a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry>'
                                   "<a:title>Q</a:title><a:content><![CDATA[<a:b>x</a:b>]]></a:content></a:entry></a:feed>",
    "empty": RSS.format(""),
    "malformed": "<rss><channel><item><title>x</item></channel>",
    "text": "not xml",
}


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(SAMPLES.items()), "name string, payload string")
    return feeds.parse_payloads(df)


def test_malformed_payloads_are_source_failures(parsed):
    assert {r.name for r in feeds.parse_failures(parsed).collect()} == {"malformed", "text"}


def test_entries(parsed):
    rows = {}
    for r in feeds.normalise(feeds.feed_entries(parsed)).collect():
        rows.setdefault(r.name, []).append(r)
    assert set(rows) == set(SAMPLES) - {"malformed", "text", "empty"}
    first = rows["rss"][0]
    assert (first.title, first.guid, first.canonical_url, first.summary) == (
        "First Item Title", "g1", "https://example.com/a?id=42", "First.")
    assert first.published_at.isoformat() == "2026-06-01T12:00:00"
    assert rows["atom"][0].published_at.isoformat() == "2026-06-02T12:00:00"
    assert rows["content"][0].summary == "<p>Body</p>" and rows["both"][0].summary == "wins"
    assert rows["guid"][0].canonical_url is None and rows["guid"][0].guid == "g7"
    assert rows["permalink"][0].canonical_url == "https://example.com/p"
    assert rows["enclosure"][0].canonical_url == "https://example.net/ep9.mp3"
    assert rows["minimal"][0].title == "" and rows["minimal"][0].summary == "Only."
    assert [r.title for r in rows["two"]] == ["one", "two"]
    media = rows["media"][0]
    assert (media.title, media.canonical_url, media.summary) == ("Real", "https://example.com/m", "<p>Whole</p>")
    assert media.published_at.isoformat() == "2026-06-01T12:00:00"
    assert rows["xhtml"][0].title == "A <b>b</b>" and rows["xhtml"][0].summary == "<p>x</p>"
    assert rows["prefixed"][0].title == "P"
    other = rows["other prefixes"][0]
    assert (other.title, other.summary) == ("O", "<body:b> <content:x> tail")
    assert other.published_at.isoformat() == "2026-06-01T12:00:00"
    inner = rows["prefixed with tags in CDATA"][0]
    assert (inner.title, inner.summary) == ("Q", "<a:b>x</a:b>")


@pytest.mark.parametrize("raw, iso", [
    ("Mon, 01 Jun 2026 12:00 GMT", "2026-06-01T12:00:00"), ("Mon 1 Jun 2026 07:00:00 EST", "2026-06-01T12:00:00"),
    ("1 Jun 26 12:00:00 +0000", "2026-06-01T12:00:00"), ("Monday, 1 Jun 99 12:00 PDT", "1999-06-01T19:00:00"),
    ("1 Jun 2026 12:00:00", "2026-06-01T12:00:00"), ("01 Jun 2026 12:00:00 XYZ", None), (None, None)])
def test_dates(spark, raw, iso):
    got = spark.createDataFrame([(raw,)], "raw string").select(published_at(F.col("raw")).alias("at")).first().at
    assert (got and got.isoformat()) == iso
