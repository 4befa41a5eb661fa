"""Text rules on literal rows."""

import pytest
from pyspark.sql import functions as F

from pressline.functions import content as K
from pressline.functions import html as H
from pressline.functions import times as M
from pressline.functions import titles as N


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_titles(spark):
    assert column(spark, ["  First\n  Item Title ", None, ""], N.display_title) == [
        "First Item Title", "", ""]
    assert column(spark, ["Straße “Ｘ” — y", "ﬁne ‘Q’", "PLAIN"], N.dedup_title) == [
        'strasse "x" - y', "fine 'q'", "plain"]


def test_white_space_set_is_complete():
    assert set(N.SPACES) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_slugs(spark):
    assert column(spark, ["Élan vital!", "日本", "--A  b--", "x_y", None], N.slugify) == [
        "elan-vital", "item", "a-b", "x-y", "item"]


def test_urls(spark):
    given = ["https://Example.COM/article/?utm_source=feed&id=42#comments", "HTTP://a.example",
             "https://a.example/x/?b=1+2&c=%7E&fbclid=9", "ftp://Host/X/", "  ", None,
             "https://a.example/p?q", "https://a.example/?gclid=1", "https://a.example/x?a=b%20c"]
    got = column(spark, given, N.canonical_url)
    assert got[:6] == ["https://example.com/article?id=42", "http://a.example/",
                       "https://a.example/x?b=1+2&c=~", "ftp://Host/X/", None, None]
    assert got[6] == "https://a.example/p?q="
    assert got[7:] == ["https://a.example/", "https://a.example/x?a=b+c"]


def test_dates(spark):
    given = ["Mon, 01 Jun 2026 12:00:00 GMT", "2026-06-02T20:00:00+08:00", "2026-06-03T12:00:00Z",
             "2026-06-03 12:00:00", "2026-06-03", "Wed, 03 Jun 2026 12:00:00 +0200", "soon", None,
             "2026-02-30"]
    got = column(spark, given, lambda c: F.date_format(M.published_at(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2026-06-01 12:00:00", "2026-06-02 12:00:00", "2026-06-03 12:00:00",
                   "2026-06-03 12:00:00", "2026-06-03 00:00:00", "2026-06-03 10:00:00", None, None,
                   None]


def sanitized(spark, bodies, title="My Title", **options):
    df = spark.createDataFrame([(i, b, title) for i, b in enumerate(bodies)],
                               "i int, body string, title string")
    return H.sanitize(df, "body", "title", **options).orderBy("i").collect()


def test_sanitised_text(spark):
    rows = sanitized(spark, [
        "<div><p>Hello   World!</p><script>alert(1)</script></div>",
        "<nav>menu<p>x</nav>kept &amp;amp; <b>bold", "a\r\n\r\n\n\n  b \t c d", None, "",
        "<p class='ad x'>no</p><p id=k>yes</p>"], remove_selectors=["p.ad"])
    assert [r.sanitized_text for r in rows] == [
        "Hello World!", "kept & bold", "a\n\nb c\nd", "", "", "yes"]
    assert [r.html_detected for r in rows] == [True, True, False, False, False, True]
    assert rows[3].text_processing_status == "failed"
    assert rows[3].text_processing_reason == "missing_body" and rows[3].reduction_ratio == 0.0


def test_content_selectors(spark):
    rows = sanitized(spark, ["<div id=a>one</div><div class=b>two<i> x</i></div>", "<p>none</p>"],
                     content_selectors=["#a", "div.b"])
    assert [r.sanitized_text for r in rows] == ["one\ntwo x", ""]
    assert rows[1].text_processing_reason == "post_cleanup_empty"


def test_truncation(spark):
    row = sanitized(spark, ["This is a very long text that should be truncated"], max_length=10)[0]
    assert row.sanitized_text == "This is a " and row.was_truncated
    assert row.text_processing_reason == "truncated_to_low_context"


def test_low_context_reasons(spark):
    long = "word " * 40
    rows = sanitized(spark, [
        "<script>var a = 1;</script>", "  My Title  ", "My Title and some text",
        "<a href=1>Link Text 1</a> <a href=2>Link Text 2</a> <a href=3>Link Text 3</a> Plain",
        long + "read more, click here and follow us on", "Too short body text.", long])
    assert [r.text_processing_reason for r in rows] == [
        "post_cleanup_empty", "title_only", "title_heavy", "mostly_links", "template_heavy",
        "too_short", None]
    assert rows[-1].text_processing_status == "completed"


def test_reading_time(spark):
    given = ["word " * 200, "word " * 300, "漢" * 450, "漢" * 300 + " word" * 200, "", None]
    assert column(spark, given, K.reading_minutes) == [1, 2, 2, 2, 1, 1]


def test_fingerprint_tells_null_from_empty(spark):
    df = spark.createDataFrame(
        [("t", "a\r\nb", None, None, None), ("t", "a\nb", None, None, None),
         ("t", "a\nb", "", None, None)],
        "display_title string, summary_short string, bullet_1 string, bullet_2 string, bullet_3 string")
    prints = [r.f for r in df.select(K.content_fingerprint().alias("f")).collect()]
    import hashlib
    text = '{"display_title":"t","summary_short":"a\\nb","bullet_1":null,"bullet_2":null,"bullet_3":null}'
    assert prints[0] == prints[1] == hashlib.sha256(text.encode()).hexdigest()
    assert prints[2] != prints[0]


def test_labels(spark):
    given = ["Key Claim: x", "  * **Key Claim**: x", "__証拠レベル__：y", "The Key Claim: x", "Key Claim x",
             None]
    assert column(spark, given, K.has_label_prefix) == [True, True, True, False, False, False]
    assert column(spark, ["- **Key Claim**: x", "** ** Key Claim: x"], K.has_guarded_label) == [
        True, False]


def test_fences(spark):
    given = ["```json\n{\"a\": 1}\n```", "```{}```", " {} ", "```\nx"]
    assert column(spark, given, K.unfenced) == ['{"a": 1}', "{}", "{}", "x"]


def test_a_body_that_the_parser_refuses_fails_alone(spark):
    bad, good = sanitized(spark, ["<p>x</p><![foo[bar]]>", "<p>" + "long enough text " * 10 + "</p>"])
    assert (bad["text_processing_status"], bad["text_processing_reason"]) == ("failed", "sanitizer_exception")
    assert good["text_processing_status"] == "completed"


def test_nothing_is_cut_by_default(spark):
    row = sanitized(spark, ["word " * 5000])[0]
    assert row["sanitized_text_length"] == 24999 and not row["was_truncated"]


def read_markup(body, remove=(), keep=()):
    rules = [[r for s in given for r in H.selector_steps(s)] for given in ([*H.REMOVED_TAGS, *remove], keep)]
    reader = H._Reader(*rules)
    reader.feed(body)
    reader.close()
    return reader.result(True)[0]


def test_selectors():
    page = "<div><i><p class='body x'>A</p></i></div><p class=body data-k='v w'>D</p>"
    assert read_markup(page, keep=["div .body"]) == "A" and read_markup(page, keep=["div > .body"]) == ""
    assert read_markup(page, keep=["i > p.x, p[data-k~=w]"]) == "A\nD"
    assert read_markup(page, remove=["[data-k^='v']"]) == "A"
    for bad in ("p:first-child", "a + b", "> p", "p >", ""):
        with pytest.raises(ValueError):
            H.selector_steps(bad)


def test_unclosed_elements_cost_no_walk():
    assert read_markup("<p>x</q>" * 50_000) == "x" * 50_000


def test_every_row_brings_its_profile(spark):
    page = "<article><p>one  &amp;amp;</p></article>\n\n\n<div class='ad'>two</div>"
    profiles = {
        "none": None, "later field": (["content", "odd", "summary"], None, None, None, None, None, None),
        "selectors": (None, [".ad", "p > > b"], ["article p", "div"], None, None, None, None),
        "raw": (None, None, None, False, False, False, None), "cut": (None, None, None, None, None, None, 5),
        "nothing kept": (None, [], ["main"], True, True, True, 0)}
    rows = [(k, "Title", page, "plain text", p) for k, p in profiles.items()] + [
        ("empty", "Title", " ", None, None), ("plain kept", "Title", "a  b", None, (None, None, ["p"], None, None, None, None)),
        ("refused", "Title", "<p>x</p><![foo[bar]]>", None, None)]
    df = spark.createDataFrame(rows, f"name string, title string, summary string, content string, profile struct<{H.PROFILE.replace(' ', ':').replace(',:', ', ')}>")
    got = {r["name"]: r for r in H.sanitize_by_profile(df, "profile", "title", ["summary", "content"]).collect()}
    text = {k: r["sanitized_text"] for k, r in got.items()}
    assert text == {"none": "one &\n\ntwo", "later field": "plain text", "selectors": "one &", "raw": "one  &amp;\n\n\ntwo",
                    "cut": "one &", "nothing kept": "", "empty": "", "plain kept": "", "refused": ""}
    assert got["cut"]["was_truncated"] and not got["none"]["was_truncated"]
    assert got["empty"]["text_processing_reason"] == "missing_body" and got["empty"]["text_processing_status"] == "failed"
    assert got["refused"]["text_processing_reason"] == "sanitizer_exception"
    assert got["later field"]["body"] == "plain text" and got["none"]["body"] == page
