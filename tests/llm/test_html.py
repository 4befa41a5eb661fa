"""Visibility, implied ends, comments and spanned tables of the page renderer; no visible word is lost."""

import random

import pytest

from pressline.llm.html_text import render

SPANNED = """<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>wide cell<td>f
<tr><td rowspan=0>g<td>h<td>i<tr><td>j<td>k</table>"""


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>x</title><body><p>Hello</body></html>", "Hello"),
    ("<head><meta charset=utf-8><p>Hello there", "Hello there"),
    ("<html><head><title>x</title>Hello <b>there</b>", "Hello there"),
    ("<head><style>p{}</style><script>var a = '<p>'</script><noscript>n</noscript><div>x", "x"),
    ("<html><head></head><body>a<head>b<body hidden>c", "abc"),
    ("<head><template><p>t</p></template><link><h1>T</h1>", "T"),
    ("<p>a<!-->b", "ab"), ("<p>a<!--->b", "ab"), ("a<!-- c --!>b", "ab"), ("a<!-- x -- > --> b", "a b"), ("a<!-- open", "a"),
    ("<div style='visibility:hidden'>a <b style='visibility: visible'>b</b> c</div>d", "b\nd"),
    ("<p style='--my-display:none'>a", "a"), ("<p style='color:red; DISPLAY : none !important'>a</p>b", "b"),
    ("<p style='display:none;display:block'>a", "a"), ("<p style='display:none!important;display:block'>a", ""),
    ("<p style='/*display:none*/'>a", "a"), ("<p hidden style='display:block'>a", "a"), ("<p hidden>a</p>b", "b"),
    ("<style>.h{display:none} .h.s{display:block} #i, em {visibility:hidden} @media print{p{display:none}}</style>"
     "<p class='x h'>a<p class='s h'>b<p id=i>c<p><em>d</em>e", "b\n\ne"),
    ("<style>p{display:none !important}</style><p style='display:block'>a</p>b", "b"),
    ("<style>/* p{display:none} */ div p{display:none} p>a{display:none}</style><p>a <a>b</a>", "a b"),
    ("<p class=h>a<p>b<style>.h{display:none}</style>", "b"), ("<style>p { display: none", ""), ("<style>*{display:none} div{display:block}</style><div>a<p>b", "a"),
    (SPANNED, "a  b  c\n   d  e\nwide cell  f\ng  h  i\n   j  k"),
    ("<table><tr><td colspan=5000>a<td>b</table>", "a" + " " * 1999 + "b"),
])
def test_pages(page, want):
    assert render(page) == want


def test_no_visible_word_is_lost():
    rng = random.Random(4)
    inline, block = ["b", "i", "span", "a"], ["p", "div", "li", "ul", "h2", "section", "blockquote", "dd"]
    for _ in range(300):
        words, parts, k = [], [], 0
        head = rng.choice(["", "<html>", "<html><head><title>unseen</title>", "<head><meta a=b>", "<!doctype html><head></head><body>"])
        for _ in range(rng.randint(1, 40)):
            kind = rng.random()
            if kind < 0.4:
                k += 1
                words.append(f"w{k}")
                parts.append(f" w{k} ")
            elif kind < 0.7:
                parts.append(f"<{rng.choice(inline + block)} title='a > b' x=\"q\"{rng.choice(['', ' /', ' y=o\"k'])}>")
            elif kind < 0.9:
                parts.append(f"</{rng.choice(inline + block)}>")
            else:
                parts.append(rng.choice(["<!-- gone -->", "<!-->", "<br>", "<style>.z{display:none}</style>", "<p hidden>gone</p>",
                                         "<b class=z>gone</b>", "<script>gone</script>"]))
        text = render(head + "".join(parts) + "<style>.z{display:none}</style>")
        assert [x for x in text.split() if x != "-"] == words
