"""Body text: HTML to text, white space, truncation and the low-context label.

Parsing markup needs a parser, so one Arrow-batched function turns markup into three values; every
later step is built-in expressions.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressline import fixed_values as V
from pressline.functions.titles import SPACE_CLASS, strip

# --- fixed values: markup vocabulary ------------------------------------------------------------
REMOVED_TAGS = ["script", "style", "nav", "footer"]
SILENT_TAGS = {"script", "style", "template"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
             "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
             "command", "frame", "image", "isindex", "nextid", "spacer"}

PARSED = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("plain_length", T.LongType()),
    T.StructField("link_length", T.LongType()), T.StructField("has_tag", T.BooleanType()),
    T.StructField("failed", T.BooleanType())])


def has_markup(c: Column) -> Column:
    """A tag or an entity occurs in the text."""
    entity = c.rlike("&[a-zA-Z0-9#]+;") & c.contains("&") & c.contains(";")
    tag = c.rlike("<[a-zA-Z][^>]*>")
    return F.coalesce(entity | tag, F.lit(False))


_PIECE = re.compile(r"""([.#])([\w-]+)|\[\s*([\w:-]+)\s*(?:([~^$*]?=)\s*("[^"]*"|'[^']*'|[^\]\s]+)\s*)?\]""")
_TAG = re.compile(r"\*|[A-Za-z][\w-]*")


def _compound(text: str) -> tuple[str, list[tuple[str, str, str]]]:
    """Tag and (attribute, operator, value) tests of ``tag#id.class[name=value]``."""
    head = _TAG.match(text)
    at, tests = (head.end() if head else 0), []
    while at < len(text):
        m = _PIECE.match(text, at)
        if not m:
            raise ValueError(f"selector not supported: {text}")
        if m[1]:
            tests.append(("id", "=", m[2]) if m[1] == "#" else ("class", "~=", m[2]))
        else:
            tests.append((m[3].lower(), m[4] or "", (m[5] or "").strip("\"'")))
        at = m.end()
    if not head and not tests:
        raise ValueError("empty selector")
    tag = head[0].lower() if head else ""
    return ("" if tag == "*" else tag), tests


def selector_steps(selector: str) -> list[list[tuple[bool, tuple]]]:
    """The alternatives of a selector, each as (only direct children, compound) from outside in.

    Descendant and child combinators, tags, ids, classes and attribute tests are known; anything else
    raises ValueError, so that a profile never silently matches nothing.
    """
    rules = []
    for part in re.split(r",(?![^\[]*\])", selector):
        words = re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", part)
        steps, child = [], False
        for word in words:
            if word == ">":
                if child or not steps:
                    raise ValueError(f"selector not supported: {selector}")
                child = True
            else:
                steps.append((child, _compound(word)))
                child = False
        if child or not steps:
            raise ValueError(f"selector not supported: {selector}")
        rules.append(steps)
    return rules


def _fits(compound: tuple, tag: str, named: dict) -> bool:
    want, tests = compound
    if want and want != tag:
        return False
    for name, how, value in tests:
        have = named.get(name)
        if name not in named:
            return False
        have = have or ""
        ok = (not how or (how == "=" and have == value) or (how == "~=" and value in have.split())
              or (bool(value) and (how == "^=" and have.startswith(value) or how == "$=" and have.endswith(value)
                                   or how == "*=" and value in have)))
        if not ok:
            return False
    return True


class _Open(NamedTuple):
    """An open element: what it matched itself, and with its ancestors, of the selectors' steps."""
    tag: str
    own: frozenset
    above: frozenset
    removed: bool
    found: int | None


class _Reader(HTMLParser):
    """Collects text with the open elements known, so removed and selected parts can be told.

    What the open elements mean for a text is held in counters, so a text costs no walk over them.
    """

    def __init__(self, remove: list, keep: list):
        super().__init__(convert_charrefs=True)
        # (steps, is a removal) of every alternative.
        self.rules = [(r, True) for r in remove] + [(r, False) for r in keep]
        self.keep = bool(keep)
        self.open: list[_Open] = []
        self.depth: dict[str, int] = {}
        self.silent, self.removed, self.active = 0, 0, []
        self.kept: list[str] = []
        self.chunks: list[str] = []
        self.links, self.any_tag = 0, False
        self.found: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        self.any_tag = True
        if tag in VOID_TAGS:
            return
        named: dict = {}
        for k, v in attrs:
            named.setdefault(k, v)
        parent = self.open[-1] if self.open else None
        own, removed, selected = [], False, False
        for i, (steps, removal) in enumerate(self.rules):
            for k, (child, compound) in enumerate(steps):
                if k and (parent is None or (i, k - 1) not in (parent.own if child else parent.above)):
                    continue
                if _fits(compound, tag, named):
                    own.append((i, k))
                    if k == len(steps) - 1:
                        removed, selected = removed or removal, selected or not removal
        above = parent.above if parent else frozenset()
        own = frozenset(own)
        found = None
        if selected:
            found = len(self.found)
            self.found.append([])
            self.active.append(found)
        self.open.append(_Open(tag, own, above if own <= above else above | own, removed, found))
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.silent += tag in SILENT_TAGS
        self.removed += removed

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.depth.get(tag):
            return
        while True:
            last = self.open.pop()
            self.depth[last.tag] -= 1
            self.silent -= last.tag in SILENT_TAGS
            self.removed -= last.removed
            if last.found is not None:
                self.active.pop()
            if last.tag == tag:
                return

    def handle_data(self, data):
        if self.silent:
            return
        self.chunks.append(data)
        self.links += len(data) * self.depth.get("a", 0)
        if self.removed:
            return
        self.kept.append(data)
        for i in self.active:
            self.found[i].append(data)

    def result(self, decode: bool):
        if self.keep:
            text = "\n".join("".join(f) for f in self.found)
        else:
            text = "".join(self.kept)
        plain = len("".join(self.chunks).strip())
        return (unescape(text) if decode else text), plain, self.links, self.any_tag


def parse_markup(remove_selectors: list[str] | None = None,
                 content_selectors: list[str] | None = None, decode: bool = True):
    """Arrow UDF: markup -> text without the removed parts, plain length, link length, tag flag."""
    remove = [r for s in REMOVED_TAGS + list(remove_selectors or []) for r in selector_steps(s)]
    keep = [r for s in content_selectors or [] for r in selector_steps(s)]

    @F.pandas_udf(PARSED)
    def parse(bodies: pd.Series) -> pd.DataFrame:
        out = []
        for body in bodies:
            if body is None:
                out.append((None, None, None, None, False))
            elif "<" not in body and "&" not in body:
                text = "" if keep else body
                out.append((text, len(body.strip()), 0, False, False))
            else:
                reader = _Reader(remove, keep)
                try:
                    reader.feed(body)
                    reader.close()
                    out.append((*reader.result(decode), False))
                except (AssertionError, ValueError):
                    # The parser's own ways to refuse markup: a failure of this text alone.
                    out.append(("", 0, 0, False, True))
        return pd.DataFrame(out, columns=["text", "plain_length", "link_length", "has_tag", "failed"])
    return parse


# Texts of these characters only have blanks and line feeds for white space.
_ODD_CHARACTER = r"[^\n -~\x{a1}-\x{24f}\x{3001}-\x{fefe}]"


def _fold_blank_lines(c: Column) -> Column:
    return F.when(c.contains("\n\n\n"), F.regexp_replace(c, "\n{3,}", "\n\n")).otherwise(c)


def _tidy_any(c: Column, normalize: bool) -> Column:
    lines = F.regexp_replace(c, r"\r\n|[\r\n\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", "\n")
    if normalize:
        # A single blank inside a line already is what it should be and is skipped.
        inline = SPACE_CLASS.replace(r"\n", "")
        odd = inline.replace(" ", "")
        lines = F.regexp_replace(lines, f"[{odd}][{inline}]*| [{inline}]+", " ")
        lines = F.regexp_replace(lines, " ?\n ?", "\n")
    return lines


def _tidy_plain(c: Column, normalize: bool) -> Column:
    if not normalize:
        return c
    single = F.when(c.contains("  "), F.regexp_replace(c, " {2,}", " ")).otherwise(c)
    return F.replace(F.replace(single, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))


def tidy_lines(c: Column, normalize: bool = True, collapse: bool = True) -> Column:
    """Squeeze white space inside lines, fold runs of blank lines, trim the whole.

    One look at the characters sends the many texts without odd white space down a path of plain
    searches; the result is the same.
    """
    lines = F.when(c.rlike(_ODD_CHARACTER), _tidy_any(c, normalize)).otherwise(
        _tidy_plain(c, normalize))
    return strip(_fold_blank_lines(lines) if collapse else lines)


def body_candidate(fields: list[str], types: dict[str, str]) -> Column:
    """First non-empty body field by preference; array fields give their first non-empty value."""
    picks = []
    for f in fields:
        if types[f].startswith("array"):
            picks.append(F.get(F.filter(f, lambda v: v.isNotNull() & (v != "")), F.lit(0)))
        else:
            picks.append(F.when(strip(F.col(f)) != "", F.col(f)))
    return F.coalesce(*picks)


def boilerplate_hits(c: Column) -> Column:
    hits = [c.contains(p).cast("int") for p in V.BOILERPLATE_PHRASES]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def link_share(link_length: Column, plain_length: Column) -> Column:
    return F.try_divide(link_length.cast("double"), plain_length.cast("double"))


def low_context_reason(text: Column, low: Column, head: Column, truncated: Column,
                       links: Column) -> Column:
    """First matching reason, in a fixed order; NULL for usable text.

    ``low`` is the text and ``head`` the trimmed title, both in lower case.
    """
    # An empty title is part of any text; removing it changes nothing.
    rest = F.when(head == "", low).otherwise(F.replace(low, head, F.lit("")))
    heavy = low.contains(head) & (F.length(strip(rest)) < V.TITLE_REMAINDER_LIMIT)
    return (F.when(text == "", "post_cleanup_empty")
            .when(low == head, "title_only").when(heavy, "title_heavy")
            .when(links > V.LINK_TEXT_LIMIT, "mostly_links")
            .when(boilerplate_hits(low) >= V.BOILERPLATE_LIMIT, "template_heavy")
            .when(F.length(text) < V.MIN_TEXT_LENGTH, F.when(
                truncated, "truncated_to_low_context").otherwise("too_short")))


def _text_record(rows: DataFrame, title: str, method: str | Column) -> DataFrame:
    """Text record columns from ``_raw``, ``_p``, ``_full`` and the length limit ``_most`` (NULL: none)."""
    rows = rows.withColumn("_cut", F.coalesce(F.length("_full") > F.col("_most"), F.lit(False))).withColumn(
        "_text", F.when(F.col("_cut"), F.substring("_full", F.lit(1), F.col("_most"))).otherwise(F.col("_full")))
    # Its own column, because most rules look at the lower-case text.
    rows = rows.withColumn("_low", F.lower("_text")).withColumn(
        "_head", F.lower(strip(F.coalesce(F.col(title), F.lit("")))))
    missing = F.col("_raw").isNull()
    broken = F.coalesce(F.col("_p.failed"), F.lit(False))
    links = F.coalesce(link_share(F.col("_p.link_length"), F.col("_p.plain_length")), F.lit(0.0))
    reason = low_context_reason(F.col("_text"), F.col("_low"), F.col("_head"), F.col("_cut"),
                                links)
    rows = rows.withColumn("text_processing_reason",
                           F.when(missing, "missing_body").when(broken, "sanitizer_exception")
                           .otherwise(reason))
    return (rows.withColumn("sanitized_text", F.coalesce("_text", F.lit("")))
            .withColumn("sanitization_method", F.lit(method) if isinstance(method, str) else method)
            .withColumn("html_detected", ~missing & has_markup(F.col("_raw")))
            .withColumn("was_truncated", F.coalesce("_cut", F.lit(False)))
            .withColumn("text_processing_status",
                        F.when(missing | broken, "failed")
                        .when(F.col("text_processing_reason").isNotNull(), "low_context")
                        .otherwise("completed"))
            .withColumn("raw_text_length", F.coalesce(F.length("_raw"), F.lit(0)).cast("long"))
            .withColumn("sanitized_text_length", F.length("sanitized_text").cast("long"))
            .withColumn("reduction_ratio", F.when(missing, 0.0).otherwise(F.try_divide(
                F.length("_text").cast("double"), F.length("_raw").cast("double"))))
            .drop("_raw", "_p", "_full", "_most", "_cut", "_text", "_low", "_head"))


def sanitize(rows: DataFrame, body: str, title: str, max_length: int | None = None,
             remove_selectors: list[str] | None = None,
             content_selectors: list[str] | None = None, decode: bool = True,
             normalize: bool = True, collapse: bool = True, method: str = "default") -> DataFrame:
    """Add the text record columns to rows that hold a raw body and a title.

    A missing body is a failed text, and so is one that the parser gives up on; everything else is
    completed or low context with a reason. Labels are judged on the whole text unless
    ``max_length`` is given.
    """
    parse = parse_markup(remove_selectors, content_selectors, decode)
    rows = rows.withColumn("_raw", F.nullif(F.col(body), F.lit("")))
    # Only bodies that can hold markup travel to Python; plain ones stay where they are.
    coded = F.col("_raw").contains("<") | F.col("_raw").contains("&")
    rows = rows.withColumn("_p", parse(F.when(coded, F.col("_raw"))))
    plain = F.lit("") if content_selectors else F.col("_raw")
    rows = rows.withColumn("_full", tidy_lines(F.when(coded, F.col("_p.text")).otherwise(plain),
                                               normalize, collapse))
    return _text_record(rows.withColumn("_most", F.lit(max_length).cast("int")), title, method)


PROFILE = ("input_preference array<string>, remove_selectors array<string>, content_selectors array<string>, "
           "decode_entities boolean, normalize_whitespace boolean, collapse_blank_lines boolean, max_length int")


@F.pandas_udf(PARSED)
def parse_by_profile(bodies: pd.Series, removed: pd.Series, kept: pd.Series, decode: pd.Series) -> pd.DataFrame:
    """Like ``parse_markup`` with the selectors of each row; every distinct list is compiled once a batch.

    A selector of a row that cannot be read matches nothing, so one source's slip fails no other source.
    """
    compiled: dict = {}

    def read(selector: str) -> list:
        try:
            return selector_steps(selector)
        except ValueError:
            return []

    def steps(selectors) -> list:
        key = tuple(selectors) if selectors is not None else ()
        if key not in compiled:
            compiled[key] = [r for s in key for r in read(s)]
        return compiled[key]

    default = [r for s in REMOVED_TAGS for r in selector_steps(s)]
    out = []
    for body, remove, keep, unescaped in zip(bodies, removed, kept, decode):
        if body is None:
            out.append((None, None, None, None, False))
            continue
        reader = _Reader(default + steps(remove), steps(keep))
        reader.keep = keep is not None and len(keep) > 0
        try:
            reader.feed(body)
            reader.close()
            out.append((*reader.result(bool(unescaped)), False))
        except (AssertionError, ValueError):
            out.append(("", 0, 0, False, True))
    return pd.DataFrame(out, columns=["text", "plain_length", "link_length", "has_tag", "failed"])


def sanitize_by_profile(rows: DataFrame, profile: str, title: str, fields: list[str],
                        method: Column | None = None) -> DataFrame:
    """Text record columns where every row brings its own profile, a struct of ``PROFILE``.

    ``body`` is the first non-empty field of ``fields`` in the order of the profile's
    ``input_preference``; names that are no field are passed over. A row without profile gets the
    defaults: all fields in their order, no selectors, everything decoded, squeezed and whole.
    """
    own = lambda name: F.col(f"{profile}.{name}")
    held = F.create_map(*[x for f in fields for x in (F.lit(f), F.when(strip(F.col(f)) != "", F.col(f)))])
    wanted = F.coalesce(own("input_preference"), F.array(*map(F.lit, fields)))
    found = F.filter(F.transform(wanted, lambda f: F.try_element_at(held, f)), lambda v: v.isNotNull())
    rows = rows.withColumn("body", F.get(found, F.lit(0))).withColumn("_raw", F.col("body"))
    decode, keeps = F.coalesce(own("decode_entities"), F.lit(True)), F.coalesce(F.size(own("content_selectors")), F.lit(0)) > 0
    coded = F.col("_raw").contains("<") | F.col("_raw").contains("&")
    rows = rows.withColumn("_p", parse_by_profile(F.when(coded, F.col("_raw")), own("remove_selectors"),
                                                  own("content_selectors"), decode))
    read = F.when(coded, F.col("_p.text")).when(~keeps, F.col("_raw")).otherwise(F.when(F.col("_raw").isNotNull(), ""))
    rows = rows.withColumn("_read", read)
    squeeze, fold = (F.coalesce(own(c), F.lit(True)) for c in ("normalize_whitespace", "collapse_blank_lines"))
    tidied = F.when(squeeze & fold, tidy_lines(F.col("_read"))).when(squeeze, tidy_lines(F.col("_read"), True, False)).when(
        fold, tidy_lines(F.col("_read"), False, True)).otherwise(tidy_lines(F.col("_read"), False, False))
    rows = rows.withColumn("_full", tidied).withColumn("_most", own("max_length")).drop("_read")
    return _text_record(rows, title, method if method is not None else "default")
