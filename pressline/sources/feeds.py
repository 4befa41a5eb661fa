"""Stored feed payloads to items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline.functions import titles as N
from pressline.functions.times import published_at

# --- fixed values: elements of the two feed dialects ---------------------------------------------
# Names keep a prefix by namespace: media:title or itunes:summary never stand for the item's own fields.
_RSS_ITEM = ("struct<title: string, link: array<struct<_VALUE: string, _href: string>>, "
             "guid: struct<_VALUE: string, _isPermaLink: string>, pubDate: string, `dc:date`: string, "
             "description: string, `content:encoded`: string, "
             "enclosure: array<struct<_url: string>>>")
# Text constructs are read as strings, so XHTML comes as its markup.
_ATOM_ENTRY = ("struct<title: string, id: string, "
               "link: array<struct<_rel: string, _href: string>>, published: string, "
               "updated: string, summary: string, content: array<string>>")
FEED_SCHEMA = (f"channel struct<item: array<{_RSS_ITEM}>>, item array<{_RSS_ITEM}>, "
               f"entry array<{_ATOM_ENTRY}>, _broken string")
# Namespaces whose elements are read, with the prefix that the schema uses for them.
NAMESPACES = {"http://purl.org/rss/1.0/modules/content/": "content", "http://purl.org/dc/elements/1.1/": "dc",
              "http://purl.org/dc/terms/": "dc"}
ATOM = "http://www.w3.org/2005/Atom"
_DECLARED = r"""xmlns:([A-Za-z_][\w.-]*)\s*=\s*["']([^"']*)["']"""
_ROOT = r"^\s*(?:<!--.*?-->\s*|<[?!][^>]*>\s*)*<([A-Za-z_][\w.-]*):feed[\s>]"
_XHTML_DIV = r"(?s)^\s*<div\b[^>]*http://www\.w3\.org/1999/xhtml[^>]*>(.*)</div>\s*$"


def _renamed(raw: Column) -> Column:
    """The payload with the prefixes of the schema, whatever prefixes it declares for their namespaces.

    A declared prefix of a read namespace becomes the schema's one; a prefix that the schema uses but
    that stands for another namespace becomes a foreign one; the prefix of an Atom root goes. Tags
    alone are renamed: CDATA sections, comments and text stay as they are.
    """
    declared = F.arrays_zip(F.regexp_extract_all(raw, F.lit(_DECLARED), F.lit(1)).alias("p"),
                            F.regexp_extract_all(raw, F.lit(_DECLARED), F.lit(2)).alias("u"))
    known = F.create_map(*[F.lit(x) for pair in NAMESPACES.items() for x in pair])
    root = F.regexp_extract(raw, _ROOT, 1)
    used = F.array(*[F.lit(x) for x in sorted(set(NAMESPACES.values()))])
    goals = F.filter(F.transform(declared, lambda d: F.struct(d["p"].alias("p"), F.when(
        (d["u"] == ATOM) & (d["p"] == root), "").when(
        F.try_element_at(known, d["u"]).isNotNull(), F.concat(F.try_element_at(known, d["u"]), F.lit(":"))).when(
        F.array_contains(used, d["p"]), F.concat(F.lit("foreign-"), d["p"], F.lit(":"))).alias("to"))),
        lambda g: g["to"].isNotNull() & (g["to"] != F.concat(g["p"], F.lit(":"))))
    # New names are marked until all old ones are gone, so that no name is renamed twice.
    def tags(text: Column) -> Column:
        return F.replace(F.aggregate(goals, text, lambda t, g: F.regexp_replace(
            t, F.concat(F.lit("(</?)\\Q"), g["p"], F.lit("\\E:")), F.concat(F.lit("$1"), F.lit("\u0001"), g["to"]))),
            F.lit("\u0001"), F.lit(""))
    parts = F.split(raw, r"(?=<!\[CDATA\[)|(?<=\]\]>)|(?=<!--)|(?<=-->)")
    inert = lambda x: x.startswith("<![CDATA[") | x.startswith("<!--")
    whole = F.array_join(F.transform(parts, lambda x: F.when(inert(x), x).otherwise(tags(x))), "")
    return F.when(F.size(goals) > 0, whole).otherwise(raw)


def parse_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payload rows with their parsed feed; ``broken`` marks payloads that are no valid XML.

    Elements are told by the namespace their prefix is declared for, not by the prefix.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = F.from_xml(_renamed(F.col(column)), FEED_SCHEMA, options)
    return payloads.withColumn("_feed", parsed).withColumn(
        "broken", F.col("_feed").isNull() | F.col("_feed._broken").isNotNull())


def parse_failures(parsed: DataFrame) -> DataFrame:
    """Source-level failures; a valid payload without entries is none."""
    return parsed.filter("broken").drop("_feed", "broken").withColumn(
        "error_class", F.lit("parse_error"))


def _text(c: Column) -> Column:
    return F.nullif(N.strip(c), F.lit(""))


def _markup(c: Column) -> Column:
    """An Atom text; the wrapper that XHTML needs is not part of it."""
    return _text(F.regexp_replace(c, _XHTML_DIV, "$1"))


def _rss(item: Column) -> Column:
    link = F.get(F.filter(item["link"], lambda x: _text(x["_VALUE"]).isNotNull()), F.lit(0))
    permalink = F.coalesce(F.lower(item["guid"]["_isPermaLink"]) != "false", F.lit(True))
    return F.struct(
        item["title"].alias("raw_title"), _text(item["guid"]["_VALUE"]).alias("guid"),
        F.coalesce(_text(link["_VALUE"]), F.when(permalink, _text(item["guid"]["_VALUE"])),
                   _text(F.get(item["enclosure"], F.lit(0))["_url"])).alias("link"),
        _text(item["description"]).alias("description"), _text(item["content:encoded"]).alias("content"),
        F.coalesce(_text(item["pubDate"]), _text(item["dc:date"])).alias("raw_date"))


def _atom(entry: Column) -> Column:
    def href(rel: Column) -> Column:
        return F.get(F.filter(entry["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate"))
                              == rel), F.lit(0))["_href"]
    return F.struct(
        F.regexp_replace(entry["title"], _XHTML_DIV, "$1").alias("raw_title"), _text(entry["id"]).alias("guid"),
        F.coalesce(_text(href(F.lit("alternate"))), _text(href(F.lit("enclosure")))).alias("link"),
        _markup(entry["summary"]).alias("description"),
        _markup(F.get(entry["content"], F.lit(0))).alias("content"),
        F.coalesce(_text(entry["published"]), _text(entry["updated"])).alias("raw_date"))


def feed_entries(parsed: DataFrame) -> DataFrame:
    """One row per entry of the valid payloads, with its position inside the payload."""
    empty = F.array().cast("array<struct<raw_title:string,guid:string,link:string,"
                           "description:string,content:string,raw_date:string>>")
    every = F.concat(F.coalesce(F.transform("_feed.channel.item", _rss), empty),
                     F.coalesce(F.transform("_feed.item", _rss), empty),
                     F.coalesce(F.transform("_feed.entry", _atom), empty))
    kept = [c for c in parsed.columns if c not in ("_feed", "broken", "payload")]
    # No filter on ``broken``: it would be pushed below the parser and parse every payload twice.
    valid = F.when(~F.col("broken"), every)
    return (parsed.select(*kept, F.posexplode(valid).alias("position", "_e"))
            .select(*kept, "position", "_e.*"))


def normalise(entries: DataFrame) -> DataFrame:
    """Entries with display title, canonical URL, UTC date and body fields."""
    return (entries.withColumn("title", N.display_title(F.col("raw_title")))
            .withColumn("canonical_url", N.canonical_url(F.col("link")))
            .withColumn("summary", F.coalesce("description", "content"))
            .withColumn("published_at", published_at(F.col("raw_date"))))
