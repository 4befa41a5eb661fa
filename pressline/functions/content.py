"""Content fingerprints, canonical JSON, labels, scripts, reading time and fenced JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from pressline import fixed_values as V
from pressline.functions.titles import strip

FIVE = ["display_title", "summary_short", "bullet_1", "bullet_2", "bullet_3"]


def unix_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def canonical_json(*columns: Column) -> Column:
    """JSON text with the given key order and NULLs kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_fingerprint(columns: list[str] = FIVE) -> Column:
    """Digest of the five content fields; NULL and empty text differ, line endings do not."""
    fields = [unix_lines(F.col(c)).alias(n) for c, n in zip(columns, FIVE)]
    return F.sha2(canonical_json(*fields), 256)


_LABELS = "|".join(V.UI_LABELS)
_LABELS_LONGEST = "|".join(re.escape(x) for x in sorted(V.UI_LABELS, key=len, reverse=True))


def has_label_prefix(c: Column) -> Column:
    """The value starts with a presentation label, list or emphasis marks aside."""
    return F.coalesce(c.rlike(V.LABEL_PREFIX.format(labels=_LABELS)), F.lit(False))


def has_guarded_label(c: Column) -> Column:
    """The stricter guard for translated fields: one list mark and one emphasis mark at most."""
    return F.coalesce(c.rlike(V.LABEL_GUARD.format(labels=_LABELS_LONGEST)), F.lit(False))


def has_ideograph(c: Column) -> Column:
    return F.coalesce(c.rlike("[\\x{4e00}-\\x{9fff}]"), F.lit(False))


def has_kana(c: Column) -> Column:
    return F.coalesce(c.rlike("[\\x{3040}-\\x{30ff}]"), F.lit(False))


def script_ok(language: Column, text: Column) -> Column:
    """Chinese text needs an ideograph, Japanese text a kana, other languages nothing."""
    return F.when(language == "zh", has_ideograph(text)).when(
        language == "ja", has_kana(text)).otherwise(F.lit(True))


def total_length(first: Column, *others: Column) -> Column:
    total = F.length(first)
    for o in others:
        total = total + F.coalesce(F.length(o), F.lit(0))
    return total


def length_ratio(translated: list[Column], source: list[Column]) -> Column:
    """Translated over source characters; NULL when the source is empty."""
    return F.try_divide(total_length(*translated).cast("double"),
                        total_length(*source).cast("double"))


_CJK = "[\\x{3040}-\\x{30ff}\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}\\x{ff66}-\\x{ff9f}]"


def reading_minutes(c: Column) -> Column:
    """Minutes to read mixed text, at least one."""
    clean = F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""),
                             "[#*`_\\[\\]()\\-!?,.;:\"']", " ")
    cjk = F.regexp_count(clean, F.lit(_CJK))
    latin = F.regexp_replace(clean, _CJK, " ")
    words = F.regexp_count(latin, F.lit(r"(?U)[^\s\x{feff}]+"))
    minutes = F.ceil(cjk / F.lit(float(V.CJK_CHARS_PER_MINUTE))
                     + words / F.lit(float(V.LATIN_WORDS_PER_MINUTE)))
    return F.coalesce(F.greatest(minutes, F.lit(1)), F.lit(1)).cast("long")


def unfenced(c: Column) -> Column:
    """Text without a surrounding code fence."""
    text = strip(c)
    inner = F.when(text.contains("\n"), F.regexp_replace(text, "^[^\n]*\n", "")).otherwise(
        F.regexp_replace(text, "^```", ""))
    inner = strip(F.regexp_replace(strip(inner), "```$", ""))
    return F.when(text.startswith("```"), inner).otherwise(text)


def disclosure_note(writer_type: Column) -> Column:
    return F.when(writer_type.isin(V.WRITER_TYPES_EDITED), V.NOTE_EDITED).otherwise(
        V.NOTE_GENERATED)
