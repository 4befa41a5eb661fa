"""Display text of rates, seconds, counts and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V


def percent(c: Column, digits: int = 2, missing: str = V.NO_DATA) -> Column:
    return F.when(c.isNull(), missing).otherwise(F.format_string(
        f"%.{digits}f%%", F.bround(c * 100, digits)))


def seconds(c: Column, digits: int = 2, missing: str = V.NO_DATA) -> Column:
    return F.when(c.isNull(), missing).otherwise(F.format_string(f"%.{digits}fs",
                                                               F.bround(c, digits)))


def number(c: Column, digits: int = 0, missing: str = V.NOT_AVAILABLE) -> Column:
    return F.coalesce(F.format_number(c, digits), F.lit(missing))


def duration(c: Column) -> Column:
    """Seconds below two minutes, then minutes, then hours."""
    return (F.when(c.isNull(), V.NOT_AVAILABLE)
            .when(c < 120, F.concat(F.format_number(c, 1), F.lit(" s")))
            .when(c < 7200, F.concat(F.format_number(c / 60, 1), F.lit(" min")))
            .otherwise(F.concat(F.format_number(c / 3600, 1), F.lit(" h"))))


def markdown_rows(rows: DataFrame, columns: list[str], text: list[str], out: str) -> DataFrame:
    """One Markdown table row per input row; pipes inside free text are escaped."""
    cells = [F.coalesce(F.replace(F.col(c), F.lit("|"), F.lit("\\|")) if c in text
                        else F.col(c).cast("string"), F.lit(V.NO_DATA)) for c in columns]
    return rows.withColumn(out, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))
