"""Windows, ratios and the shared cohort predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressline import fixed_values as V


def at(moment: str | Column) -> Column:
    """A literal moment (``yyyy-MM-dd HH:mm:ss`` text, UTC) or a column passed through."""
    return moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp")


def in_window(column: str | Column, start: str | Column, end: str | Column) -> Column:
    """Half-open membership; the comparison stays on the bare column so it reaches the scan."""
    c = F.col(column) if isinstance(column, str) else column
    return (c >= at(start)) & (c < at(end))


def lookback(now: str | Column, days: int) -> tuple[Column, Column]:
    """``[now - days, now)`` at whole seconds; the clock is always an argument."""
    end = F.date_trunc("second", at(now))
    return end - F.make_interval(days=F.lit(days)), end


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that is NULL on an empty denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def tally(condition: Column) -> Column:
    """Conditional count: 0 on empty input, NULL conditions do not count."""
    return F.count_if(condition)


def share(condition: Column, population: str | Column) -> Column:
    """Share of rows that meet a condition among the rows where ``population`` is present."""
    return ratio(tally(condition), F.count(population))


def classifiable() -> Column:
    """Text that may be classified; an absent text record is not classifiable."""
    reason = F.col("text_processing_reason")
    return (F.col("text_processing_status") != "failed") & (
        reason.isNull() | (reason != "post_cleanup_empty"))


def relevant(column: str = "topic_class") -> Column:
    return F.col(column).isin(V.RELEVANT_TOPICS)


def current_version() -> Column:
    """The translated or published text belongs to the present master text."""
    return F.col("source_fingerprint") == F.col("content_fingerprint")


def not_bypass() -> Column:
    return F.col("model_name") != "bypass"


def low_context_classified() -> Column:
    """Low-context text that was still classified (the classification side is joined inner)."""
    return (F.col("text_processing_status") == "low_context") & classifiable() \
        & F.col("topic_class").isNotNull()


def seconds_between(later: str, earlier: str) -> Column:
    return F.unix_seconds(F.col(later)) - F.unix_seconds(F.col(earlier))


def iso(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, V.ISO_FORMAT)
