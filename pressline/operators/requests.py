"""Model request rows: prompt text and JSON request body, one row per unit of work.

The result is an input table for batch inference; no request is sent from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class RequestSettings:
    """What is fixed for a whole batch of requests."""

    model: str
    system: str
    template: str
    temperature: float = 1.0
    max_tokens: int = 1024
    top_p: float | None = None
    schema_name: str | None = None
    schema_json: str | None = None


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with ``{name}`` slots filled; doubled braces stand for single ones.

    The text is cut at the slots first, so slot-like text inside a value is left alone.
    """
    import string
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def request_body(prompt: Column, s: RequestSettings) -> Column:
    """JSON request text. ``top_p`` appears only when set; a schema switches the response mode."""
    message = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(s.system).alias("content")),
        F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    fields = [F.lit(s.model).alias("model"), message.alias("messages"),
              F.lit(s.temperature).alias("temperature"), F.lit(s.max_tokens).alias("max_tokens")]
    if s.top_p is not None:
        fields.append(F.lit(s.top_p).alias("top_p"))
    if s.schema_json is None:
        fields.append(F.struct(F.lit("json_object").alias("type")).alias("response_format"))
        return F.to_json(F.struct(*fields))
    # The schema is constant JSON, so it is spliced in as text.
    wrapped = ('{"type":"json_schema","json_schema":{"name":"' + s.schema_name
               + '","strict":true,"schema":' + s.schema_json + "}}")
    head = F.to_json(F.struct(*fields))
    return F.concat(F.regexp_replace(head, "\\}$", ""), F.lit(',"response_format":' + wrapped + "}"))


def _requests(rows: DataFrame, keys: list[str], prompt: Column, s: RequestSettings) -> DataFrame:
    return rows.select(*keys, prompt.alias("prompt")).withColumn(
        "request", request_body(F.col("prompt"), s))


def classification_requests(pending: DataFrame, s: RequestSettings) -> DataFrame:
    prompt = fill(s.template, {"title": F.col("title"), "sanitized_text": F.col("sanitized_text")})
    return _requests(pending, ["source_item_id"], prompt, s)


def curation_requests(pending: DataFrame, s: RequestSettings) -> DataFrame:
    gov = F.coalesce(F.col("governmental_involvement").cast("string"), F.lit("0"))
    prompt = fill(s.template, {
        "raw_title": F.col("raw_title"), "sanitized_text": F.col("sanitized_text"),
        "topic_class": F.col("topic_class"), "governmental_involvement": gov})
    return _requests(pending, ["source_item_id"], prompt, s)


def translation_requests(tasks: DataFrame, labels: DataFrame, s: RequestSettings) -> DataFrame:
    """Requests for the tasks; an absent bullet is written as the word null."""
    rows = tasks.join(labels.select("language_code", "label"), "language_code", "left")
    target = F.concat(F.coalesce("label", "language_code"), F.lit(" ("), F.col("language_code"),
                      F.lit(")"))
    values = {"target_language": target, "display_title": F.col("display_title"),
              "summary_short": F.col("summary_short")}
    for b in ("bullet_1", "bullet_2", "bullet_3"):
        values[b] = F.coalesce(F.col(b), F.lit("null"))
    return _requests(rows, ["parent_content_id", "language_code"], fill(s.template, values), s)
