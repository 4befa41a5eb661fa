"""URL filter: allow and block rules first, gradient-boosted trees on lexical features for the rest.

Only DataFrame operations and Spark's own trees are used; no Python runs on executors. The rules give
the labels: every URL that a rule judges is a labelled URL, and the trees learn from them what the
judged URLs look like. Features are length, depth, digit ratio, entropy, counts of parameters and
marks, and statistics of the host's suffix over the whole table.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from pressline.llm.storage import stored

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
SAMPLE_ROWS = 100_000
"""The trees are fitted on at most this many labelled URLs, chosen by a hash."""
TREES, DEPTH = 20, 4

FEATURES = ["url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
            "path_digit_ratio", "entropy", "parameters", "hyphens", "is_https", "suffix_count",
            "suffix_block_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of an absolute URL; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host or a domain above it, and the start of the path."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = (host == domain) | host.endswith("." + domain)
        out = F.when(fits & path.startswith(slash + start), F.lit(rule)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.greatest(F.length(text), F.lit(1))
    kinds = F.array_distinct(F.split(text, ""))
    share = F.transform(kinds, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule and the suffix of the host (its last two labels)."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    return rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "suffix", F.substring_index("host", ".", -2))


def features(rows: DataFrame, rules=RULES) -> DataFrame:
    """``rows`` of :func:`parsed` with the feature columns and ``label`` (1 block, 0 allow, or null).

    A labelled URL's own label is left out of its suffix's block rate.
    """
    label = F.lit(None).cast("double")
    for rule, verdict in rules:
        label = F.when(F.col("rule") == rule, F.lit(float(verdict == "block"))).otherwise(label)
    rows = rows.withColumn("label", label)
    suffix = rows.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("_n"), F.count("label").alias("_judged"),
        F.coalesce(F.sum("label"), F.lit(0.0)).alias("_blocked"))
    rows = rows.join(suffix, "suffix")
    own = F.when(F.col("label").isNull(), 0).otherwise(1)
    rate = (F.col("_blocked") - F.coalesce("label", F.lit(0.0)) + 0.5) / (F.col("_judged") - own + 1)
    length = F.greatest(F.length("url"), F.lit(1))
    columns = {
        "url_length": F.length("url"), "host_length": F.length("host"),
        "path_length": F.length("path"), "host_depth": _count(F.col("host"), r"\."),
        "path_depth": _count(F.col("path"), "/"), "digit_ratio": _count(F.col("url"), "[0-9]") / length,
        "path_digit_ratio": _count(F.col("path"), "[0-9]") / F.greatest(F.length("path"), F.lit(1)),
        "entropy": entropy(F.col("url")), "parameters": _count(F.col("url"), "[&?]"),
        "hyphens": _count(F.col("url"), "[-_]"), "is_https": F.col("url").startswith("https:").cast("int"),
        "suffix_count": F.log1p(F.col("_n").cast("double")), "suffix_block_rate": rate}
    return rows.withColumns({k: v.cast("double") for k, v in columns.items()}).drop(
        "_n", "_judged", "_blocked")


def filtered(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages``.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by the
    trees like any other. Rows that repeat are judged alike. If the rules judge no URL, or all alike,
    nothing can be learned, and the rest gets the verdict that was seen, or ``allow``.
    """
    rows = stored(features(parsed(pages, rules), rules))
    named = dict(rules)
    seen = {r["label"]: r["n"] for r in rows.where("label IS NOT NULL").groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) == 2:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="_x", handleInvalid="keep")
        some = (rows.where("label IS NOT NULL").orderBy(F.xxhash64("url", "page_id")).limit(SAMPLE_ROWS))
        trees = GBTClassifier(featuresCol="_x", labelCol="label", predictionCol="_p", maxIter=TREES,
                              maxDepth=DEPTH, seed=7).setProbabilityCol("_q").setRawPredictionCol("_raw")
        model = trees.fit(assemble.transform(some.select("label", *FEATURES)))
        from pyspark.ml.functions import vector_to_array
        rows = model.transform(assemble.transform(rows)).withColumn(
            "score", vector_to_array("_q")[1])
    else:
        rows = rows.withColumn("score", F.lit(max(seen, default=0.0)))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in named.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_trees = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce(by_rule, by_trees).alias("verdict"), "score")
