"""URL filters on DataFrame functions only: expressions, short hash prefixes, full digests, precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Hex digits of the digest that rules and url expressions are joined on.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(rule_host, rule_path, action) with the rule's text, digest and short hash prefix.

    Of rules for the same host and path the first action by name holds, so `allow` comes before `block`.
    Rules with a null or empty host, a null path or a null action are ignored.
    """
    clean = rules.filter((F.length("rule_host") > 0) & F.col("rule_path").isNotNull() & F.col("action").isNotNull())
    one = clean.groupBy("rule_host", "rule_path").agg(F.min("action").alias("action"))
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    return one.select(
        F.concat("rule_host", "rule_path").alias("rule"),
        "action",
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
        (F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.length("rule_path").alias("path_length"),
    )


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row's url by the longest rule that fits its host (or a parent domain) and path prefix.

    Each distinct url is expanded into host suffixes and path prefixes of those shapes (number of
    labels, length of path) that some rule has, so the number of expressions a url gets is bounded by the
    rules' shapes, not by the url. Expressions meet rules on PREFIX_DIGITS hex digits of their SHA-256 and
    must then agree in the whole digest. Among rules that fit, the longest text wins; equal lengths cannot
    fit one url unless host and path part at different places, then the first by text wins.

    Null urls and urls without `://` get an empty host and path, no rule and the default verdict, as do
    urls that no rule fits. Repeated rows are each judged; an empty table or no rules give no matches.
    Returns (id_col, host, path, rule, verdict); other columns of `pages` are not used.
    """
    named = pages.select(F.col(id_col), F.col(url_col).alias("__url"))
    ready = prepare_rules(rules)
    shapes = [F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["path_length"]).alias("path_length"))
              for s in ready.select("labels", "path_length").distinct().orderBy("labels", "path_length").collect()]  # a row for each shape
    if not shapes:
        shapes = [F.struct(F.lit(-1).alias("labels"), F.lit(-1).alias("path_length"))]  # no rules: a shape that no rule has
    parts = named.select("__url").filter(F.col("__url").isNotNull()).distinct()
    parts = parts.select("__url", url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    shaped = parts.filter(F.length("host") > 0).withColumn("host_labels", F.split("host", r"\.", -1)).withColumn("shape", F.explode(F.array(*shapes)))
    fits = (F.col("shape.labels") <= F.size("host_labels")) & (F.col("shape.path_length") <= F.length("path"))
    suffix = F.expr("substring_index(host, '.', -shape.labels)")
    expressions = shaped.filter(fits).select(
        "__url", _digest(suffix, F.expr("substring(path, 1, shape.path_length)")).alias("digest")
    )
    met = expressions.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)).join(ready, "prefix")
    confirmed = met.filter(F.col("digest") == F.col("rule_digest"))
    order = F.struct((-F.length("rule")).alias("n"), "rule")
    best = confirmed.groupBy("__url").agg(F.min_by(F.struct("rule", "action"), order).alias("best"))
    judged = named.join(best, "__url", "left")
    return judged.select(
        id_col,
        F.coalesce(url_host(F.col("__url")), F.lit("")).alias("host"),
        F.coalesce(url_path(F.col("__url")), F.lit("")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
