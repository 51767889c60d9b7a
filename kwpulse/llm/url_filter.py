"""URL filters: host-suffix and path-prefix rules joined on short hash prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.llm.common import lower_ascii

HEX_PREFIX = 8  # hex digits of the joined hash prefix (32 bits)
BROADCAST_RULES = 200_000  # more rules than this are joined by a shuffle
SALT = 16


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as (verdict, host, path) rows."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def url_parts(url):
    """(host, path) columns of a URL; both empty without ``://`` or for null."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    A rule (host, path) fits a URL if its host is the URL's host or a suffix of it that starts at a
    label, and its path is a prefix of the URL's path. Of the fitting rules the one with the longest
    host + path wins; at equal lengths the longer host, then ``block`` before ``allow``. No fitting
    rule: ``rule`` is null and the verdict is ``default``. Null URLs and URLs without ``://`` have
    empty parts and fit no rule. Rules with an empty or null host or a null path never fit. Repeated
    rows are judged each; other input columns are not read.

    Every URL is expanded only into as many host labels and path lengths as some rule has, so very
    long URLs make no more expressions than short ones. Expressions meet the rules in an equi-join on
    the first 32 bits of their SHA-256; the full digest then confirms. The rules are broadcast up to
    ``BROADCAST_RULES`` (counted first) and otherwise joined by a shuffle whose keys are salted, so a
    popular host does not meet its rule in one task.
    """
    digest = F.sha2(F.concat_ws("\x00", "host", "path"), 256)
    r = rules.where("host <> '' AND path IS NOT NULL").select(
        F.substring(digest, 1, HEX_PREFIX).alias("_key"), digest.alias("_digest"),
        F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                 F.col("verdict"), F.concat("host", "path").alias("rule")).alias("_rule"),
        (F.size(F.split("host", r"\.", -1))).alias("_labels"), F.length("path").alias("_len"))
    # of rules with equal host and path one decides: block, as the later word
    r = r.groupBy("_key", "_digest", "_labels", "_len").agg(F.max("_rule").alias("_rule"))
    shape = r.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("_labels")).alias("labels"),
                  F.sort_array(F.collect_set("_len")).alias("lens")).first()
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"),
                        host.alias("_host"), path.alias("_path"))
    out = [F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path")]
    if not shape["n"]:
        return rows.select(*out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    labels = F.array(*[F.lit(x) for x in shape["labels"]])
    lens = F.array(*[F.lit(x) for x in shape["lens"]])
    n_labels = F.length("_host") - F.length(F.replace(F.col("_host"), F.lit("."), F.lit(""))) + 1
    suffixes = F.transform(F.filter(labels, lambda n: n <= n_labels),
                           lambda n: F.call_function("substring_index", F.col("_host"), F.lit("."), -n))
    prefixes = F.transform(F.filter(lens, lambda n: n <= F.length("_path")),
                           lambda n: F.substr(F.col("_path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.sha2(F.concat_ws("\x00", h, p), 256))))
    x = rows.select("*", F.explode_outer(expressions).alias("_x")).withColumn(
        "_key", F.substring("_x", 1, HEX_PREFIX))
    r = r.select("_key", "_digest", "_rule")
    if shape["n"] <= BROADCAST_RULES:
        joined = x.join(F.broadcast(r), "_key", "left")
    else:
        x = x.withColumn("_salt", F.pmod(F.xxhash64("_row", "_key"), F.lit(SALT)))
        r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        joined = x.join(r, ["_key", "_salt"], "left")
    fits = F.when(F.col("_digest") == F.col("_x"), F.col("_rule"))
    best = joined.groupBy("_row").agg(F.first("_id").alias("_id"), F.first("_host").alias("_host"),
                                      F.first("_path").alias("_path"), F.max(fits).alias("_best"))
    return best.select(*out, F.col("_best.rule").alias("rule"),
                       F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
