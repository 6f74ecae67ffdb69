"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for the rest.

A rule (host, path) fits its host and all subdomains of it when the path of the url starts with the rule's; the longest
fitting rule wins. Urls that a rule decides are the labelled ones: trees learn from at most ``train_rows`` of them (by a
hash of the url) what blocked urls look like, and judge the urls that no rule fits.

Features: length of url, host and path, depth of the path, labels of the host, shares of digits and of signs, entropy
of the characters, parameters, extension and fragment, and for the last and the last two labels of the host their
smoothed share of blocked urls. That share is taken from the other half of the labelled urls, so no url sees its own
label; unlabelled urls use the mean of both halves.

NULL urls and urls without ``://`` have empty host and path; no rule fits them and the trees judge them like any other.
Without labels of both kinds the remaining urls get the only kind there is, or "allow". Repeated rows are
judged each time. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, hot_join, result, table


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PLAIN = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "signs", "entropy", "parameters", "extension", "fragment")
SUFFIXES = ("last_one", "last_two")


def parts(url: Column) -> tuple[Column, Column]:
    """Lower-cased (A-Z) host and path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(url, _PARTS, 1), upper, lower), F.regexp_extract(url, _PARTS, 2)


def _fitting(rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or NULL."""
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host, r.path)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        choice = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(choice)
    return choice


def _features(urls: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    length = F.length(url)
    share = {n: F.when(length > 0, F.length(F.regexp_replace(url, keep, "")) / length).otherwise(0.0)
             for n, keep in (("digits", "[^0-9]"), ("signs", "[0-9A-Za-z]"))}
    chars = F.split(url, "")
    bits = F.expr("""
      aggregate(array_distinct(chars), 0d, (s, c) -> s - size(filter(chars, x -> x = c)) / double(size(chars))
                * log2(size(filter(chars, x -> x = c)) / double(size(chars))))""")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    rows = urls.withColumn("chars", chars).withColumn("entropy", F.when(length > 0, bits).otherwise(0.0)).drop("chars")
    labels = F.split("host", r"\.")
    return rows.withColumns({
        "url_length": length.cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")).cast("double"), "labels": F.size(labels).cast("double"),
        **share, "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"), "fragment": url.contains("#").cast("double"),
        "last_one": F.element_at(labels, -1), "last_two": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "half": F.abs(F.xxhash64(url, F.lit(1))) % 2,
    })


def _with_suffix(rows: DataFrame, stats: DataFrame, suffix: str, share: float, total: int) -> DataFrame:
    """Add the smoothed share of blocked urls of a suffix: from the other half for labelled rows, else of both halves."""
    joined = hot_join(rows, stats, suffix, "n", total, "left")

    def smooth(bad: Column, n: Column) -> Column:
        return (F.coalesce(bad, F.lit(0)) + 10 * share) / (F.coalesce(n, F.lit(0)) + 10)

    halves = [smooth(F.col(f"bad{h}"), F.col(f"n{h}")) for h in (0, 1)]
    value = F.when(F.col("verdict").isNull(), (halves[0] + halves[1]) / 2).when(F.col("half") == 0, halves[1]).otherwise(halves[0])
    return joined.withColumn(f"{suffix}_share", value).drop("n", "bad0", "bad1", "n0", "n1")


def judged(pages: DataFrame, scratch: Scratch, rules: Sequence[Rule] = RULES, train_rows: int = 50_000, trees: int = 12,
           depth: int = 4) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    ``score`` is the probability of "block" by the trees, for urls without a rule.
    """
    # Imported here, as these load pandas, which no other operator needs on the driver.
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    host, path = parts(F.col("url"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns(
        {"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    ruled = urls.withColumn("fit", _fitting(rules)).select("*", "fit.rule", "fit.verdict").drop("fit")
    rows = scratch.keep(_features(ruled).drop("url"), "features")
    total, block, allow = rows.agg(
        F.count(F.lit(1)), F.count_if(F.col("verdict") == "block"), F.count_if(F.col("verdict") == "allow")).first()
    out = ["page_id", "host", "path", "rule"]
    if not block or not allow:
        only = "block" if block else "allow"
        return rows.select(*out, F.coalesce("verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    share = block / (block + allow)
    bad = (F.col("verdict") == "block").cast("int")
    for s in SUFFIXES:
        labelled = F.col("verdict").isNotNull()
        stats = rows.groupBy(s).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.when(labelled & (F.col("half") == h), bad)).alias(f"bad{h}") for h in (0, 1)],
            *[F.count_if(labelled & (F.col("half") == h)).alias(f"n{h}") for h in (0, 1)])
        rows = _with_suffix(rows, scratch.keep(stats, s), s, share, total)
    vectors = VectorAssembler(inputCols=[*PLAIN, *(f"{s}_share" for s in SUFFIXES)], outputCol="features")
    rows = scratch.keep(rows.select(*out, "verdict", *vectors.getInputCols()), "rows")
    sample = rows.filter("verdict is not null").orderBy(F.xxhash64("host", "path"), "page_id").limit(train_rows)
    train = scratch.keep(sample.withColumn("label", (F.col("verdict") == "block").cast("double")).select("label", *vectors.getInputCols()), "train")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=1, maxBins=32, checkpointInterval=-1).fit(vectors.transform(train))
    scored = model.transform(vectors.transform(rows)).withColumn("score", F.when(F.col("rule").isNull(), vector_to_array("probability")[1]))
    return scored.select(*out, F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")


def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    with Scratch(spark, "urls") as scratch:
        return result(judged(table(spark, sf_dir, "pages").select("page_id", "url"), scratch), "op5")
