"""URL filter: host and path rules, and gradient-boosted trees for the URLs no rule fits.

A rule is a host and a path; it fits that host and its subdomains where the URL's path starts
with the rule's, and the longest rule that fits decides. The trees learn from the URLs that
rules label (at most ``FIT_ROWS`` of them, by hash) and judge the others by lexical features:
lengths, depth, share of digits, entropy, parameters, and how common the host's suffixes are
among all URLs.

Defined results: a null URL or one without ``://`` has an empty host and path, which no rule
fits; where rules label one class only, that class is the verdict of all other URLs, and
``allow`` where they label none; equal URLs get equal verdicts; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import small
from tillwatch.llm.decontamination import ascii_lower
from tillwatch.session import written

# The contract's rules: host and path, verdict.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", url.alias("url"), ascii_lower(F.regexp_extract(url, _URL, 1)).alias("host"),
        F.regexp_extract(url, _URL, 2).alias("path"))


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct(rule, verdict), else null. ``block`` wins ties."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def add(total: Column, letter: Column) -> Column:
        share = F.size(F.split(text, F.concat(F.lit("\\Q"), letter, F.lit("\\E")))) - 1
        return total - share / n * F.log2(share / n)

    letters = F.array_remove(F.array_distinct(F.split(text, "")), "")
    return F.aggregate(letters, F.lit(0.0), add)


def _count(text: Column, letters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{letters}]", "")).cast("double")


def lexical(split: DataFrame) -> dict[str, Column]:
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = F.length(url).cast("double")
    return {
        "length": length,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(F.regexp_replace(path, "/$", ""), "/"),
        "labels": _count(host, ".") + 1,
        "hyphens": _count(host, "-"),
        "digit_ratio": _count(url, "0-9") / F.greatest(length, F.lit(1.0)),
        "host_digits": _count(host, "0-9"),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
    }


def _suffix(labels: int) -> Column:
    return F.substring_index("host", ".", -labels)


def with_features(split: DataFrame) -> tuple[DataFrame, list[str]]:
    """``split`` with its feature columns. The suffix tables are joined by size."""
    columns = lexical(split)
    out = split.withColumns(columns)
    for labels in (1, 2):
        key, share = f"suffix_{labels}", f"suffix_share_{labels}"
        counted = written(split.groupBy(_suffix(labels).alias(key)).agg(
            F.log1p(F.count(F.lit(1)).cast("double")).alias(share)), key)
        out = out.withColumn(key, _suffix(labels)).join(small(counted), key, "left").drop(key)
        columns[share] = F.col(share)
    return out, list(columns)


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block (null where a rule decided)."""
    split = parts(pages).withColumn("by_rule", rule_of(rules, F.col("host"), F.col("path")))
    featured, names = with_features(split)
    rows = written(featured.select(
        "page_id", "url", "host", "path", F.col("by_rule.rule").alias("rule"),
        F.col("by_rule.verdict").alias("ruled"), *names), "urls")
    labelled = rows.filter("ruled is not null")
    classes = [r["ruled"] for r in labelled.select("ruled").distinct().collect()]
    if len(classes) < 2:
        verdict, p = F.lit(classes[0] if classes else "allow"), F.lit(None).cast("double")
        return rows.select("page_id", "host", "path", "rule",
                           F.coalesce("ruled", verdict).alias("verdict"), p.alias("p_block"))
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    sample = assembler.transform(
        labelled.orderBy(F.xxhash64("url"), "page_id").limit(FIT_ROWS)
    ).select("features", (F.col("ruled") == "block").cast("double").alias("label"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(sample)
    scored = model.transform(assembler.transform(rows)).withColumn(
        "p", vector_to_array("probability")[1])
    open_ = F.col("ruled").isNull()
    return scored.select(
        "page_id", "host", "path", "rule",
        F.when(~open_, F.col("ruled")).when(F.col("p") >= 0.5, "block").otherwise("allow").alias("verdict"),
        F.when(open_, F.col("p")).alias("p_block"))
