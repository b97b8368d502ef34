"""URL filtering: rules first, gradient-boosted trees for what no rule fits.

The trees are trained on URLs that rules have labelled, by lexical features: lengths,
depth, digits, entropy, parameters, and statistics of host and path suffixes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.store import saved

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs learned from, about, and the size of the model.
TRAIN_ROWS, TREES, DEPTH = 20_000, 10, 4
#: Suffixes are hashed into so many buckets, so their table has a bound.
BUCKETS = 1024
#: Suffixes with statistics: the last two labels of the host, the ending of the path, and the
#: path's first step, which is where its host leaves off.
SUFFIXES = ("host", "path", "step")
#: Rows learned from get the statistics of the other folds.
FOLDS = 5

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "longest_number",
    "hyphens", "entropy", "parameters", "has_query", "has_fragment", "secure",
    "host_suffix_share", "host_suffix_blocked", "path_suffix_share", "path_suffix_blocked",
    "step_suffix_share", "step_suffix_blocked",
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty without `://` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit("")))


def fitting(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule whose host is the URL's or a parent of it and
    whose path begins the URL's; null if none fits. Of equally long ones the first by name."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(sorted(rules, key=lambda r: r.name, reverse=True), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    letters, n = F.split(text, ""), F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    terms = F.transform(F.array_distinct(letters), lambda c: F.when(c == "", 0.0).otherwise(-share(c) * F.log2(share(c))))
    return F.when(n > 0, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def _bucket(kind: str, suffix: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(kind), suffix), F.lit(BUCKETS)).cast("int")


def lexical(urls: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """`urls` with the features that need the URL only, and buckets of its suffixes."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    h, p = F.col(host), F.col(path)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern))
    numbers = F.transform(F.regexp_extract_all(u, F.lit(r"[0-9]+"), F.lit(0)), F.length)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    new = {
        "url_length": F.length(u),
        "host_length": F.length(h),
        "path_length": F.length(p),
        "depth": count(p, "/"),
        "labels": count(h, r"\."),
        "digit_ratio": F.when(F.length(u) > 0, count(u, "[0-9]") / F.length(u)).otherwise(0.0),
        "longest_number": F.coalesce(F.array_max(numbers), F.lit(0)),
        "hyphens": count(u, "-"),
        "entropy": _entropy(u),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "has_query": F.contains(u, F.lit("?")).cast("int"),
        "has_fragment": F.contains(u, F.lit("#")).cast("int"),
        "secure": F.startswith(u, F.lit("https:")).cast("int"),
    }
    buckets = {
        "host_bucket": _bucket("host", F.regexp_extract(h, r"[^.]*(\.[^.]*)?$", 0)),
        "path_bucket": _bucket("path", F.regexp_extract(p, r"\.([A-Za-z0-9]{1,8})$", 1)),
        "step_bucket": _bucket("step", F.regexp_extract(p, r"^/([^/]*)", 1)),
    }
    return urls.withColumns({name: c.cast("double") for name, c in new.items()} | buckets)


@dataclass
class Model:
    """Trees and suffix statistics; without trees, one verdict for all."""

    suffixes: DataFrame | None
    trees: PipelineModel | None
    default: str


def _with_suffixes(rows: DataFrame, suffixes: DataFrame, fold: str | None = None) -> DataFrame:
    """Joins the statistics of each suffix, at most BUCKETS rows a kind (and fold), so they are
    broadcast. Rows to learn from have a `fold`, and get what the other folds say; else the
    trees would trust suffixes for what they say of the very URL."""
    for kind in SUFFIXES:
        table = suffixes.where(F.col("kind") == kind).select(
            F.col("bucket").alias(f"{kind}_bucket"),
            *([] if fold is None else [F.col("fold").alias(fold)]),
            (F.col("n") / F.col("total")).alias(f"{kind}_suffix_share"),
            ((F.col("blocks") + 1) / (F.col("n") + 2)).alias(f"{kind}_suffix_blocked"),
        )
        keys = [f"{kind}_bucket"] + ([] if fold is None else [fold])
        rows = rows.join(F.broadcast(table), keys, "left").fillna({f"{kind}_suffix_share": 0.0, f"{kind}_suffix_blocked": 0.5})
    return rows


def fit(labelled: DataFrame, url: str, host: str, path: str, label: str, rows: int = TRAIN_ROWS) -> Model:
    """Learns from URLs whose column `label` says allow or block.

    Equal URLs are counted first and weigh as many as they are, so `labelled` is read once,
    and one URL on many rows is one row from there on. Suffix statistics cover all of them;
    the trees are grown from about `rows` different ones, chosen by a hash of the URL and
    written once. Labels of one kind, or none, give a model that always says that kind, or
    allow.
    """
    known = labelled.where(F.col(label).isin(ALLOW, BLOCK)).groupBy(url, host, path, label)
    known = saved(known.agg(F.count("*").cast("double").alias("__weight")), "labelled-urls")
    counts = {r[label]: (r["n"], r["urls"]) for r in known.groupBy(label).agg(F.sum("__weight").alias("n"), F.count("*").alias("urls")).collect()}
    if len(counts) < 2:
        return Model(None, None, next(iter(counts), ALLOW))
    total, different = (sum(x) for x in zip(*counts.values(), strict=True))
    rows_in = lexical(known, url, host, path).withColumn("blocked", (F.col(label) == BLOCK).cast("double"))
    every = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"{k}_bucket").alias("bucket")) for k in SUFFIXES)))
    rows_in = rows_in.withColumn("__fold", F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS)))
    keys = ["kind", "bucket"]
    by_fold = (
        rows_in.select(every.alias("s"), "blocked", "__weight", F.col("__fold").alias("fold"))
        .groupBy("s.kind", "s.bucket", "fold")
        .agg(F.sum("__weight").alias("n"), F.sum(F.col("__weight") * F.col("blocked")).alias("blocks"))
    )
    spark = labelled.sparkSession
    by_fold = spark.createDataFrame(by_fold.collect(), by_fold.schema)
    suffixes = by_fold.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("blocks").alias("blocks")).withColumn("total", F.lit(total))
    folds = by_fold.groupBy("kind", "fold").agg(F.sum("n").alias("of_fold"))
    without = (
        by_fold.withColumnsRenamed({"n": "own", "blocks": "own_blocks"})
        .join(suffixes, keys)
        .join(folds, ["kind", "fold"])
        .select(*keys, "fold", (F.col("n") - F.col("own")).alias("n"), (F.col("blocks") - F.col("own_blocks")).alias("blocks"), (F.col("total") - F.col("of_fold") + 1e-9).alias("total"))
    )
    suffixes, without = (spark.createDataFrame(x.collect(), x.schema) for x in (suffixes, without))
    keep = min(1.0, rows / different)
    sample = rows_in.where(F.pmod(F.xxhash64(url), F.lit(1_000_003)) < math.ceil(keep * 1_000_003))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    trees = GBTClassifier(
        featuresCol="__features", labelCol="blocked", predictionCol="__blocked", weightCol="__weight", maxIter=TREES, maxDepth=DEPTH, seed=1
    )
    train = ready.transform(_with_suffixes(sample, without, "__fold"))
    train = saved(train.select("__features", "blocked", "__weight"), "url-features")
    return Model(suffixes, PipelineModel([ready, trees.fit(train)]), ALLOW)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", key: str = "page_id", rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, host, path, rule, verdict) for every row: the verdict of the longest rule that
    fits, else that of trees trained on the rows that rules fit.

    Null URLs and URLs without `://` have an empty host and path; the trees judge them
    like any other. Repeated rows give repeated rows, an empty table none; other columns
    are ignored.
    """
    host, path = parts(F.col("__url"))
    urls = pages.select(F.col(key), F.col(url).cast("string").alias("__url")).withColumns({"__host": host, "__path": path})
    urls = urls.withColumn("__rule", fitting(F.col("__host"), F.col("__path"), rules))
    model = fit(urls.where("__rule is not null").withColumn("__label", F.col("__rule.verdict")), "__url", "__host", "__path", "__label", rows)
    if model.trees is None:
        judged = urls.withColumn("__verdict", F.lit(model.default))
    else:
        judged = model.trees.transform(_with_suffixes(lexical(urls, "__url", "__host", "__path"), model.suffixes))
        judged = judged.withColumn("__verdict", F.when(F.col("__blocked") > 0.5, BLOCK).otherwise(ALLOW))
    return judged.select(
        F.col(key),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule.name").alias("rule"),
        F.coalesce("__rule.verdict", "__verdict").alias("verdict"),
    )
