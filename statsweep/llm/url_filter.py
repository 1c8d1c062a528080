"""URL filter: allow and block rules by host and path, and gradient-boosted trees on lexical features for the rest.

The rules label the URLs that they decide; the trees learn from those labels and judge every URL without a rule. Block
rates by host, suffix, top domain, first path step and pair count all labelled URLs; only the fitting is on a sample,
drawn per label and weighted back to the labels' shares.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, save

# (host, path prefix, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
FEATURES = ("url_len", "host_len", "path_len", "host_depth", "path_depth", "digits", "symbols", "hyphens", "entropy", "params", "fragment", "https",
            "host_rate", "suffix_rate", "top_rate", "first_rate", "pair_rate")
RATES = ("host", "suffix", "top", "first", "pair")
MAX_TRAIN = 20_000  # labelled URLs that the trees are fitted on, of each label the first by a hash of the URL
MIN_RATE = 5  # labelled URLs that a key must have in the whole table for a block rate of its own; else the rate is -1


def url_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``; both empty for a null URL or one without ``://``."""
    cut = lambda col, chars: F.regexp_extract(col, rf"\A[^{chars}]*", 0)
    at = F.coalesce(F.instr("url", "://"), F.lit(0))
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return (pages.withColumn("__rest", rest).withColumn("host", cut(F.col("__rest"), "/?#"))
            .withColumn("path", cut(F.expr("substring(__rest, length(host) + 1)"), "?#"))
            .withColumn("host", ascii_lower("host")).drop("__rest"))


def rule_column(rules, what: str):
    """The longest fitting rule's text (``what='rule'``) or verdict; null without one. Ties go to the earlier rule."""
    out = F.lit(None).cast("string")
    by_length = sorted(enumerate(rules), key=lambda r: (len(r[1][0] + r[1][1]), -r[0]))
    for _, (host, path, verdict) in by_length:
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(host + path if what == "rule" else verdict)).otherwise(out)
    return out


def first_step(path: str = "path"):
    """The first step of the path; empty without one."""
    return F.coalesce(F.get(F.split(path, "/"), F.lit(1)), F.lit(""))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features that need nothing but the URL."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    dropped = lambda chars: (F.length(url) - F.length(F.regexp_replace(url, chars, ""))) / n
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    chars = F.split(url, "")
    # entropy of the character distribution, from counts of the distinct characters
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars))
    entropy = -F.aggregate(counts, F.lit(0.0), lambda s, p: s + p * F.log2(p))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns({
        "url_len": F.length(url).cast("double"), "host_len": F.length("host").cast("double"), "path_len": F.length("path").cast("double"),
        "host_depth": F.size(labels).cast("double"), "path_depth": F.size(steps).cast("double"), "digits": dropped("[0-9]"),
        "symbols": dropped("[^A-Za-z0-9]"), "hyphens": dropped("-"), "entropy": entropy,
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double"), "fragment": url.contains("#").cast("double"),
        "https": F.lower(url).startswith("https").cast("double")})


def _groups(urls: DataFrame) -> DataFrame:
    """Per host and first path step, on which all keys depend: the keys ``k_*``, labelled URLs ``n`` and blocked ones ``b``."""
    labels = F.split("host", r"\.")
    top = F.coalesce(F.element_at(labels, -1), F.lit(""))
    return urls.groupBy("host", "k_first").agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("b"), F.count("label").alias("n")).withColumns({
        "k_host": F.col("host"), "k_suffix": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."), "k_top": top,
        "k_pair": F.concat_ws("/", top, "k_first")})


def _rates(groups: DataFrame) -> DataFrame:
    """Smoothed block rates per host and first path step, each key's over all its labelled URLs; -1 below ``MIN_RATE``."""
    out = groups
    for kind in RATES:
        rate = (groups.groupBy(f"k_{kind}").agg(F.sum("b").alias("kb"), F.sum("n").alias("kn")).where(F.col("kn") >= MIN_RATE)
                .select(f"k_{kind}", ((F.col("kb") + 0.5) / (F.col("kn") + 1)).alias(f"{kind}_rate")))
        out = out.join(rate, f"k_{kind}", "left").withColumn(f"{kind}_rate", F.coalesce(f"{kind}_rate", F.lit(-1.0)))
    return out.select("host", "k_first", *[f"{kind}_rate" for kind in RATES])


def judge_urls(pages: DataFrame, rules=RULES, max_train: int = MAX_TRAIN, trees: int = 12, depth: int = 3, seed: int = 5) -> DataFrame:
    """Per row of ``pages(page_id, url, ...)``: ``page_id, host, path, rule, verdict, score``.

    ``verdict`` is the longest fitting rule's, else the trees' (``block`` from a score of 0.5 on). ``score`` is the
    trees' chance of ``block`` for every URL. When the rules label no URL, or label them all alike, there is nothing to
    learn: URLs without a rule get that one verdict, ``allow`` if there is none. Rows with a repeated or null
    ``page_id`` keep their own row.
    """
    src = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = url_parts(src).withColumns({"rule": rule_column(rules, "rule"), "by_rule": rule_column(rules, "verdict"), "k_first": first_step()})
    urls = urls.withColumn("label", (F.col("by_rule") == "block").cast("double"))
    groups = save(_groups(urls), "url-groups")
    total = groups.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    blocked = int(total.b or 0)
    allowed = (total.n or 0) - blocked
    if not (blocked and allowed):
        discard(groups)
        only = "block" if blocked else "allow"
        return urls.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("score"))
    rates = save(_rates(groups), "url-rates")
    discard(groups)

    def draw(label: float, n: int, others: int) -> DataFrame:
        """At most half of the sample, or what the other label leaves; the weights stand for all of the label's URLs."""
        take = min(n, max(max_train // 2, max_train - others))
        return (urls.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url", "page_id").limit(take)
                .withColumn("weight", F.lit(n / take * min(1.0, max_train / (allowed + blocked)))))

    keys = ["host", "k_first"]
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    sample = save(lexical(draw(0.0, allowed, blocked).union(draw(1.0, blocked, allowed)).join(rates, keys, "left")), "url-sample")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, featuresCol="features", labelCol="label", weightCol="weight").fit(
        assemble.transform(sample).select("features", "label", "weight"))
    discard(sample)
    scored = model.transform(assemble.transform(lexical(urls.join(rates, keys, "left"))))
    score = vector_to_array(F.col("probability"))[1]
    verdict = F.coalesce("by_rule", F.when(score >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
