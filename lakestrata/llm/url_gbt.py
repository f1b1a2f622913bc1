"""URL filters: rules, and gradient-boosted trees on lexical features where no rule fits.

Labelled URLs train the trees; here the rules label them. Features are column expressions, the
trees are MLlib's, so judging a URL stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

FEATURES = ("length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "n_hyphens", "suffix_rate", "domain_rate")


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for a host with its subdomains and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @classmethod
    def parse(cls, text: str) -> UrlRule:
        """From ``allow org/`` or ``block example.org/es/``."""
        verdict, place = text.split(" ", 1)
        host, slash, path = place.partition("/")
        return cls(verdict, host, slash + path)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased (null or none: empty)."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end (null or no ``://``: empty)."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (of equally long ones the first by name; null: none)."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _lexical(url: Column, host: Column) -> dict[str, Column]:
    n = F.greatest(F.char_length(url), F.lit(1)).cast("double")
    count = lambda c, pattern: F.char_length(c) - F.char_length(F.regexp_replace(c, pattern, ""))
    share = lambda c: (F.char_length(url) - F.char_length(F.replace(url, c, F.lit("")))) / n
    letters = F.array_distinct(F.split(url, ""))
    return {
        "length": F.char_length(url).cast("double"),
        "depth": count(F.regexp_replace(F.regexp_replace(url, "^[^:]*://", ""), "[?#].*", ""), "/").cast("double"),
        "digit_ratio": count(url, "[0-9]") / n,
        "entropy": F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))),
        "n_params": count(F.regexp_extract(url, r"\?([^#]*)", 1), "=").cast("double"),
        "n_labels": (count(host, r"\.") + 1).cast("double"),
        "n_hyphens": count(host, "-").cast("double"),
    }


def _suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and its last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def judge_urls(pages: DataFrame, rules: list[UrlRule], *, url: str = "url", id_col: str = "page_id", max_labelled: int = 20_000,
               trees: int = 12, depth: int = 4, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` (id and url) with ``host path rule verdict score``; score is the trees' block probability.

    Trained on at most ``max_labelled`` labelled URLs (least ``xxhash64`` of the URL first, a
    documented bound on the training rows alone): those of ``labelled`` (url, block 0/1), or else
    the distinct URLs that a rule fits, labelled by their rule. Suffix statistics are the smoothed
    block rates of the host's last label and last two labels among the training URLs. With
    training URLs of one class, or none, that class or ``allow`` is the method's verdict.
    Null and empty URLs have empty host and path and zero features. Every row comes back.
    """
    spark = pages.sparkSession
    u = F.coalesce(F.col("url"), F.lit(""))
    base = pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url}`").alias("url"))
    base = base.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": name, "_ruled": verdict})
    if labelled is None:
        known = base.where("_ruled IS NOT NULL").select("url", (F.col("_ruled") == "block").cast("double").alias("label")).distinct()
    else:
        known = labelled.where("url IS NOT NULL AND block IN (0, 1)").select("url", F.col("block").cast("double").alias("label")).distinct()
    known = known.orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled)
    known = known.withColumn("host", url_host(F.col("url")))
    last, two = _suffixes(F.col("host"))
    known = stage(known.select("label", last.alias("_last"), two.alias("_two"), *[c.alias(f) for f, c in _lexical(u, F.col("host")).items()]), "urls")
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    last, two = _suffixes(F.col("host"))
    if not n or blocked in (0, n):
        out = base.withColumn("score", F.lit(float(bool(n) and blocked == n)))
    else:
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        prior = blocked / n
        rate = lambda key, out: (known.groupBy(key).agg(((F.sum("label") + 5 * prior) / (F.count("*") + 5)).alias(out)))

        def with_rates(df: DataFrame) -> DataFrame:
            # a row for each suffix of the training URLs, max_labelled at most: a proven bound
            df = df.join(F.broadcast(rate("_last", "suffix_rate")), "_last", "left").join(F.broadcast(rate("_two", "domain_rate")), "_two", "left")
            return df.fillna(prior, ["suffix_rate", "domain_rate"])

        train = stage(with_rates(known).select("label", *FEATURES), "training")
        trees_of = GBTClassifier(labelCol="label", featuresCol="x", maxIter=trees, maxDepth=depth, maxBins=32, seed=7)
        model = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="x", handleInvalid="keep"), trees_of]).fit(train)
        rows = base.withColumns({"_last": last, "_two": two, **_lexical(u, F.col("host"))})
        out = model.transform(with_rates(rows)).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return out.select(id_col, "url", "host", "path", "rule", F.coalesce("_ruled", own).alias("verdict"), "score")
