"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and the beginning of a path.  It fits its host and all subdomains; of the rules
that fit, the longest wins.  A url that no rule decides gets the verdict of boosted trees over its
lexical features: length, depth, digit ratio, character entropy, parameter counts, and the block
rates of its host's suffixes.  The trees are trained with Spark ML on labelled urls, here those that
a rule decides, at most ``TRAINING_ROWS`` different ones, half of either verdict; suffix rates are counted over all labelled urls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgelex.llm.common import saved, thinned

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TRAINING_ROWS = 20_000
TREES, DEPTH = 12, 4
#: Weight of the overall rate in a suffix's rate.
PRIOR_ROWS = 5.0
#: Scores above this block a url.
THRESHOLD = 0.6
LABELS = 3


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host.lower(), slash + path)


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path; both empty where the url is null or has no ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def decided(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(
            path, F.lit(r.path)
        )
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the letters, digits and four common signs, in bits."""
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789-._/"
    low = F.lower(text)
    n = F.greatest(F.length(text), F.lit(1))
    total = F.lit(0.0)
    for sign in alphabet:
        share = (F.length(text) - F.length(F.replace(low, F.lit(sign), F.lit("")))) / n
        total = total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    return total


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


LEXICAL = ("length", "host_length", "host_depth", "path_depth", "digits", "host_digits", "hyphens",
           "parameters", "value_length", "fragment", "secure", "entropy", "host_entropy")


def lexical(url: str = "url") -> list[Column]:
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    n = F.greatest(F.length(text), F.lit(1))
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    values = (
        F.length(text), F.length(host), _count(host, "."), _count(path, "/"), digits / n,
        F.length(F.regexp_replace(host, "[^0-9]", "")) / F.greatest(F.length(host), F.lit(1)),
        _count(host, "-"), F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        F.length(query), F.contains(text, F.lit("#")).cast("int"),
        F.startswith(text, F.lit("https:")).cast("int"), entropy(text), entropy(host),
    )
    return [v.cast("double").alias(name) for v, name in zip(values, LEXICAL, strict=True)]


def suffix(labels: int) -> Column:
    return F.substring_index("host", ".", -labels)


def suffix_rates(labelled: DataFrame, labels: int) -> DataFrame:
    """Smoothed share of blocked urls per host suffix of so many labels, over all labelled urls."""
    counts = labelled.groupBy(suffix(labels).alias("suffix")).agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked")
    )
    return counts.select(
        F.col("suffix").alias(f"suffix{labels}"),
        ((F.col("blocked") + 0.5 * PRIOR_ROWS) / (F.col("n") + PRIOR_ROWS)).alias(f"rate{labels}"),
        F.log1p("n").alias(f"seen{labels}"),
    )


#: Suffix features of a host that no labelled url has.
UNSEEN = {f"rate{k}": 0.5 for k in range(1, LABELS + 1)} | {
    f"seen{k}": 0.0 for k in range(1, LABELS + 1)
}


def with_suffixes(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    for labels in range(1, LABELS + 1):
        rates = suffix_rates(labelled, labels)
        rows = rows.join(rates, suffix(labels) == F.col(f"suffix{labels}"), "left").drop(
            f"suffix{labels}"
        )
    return rows.withColumns({name: F.coalesce(name, F.lit(value)) for name, value in UNSEEN.items()})


def judge(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and the trees' score of being blocked.

    Null urls and urls without ``://`` have empty host and path and are judged like any other.  Where
    no url, or only one verdict, is labelled there is nothing to train: the score is then the
    smoothed rate of the host's last label, 0.5 where that is unseen.  The trees learn from at most
    ``training_rows`` different urls, half of them of either verdict: copies and repeated rows of a
    url count once, and a rare verdict has its place.
    """
    host, path = parts(url_col)
    name, verdict = decided(F.col("host"), F.col("path"), rules)
    rows = (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
        .select("*", host.alias("host"), path.alias("path"))
        .select("*", name.alias("rule"), verdict.alias("ruled"))
    )
    # A url counts once, in the suffix rates and in the sample, however many rows have it.  Written
    # once, since seven joins read it.
    labelled = saved(
        rows.where("ruled is not null").select(
            "url", "host", "path", (F.col("ruled") == "block").cast("double").alias("label")
        ).distinct(),
        "labelled-urls",
    )
    features = [*LEXICAL, *(f"{k}{n}" for n in range(1, LABELS + 1) for k in ("rate", "seen"))]
    known = with_suffixes(rows.select("*", *lexical()), labelled)
    drawn = labelled.select("url", "host", "path", "label", F.xxhash64("url").alias("draw"))
    few, take = thinned(drawn, "label", "draw", training_rows // 2, training_rows)
    order = Window.partitionBy("label").orderBy("draw", "url")
    sample = saved(
        few.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= take).drop("turn"),
        "url-sample",
    )
    # Every url is learnt a second time as one of an unseen host, so that hosts without labelled urls
    # are judged by the other features.
    seen = with_suffixes(sample.select("*", *lexical()), labelled)
    twice = seen.withColumn("hidden", F.explode(F.array(F.lit(False), F.lit(True))))
    training = twice.withColumns(
        {name: F.when(F.col("hidden"), F.lit(value)).otherwise(F.col(name)) for name, value in UNSEEN.items()}
    ).drop("hidden")
    rows_of = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(rows_of) < 2:  # every labelled url, not only the drawn ones, has this one verdict
        blocked = F.col("rate1")
    else:
        assembler = VectorAssembler(inputCols=features, outputCol="features")
        # Both verdicts weigh the same, however often the rules give each.
        weight = F.when(F.col("label") > 0, 0.5 / rows_of[1.0]).otherwise(0.5 / rows_of[0.0])
        ready = (
            assembler.transform(training.repartition(1))
            .select("features", "label", (weight * sum(rows_of.values())).alias("weight"))
            .cache()
        )
        trees = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=11, weightCol="weight"
        ).fit(ready)
        ready.unpersist()
        known = trees.transform(assembler.transform(known))
        blocked = vector_to_array("probability")[1]
    return known.select(
        "page_id", "host", "path", "rule", blocked.alias("score"), "ruled"
    ).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") > THRESHOLD, "block").otherwise("allow"))
        .alias("verdict"),
        "score",
    )
