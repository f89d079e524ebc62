"""URL filters: rules first, then a logistic regression on hashed character n-grams.

The model learns from a small labelled URL table; training reads at most `train_rows` of it, chosen
by a hash so that the choice is the same on every run.  Only JVM functions run.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4)
BUCKETS = 1 << 12
TRAIN_ROWS = 4000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits the host or a domain above it and begins the path.

    Rules are a short list given as a parameter.  Two of one length can both fit (``a.b/`` and
    ``b/cc`` fit ``a.b/cc``): the least by code points is taken, however the rules are ordered.
    """
    out = F.lit(None).cast("string")
    for rule in sorted(sorted(rules, reverse=True), key=len):
        domain, _, begin = rule.partition("/")
        fits = (host == domain) | host.endswith(f".{domain}")
        out = F.when(fits & path.startswith(f"/{begin}"), F.lit(rule)).otherwise(out)
    return out


def _grams(host: Column, path: Column) -> Column:
    """Character n-grams of the marked host and the path, each kind apart."""

    def of(text: Column, mark: str) -> Column:
        return F.flatten(
            F.array(
                *[
                    F.when(
                        F.length(text) >= n,
                        F.transform(
                            F.sequence(F.lit(1), F.length(text) - (n - 1)),
                            lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))),
                        ),
                    ).otherwise(F.array().cast("array<string>"))
                    for n in GRAMS
                ]
            )
        )

    return F.concat(of(F.concat(F.lit("^"), host, F.lit("$")), "h"), of(path, "p"))


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    host, path = host_path(F.col(url_col))
    return pages.withColumns({"host": host, "path": path})


class UrlModel:
    """P(block) of hosts and paths; `fit` on a labelled table (url, blocked 0 or 1)."""

    def __init__(self, buckets: int = BUCKETS, train_rows: int = TRAIN_ROWS):
        self.hashing = HashingTF(
            inputCol="__grams", outputCol="__features", numFeatures=buckets, binary=True
        )
        self.train_rows, self.model, self.always = train_rows, None, 0.0

    def _features(self, df: DataFrame) -> DataFrame:
        return self.hashing.transform(df.withColumn("__grams", _grams(F.col("host"), F.col("path"))))

    def fit(self, labelled: DataFrame) -> UrlModel:
        """Rows with a null url or label are not used; one class only makes a constant model."""
        known = labelled.select("url", F.col("blocked").cast("double").alias("label")).dropna()
        chosen = known.orderBy(F.xxhash64("url"), "url", "label").limit(self.train_rows)
        chosen = stored(with_parts(chosen).coalesce(1), "url-sample")
        share = chosen.agg(F.avg("label")).first()[0]
        if share in (None, 0.0, 1.0):
            self.always = share or 0.0
            return self
        lr = LogisticRegression(
            featuresCol="__features", labelCol="label", predictionCol="__prediction",
            probabilityCol="__probability", rawPredictionCol="__raw", maxIter=50, regParam=0.01,
        )
        self.model = lr.fit(self._features(chosen).coalesce(1))
        return self

    def blocked(self, df: DataFrame) -> DataFrame:
        """Add `blocked` (boolean) to rows with host and path."""
        if self.model is None:
            return df.withColumn("blocked", F.lit(self.always > 0.5))
        kept = [F.col(c) for c in df.columns]
        scored = self.model.transform(self._features(df))
        return scored.select(*kept, (F.col("__prediction") > 0.5).alias("blocked"))


def url_filter(
    pages: DataFrame,
    rules: dict[str, str],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(<id_col>, host, path, rule, verdict), one row per row of pages.

    A rule decides where one fits, else the model.  Without a labelled table the model learns from
    the URLs that the rules decide.  Null and odd URLs have empty host and path and go to the model;
    repeated rows stay repeated, other columns are left out, no rows give no rows.
    """
    parts = with_parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    ruled = ruled.withColumn("ruled", verdicts[F.col("rule")])
    if labelled is None:
        labelled = ruled.where("rule IS NOT NULL").select(
            "url", (F.col("ruled") == "block").cast("int").alias("blocked")
        )
    model = UrlModel(train_rows=train_rows).fit(labelled)
    by_model = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return model.blocked(ruled).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_model).alias("verdict"),
    )
