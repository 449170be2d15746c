"""URL verdicts: host and path rules first, then a learnt model.

A rule names a host and the beginning of a path; it fits the host and all its
subdomains, and the longest fitting rule decides. For the rest a logistic
regression on hashed character n-grams of host and path decides, trained from
a small labelled URL table.

Everything is DataFrame expressions and Spark's DataFrame-based ML.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, lower_ascii, pick, shared_path

# (verdict, host/path beginning)
Rule = tuple[str, str]

NGRAMS = (3, 4)
BUCKETS = 1 << 12
# rows of the labelled URL table that a model is trained on, at most
MAX_TRAIN = 4000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are empty
    for a null url or one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls; of equally long
    rules the first in the list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in reversed(sorted(rules, key=lambda r: -len(r[1]))):  # the longest is tested first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def ngrams(host: Column, path: Column, sizes: tuple[int, ...] = NGRAMS) -> Column:
    """Character n-grams of host and path, marked as such, ends included."""
    def of(mark: str, text: Column, n: int) -> Column:
        ended = F.concat(F.lit("^"), text, F.lit("$"))
        last = F.greatest(F.length(ended) - F.lit(n - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last),
                           lambda i: F.concat(F.lit(mark), F.substr(ended, i, F.lit(n))))

    return F.concat(*[of(mark, text, n) for mark, text in (("h", host), ("p", path)) for n in sizes])


def _features(df: DataFrame, buckets: int) -> DataFrame:
    """``features`` from columns host and path: hashed n-gram presence."""
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    return tf.transform(df.withColumn("grams", ngrams(F.col("host"), F.col("path")))).drop("grams")


def train(labelled: DataFrame, max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> LogisticRegressionModel | float:
    """A model of ``labelled`` (url, verdict: block or allow), from at most
    ``max_train`` distinct urls chosen by hash. With urls of one verdict only,
    or none, the share of blocked ones is returned in place of a model."""
    host, path = host_and_path(F.col("url"))
    rows = (pick(labelled, url="url", verdict="verdict").where(F.col("verdict").isin("block", "allow"))
            .select(host.alias("host"), path.alias("path"),
                    F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("label"))
            .distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_train))
    rows = keep(_features(rows, buckets), "labelled")
    n, blocked = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or blocked in (0, n):
        return float(blocked / n) if n else 0.0
    fitted = LogisticRegression(regParam=0.01, maxIter=30, featuresCol="features",
                                labelCol="label").fit(rows.coalesce(1))
    # a fitted model holds its training summary and, through it, the session,
    # which tasks cannot be sent; a model that was read back holds neither
    path = shared_path(labelled.sparkSession, "url-model")
    fitted.save(path)
    return LogisticRegressionModel.load(path)


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None,
          threshold: float = 0.5, max_train: int = MAX_TRAIN, buckets: int = BUCKETS,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule (null without one), block_probability
    of the model and verdict (the rule's, else block at ``threshold``).

    ``labelled`` (url, verdict) trains the model; without it the urls that a
    rule decides are the labelled table. A null url, or one without ``://``,
    has empty host and path, fits no rule and is judged by the model like any
    other. Repeated rows get a row each; an empty table an empty result."""
    src = pick(pages, page_id=id_col, url=url_col).withColumn("url", F.col("url").cast("string"))
    host, path = host_and_path(F.col("url"))
    parsed = src.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("decided"))
    if labelled is None:
        labelled = ruled.where("rule is not null").select("url", F.col("decided").alias("verdict"))
    model = train(labelled, max_train, buckets)
    if isinstance(model, float):
        scored = ruled.withColumn("block_probability", F.lit(model))
    else:
        model.setProbabilityCol("p").setRawPredictionCol("").setPredictionCol("")
        scored = model.transform(_features(ruled, buckets)).withColumn(
            "block_probability", vector_to_array("p")[1])
    learnt = F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", "block_probability",
                         F.coalesce("decided", learnt).alias("verdict"))
