"""URL filters: rules on host and path, and a logistic regression on hashed character n-grams for the rest.

Host and path are cut out by SQL expressions. A rule is a host with a path, such as ``example.net/en/``; it
fits the URLs of its host and of all its subdomains whose path starts with its own, and the longest rule that
fits decides. Rules are a table: they are gathered by host and joined once for each number of labels that rule hosts
have, so neither a list nor the pages pass through the driver.

The classifier sees n-grams of 3 to 5 characters of the host (between dots, without case) and of the path
(digits as 0), hashed into a fixed number of buckets, each once a URL. It is fitted by Spark on a small labelled table of (url, blocked), of which at most ``train_rows`` rows,
those with the smallest hash, are used. Pages are scored in Arrow batches; the weights are one number a bucket.

Defined results: a null url, and one without ``://``, has an empty host and path; no rule fits it and it
gets the score of the intercept. Labelled rows with a null label are left out. Without labelled rows of both
kinds, every URL gets the share of blocked ones (0 without rows). Of rules of one length the longer host wins, and
of the same rule twice the one that blocks. Rules without a host are left out. Repeated pages are judged each;
no rows give no rows. Columns other than page_id and url are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.llm.arrow_text import bounded_batches, mix64, slices

ORDERS = (3, 4, 5)
#: Hash buckets of features, as a power of two.
BUCKET_BITS = 16
#: A URL that no rule fits is blocked from this score on.
THRESHOLD = 0.5
#: Ridge penalty of the regression.
PENALTY = 1e-4
#: Rows of the labelled table that are used at most.
TRAIN_ROWS = 20_000

#: The rules of the query, with their verdicts.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

#: What hosts of the labelled table are about.
BLOCKED_TOPICS = (
    "casino poker bets betting slots jackpot adult porn escort webcams pills pharmacy viagra replica payday loans "
    "spam adserver ads tracking tracker clicks popups warez keygen malware phishing cheap"
).split()
ALLOWED_TOPICS = (
    "news river garden library school museum science weather recipes travel history music software health council "
    "university letters archive forum village orchestra theatre cycling gardening chess mountain harbour kitchen "
    "physics biology painting poetry railway farming fishing walking knitting astronomy geology grammar language "
    "translation station nation action thread thunder thorn other mother brother weather feather there three then that "
    "thing north south teacher student reading writing cooking"
).split()
#: What stands beside a topic; the same for both kinds, as are the shapes.
COMPANIONS = ("", "-online", "-club", "-zone", "my-", "the-")
SHAPES = ("https://www.{}.test/en/{}", "http://{}.test/de/{}.html", "https://blog.{}.test/fr/{}/", "https://m.{}.test/es/{}?page=2")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table: each topic with every companion, in shapes taken in turn."""
    rows = []
    for blocked, topics in ((1, BLOCKED_TOPICS), (0, ALLOWED_TOPICS)):
        names = [c + t if c.endswith("-") else t + c for t in topics for c in COMPANIONS]
        rows += [(SHAPES[i % len(SHAPES)].format(name, 17 * i + 3), blocked) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "url string, blocked int")


def with_host_and_path(urls: DataFrame) -> DataFrame:
    """Replace ``url`` by host and path."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": lower, "path": path}).drop("url")


@dataclass(frozen=True)
class UrlModel:
    """Weight of each feature bucket and the intercept."""

    weights: np.ndarray
    intercept: float


def _grams(texts: list[str], part: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of the texts, and the text it is of."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.repeat(np.cumsum(lengths), lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)
    buckets, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for order in ORDERS:
        count = max(0, len(points) - order + 1)
        rolled = np.full(count, np.uint64(2 * order + part), np.uint64)
        for k in range(order):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + points[k : count + k]
        inside = np.arange(count) + order <= end[:count]
        buckets.append((mix64(rolled[inside]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[:count][inside])
    return np.concatenate(buckets), np.concatenate(owners)


_DIGITS = str.maketrans("123456789", "000000000")


def _features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and URL of every feature, by URL; an n-gram counts once for each."""
    found = []
    for part, texts in enumerate(([f".{h}." if h else "" for h in hosts], [p.translate(_DIGITS) for p in paths])):
        bucket, owner = _grams(texts, part)
        found.append(owner << BUCKET_BITS | bucket)
    code = np.unique(np.concatenate(found))
    return code & (1 << BUCKET_BITS) - 1, code >> BUCKET_BITS


def fit_urls(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> UrlModel:
    """Fit on a table of url and blocked (0 or 1)."""
    size = 1 << BUCKET_BITS
    known = labelled.where("blocked is not null").select("url", F.col("blocked").cast("int").alias("blocked"))
    # At most train_rows rows, in one order, so that the same table gives the same model.
    order = F.xxhash64("url", "blocked"), "url", "blocked"
    sample = with_host_and_path(known.orderBy(*order).limit(train_rows)).toArrow()
    labels = sample.column("blocked").to_numpy()
    blocked = int(labels.sum())
    if not 0 < blocked < len(labels):
        share = min(max(blocked / max(1, len(labels)), 1e-12), 1 - 1e-12)
        return UrlModel(np.zeros(size), math.log(share / (1 - share)))
    # Here, so that tasks which only score do not load the library.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    bucket, owner = _features(sample.column("host").to_pylist(), sample.column("path").to_pylist())
    bounds = np.searchsorted(owner, np.arange(len(labels) + 1))
    rows = [
        (float(labels[i]), Vectors.sparse(size, bucket[a:b], np.ones(b - a)))
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
    ]
    train = labelled.sparkSession.createDataFrame(rows, ["label", "features"]).coalesce(1)
    fitted = LogisticRegression(maxIter=100, regParam=PENALTY, standardization=False).fit(train)
    return UrlModel(fitted.coefficients.toArray(), float(fitted.intercept))


def score_urls(hosts: DataFrame, model: UrlModel) -> DataFrame:
    """Rows of page_id, host and path with ``score``, the probability of being blocked (six decimals)."""
    shared = hosts.sparkSession.sparkContext.broadcast(model)  # one number a bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value.weights, shared.value.intercept
        for batch in batches:
            for by_host in slices(batch, "host"):
                for part in slices(by_host, "path"):
                    bucket, owner = _features(part.column("host").to_pylist(), part.column("path").to_pylist())
                    raw = intercept + np.bincount(owner, weights[bucket], part.num_rows)
                    scores = np.round(1 / (1 + np.exp(-np.clip(raw, -40, 40))), 6)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, "score"])

    schema = T.StructType([*hosts.schema.fields, T.StructField("score", T.DoubleType())])
    return bounded_batches(hosts).mapInArrow(score, schema)


def with_rule(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``found``: verdict and text of the longest of ``rules`` (rule, verdict) that fits host and path, or null."""
    host = F.substring_index("rule", "/", 1)
    parts = rules.where("rule is not null and verdict is not null").select(
        host.alias("of"),
        F.struct(
            F.length("rule").alias("size"),
            F.length(host).alias("host_size"),
            "verdict",  # block stands after allow
            "rule",
            F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("path"),
        ).alias("fit"),
    )
    parts = parts.where("of != ''")
    labels = parts.agg(F.max(F.size(F.split("of", r"\."))).alias("most")).first().most or 0
    by_host = parts.groupBy("of").agg(F.collect_set("fit").alias("fits"))
    lists = []
    for k in range(1, labels + 1):  # the last k labels of a host
        name = f"fits_{k}"
        hosts = hosts.join(
            by_host.select(F.col("of").alias("of_rule"), F.col("fits").alias(name)),
            F.substring_index("host", ".", -k) == F.col("of_rule"),
            "left",
        ).drop("of_rule")
        lists.append(name)
    if not lists:
        return hosts.withColumn("found", F.lit(None).cast("struct<verdict:string,rule:string>"))
    fitting = [F.filter(F.coalesce(F.col(c), F.array()), lambda r: F.col("path").startswith(r.path)) for c in lists]
    return hosts.withColumn("found", F.array_max(F.concat(*fitting))).drop(*lists)


def judge_urls(pages: DataFrame, model: UrlModel, rules: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict (allow or block) and score of every page."""
    hosts = with_host_and_path(pages.select("page_id", "url"))
    judged = with_rule(score_urls(hosts, model), rules)
    by_score = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", by_score).alias("verdict"),
        "score",
    )


def url_filter_query(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    return judge_urls(pages, fit_urls(labelled_urls(spark)), rules)
