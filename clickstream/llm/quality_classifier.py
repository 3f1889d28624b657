"""Quality classifier with hierarchical empirical Bayes over sites.

1. A document classifier: a logistic curve over a dozen text measures, fit on a bounded
   sample of labelled rows.  Its evidence is the log odds beyond the labels' base rate.
2. Sites: every document has a host and a path below it.  Each site's good count is summed
   over all its documents: labelled ones count fully, the others with the classifier's
   probability at weight ``soft``.
3. Shrinkage: a host's rate is pulled towards the global rate, a path's towards its host's,
   with the strength that the spread between sites shows (beta-binomial, method of moments).
   A sparse site therefore says little, a null host nothing, a null path what its host says.
4. A document's score: its evidence plus the log odds of its path's rate.  Its own part is
   taken out of the sums of its path, its host and all documents first, so neither its label
   nor its evidence counts for itself: alone on its site it gets the others' global rate.

Sites are aggregated with partial sums before the shuffle; a site's posterior is one row, so
a hot host costs no more than another.  Texts are read once, into a table of measures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import bounded_fraction, text_bytes
from clickstream.session import materialize

_CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "space": (9, 10, 11, 12, 13, 32),
            "stop": b".,;:!?'\"()-", "symbol": b"#*$%&|<>@^~_=+/{}[]\\`", "high": range(128, 256)}
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _own in enumerate(_CLASSES.values()):
    _TABLE[list(_own), _k] = 1.0
MEASURES = [*_CLASSES, "log_words", "word_length", "distinct_words", "repeated_next", "repeated_lines", "distinct_grams"]


def measures(text: bytes | None) -> list[float]:
    """The measures of a text; null and empty texts have zeros."""
    t = text or b""
    shares = (np.bincount(np.frombuffer(t, np.uint8), minlength=256) @ _TABLE / max(1, len(t))).tolist()
    words = t.split()
    n = len(words)
    lines = [x for x in t.split(b"\n") if x]
    return [*shares, math.log1p(n), sum(map(len, words)) / max(1, n), len(set(words)) / max(1.0, n ** 0.8),
            sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1),
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)]


class Classifier(NamedTuple):
    mean: list[float]
    scale: list[float]
    weights: list[float]
    offset: float
    base: float


def fit(measured: DataFrame, usable: Column | None = None, max_fit_rows: int = 20_000) -> Classifier:
    """Logistic fit over ``measured (x, y)``, at most about ``max_fit_rows`` rows with a label (by a hash of ``doc_id``).

    Without both kinds of labels the classifier knows nothing: no weights, base rate from what there is.
    """
    mine = measured.where("y is not null")
    if usable is not None:
        mine = mine.where(usable)
    rows = mine.where(bounded_fraction(mine, F.col("doc_id"), max_fit_rows)).select("x", "y").toPandas()
    y = rows["y"].to_numpy(float)
    k = len(MEASURES)
    base = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    if len(y) == 0 or y.min() == y.max():
        return Classifier([0.0] * k, [1.0] * k, [0.0] * k, base, base)
    x = np.stack(rows["x"].to_numpy())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    a = np.hstack([np.clip((x - mean) / scale, -6, 6), np.ones((len(x), 1))])
    w = np.zeros(k + 1)
    w[-1] = base
    ridge = np.array([1.0] * k + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(hess, a.T @ (p - y) + ridge * w * ([1] * k + [0]))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(mean.tolist(), scale.tolist(), w[:-1].tolist(), float(w[-1]), base)


def log_odds(x: Column, model: Classifier) -> Column:
    """The classifier's log odds of a column of measures."""
    total = F.lit(model.offset)
    for k in range(len(MEASURES)):
        z = (F.get(x, F.lit(k)) - model.mean[k]) / model.scale[k]
        total = total + F.greatest(F.lit(-6.0), F.least(F.lit(6.0), z)) * model.weights[k]
    return total


def _sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def strength(groups: DataFrame, good: str, n: str, centre: Column) -> float:
    """Prior strength (pseudo-counts) from the spread of ``good / n`` around ``centre`` between groups."""
    n_, r = F.col(n), F.col(good) / F.col(n)
    row = groups.where(n_ > 0).agg(
        F.sum(n_).alias("n"), F.count(F.lit(1)).alias("k"), F.sum(n_ * F.pow(r - centre, 2)).alias("ss"),
        F.sum(centre * (1 - centre)).alias("within"), F.sum(n_ * n_).alias("nn")).first()
    if not row.k or row.k < 2:
        return 1e4
    # E[sum n (r - c)^2] = sum c(1-c) + tau^2 * sum over n
    spread = (row.ss - row.within) / max(row.n - row.nn / row.n, 1e-9)
    mean_var = row.within / row.k
    return float(min(1e4, max(1.0, mean_var / max(spread, 1e-9) - 1)))


def classify(docs: DataFrame, labels: DataFrame, sites: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", soft: float = 0.25,
             max_fit_rows: int = 20_000) -> DataFrame:
    """Per row of ``docs``: ``doc_id, evidence, host_rate, path_rate, score``.

    ``labels (doc_id, quality)``; ``sites (doc_id, host, path)``.  ``usable``: condition on
    ``doc_id`` of the labels that may be learned from, in the classifier and in the sites.  A
    document with several labels is good if most say so (ties: good), with several sites it
    belongs to the first by (host, path); null labels and null ids count nowhere.  Rows that
    share an id each get their score.
    """
    lab = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("y is not null")
    if usable is not None:
        lab = lab.where(usable)
    lab = lab.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    site = (sites.select(F.col(id_col).alias("doc_id"), "host", "path").where("host is not null")
            .groupBy("doc_id").agg(F.min(F.struct("host", "path")).alias("s"))
            .select("doc_id", "s.host", "s.path"))

    @F.arrow_udf("array<double>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array([measures(t) for t in text_bytes(arr)], pa.list_(pa.float64()))

    rows = docs.select(F.col(id_col).alias("doc_id"), measure(F.col(text_col)).alias("x"))
    measured = materialize(rows.join(lab, "doc_id", "left").join(site, "doc_id", "left"), "quality-measures")
    model = fit(measured, usable, max_fit_rows)
    z = log_odds(F.col("x"), model)
    weight = F.when(F.col("y").isNotNull(), F.lit(1.0)).otherwise(F.lit(soft))
    scored = (measured.select("doc_id", "host", "path", "y", z.alias("z")).withColumn("own_n", weight)
              .withColumn("own_good", F.coalesce("y", _sigmoid(F.col("z"))) * F.col("own_n")))
    mine = scored.groupBy("host", "path").agg(F.sum("own_n").alias("n"), F.sum("own_good").alias("good"))
    paths = materialize(mine, "quality-sites")
    total = paths.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    rate = (total.g + 0.5) / (total.n + 1) if total.n else 0.5
    hosts = paths.where("host is not null").groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hg"))
    k_host = strength(hosts, "hg", "hn", F.lit(rate))
    rated = hosts.select("host", ((F.col("hg") + k_host * rate) / (F.col("hn") + k_host)).alias("host_rate"))
    below = paths.where("host is not null and path is not null").join(rated, "host")
    k_path = strength(below, "good", "n", F.col("host_rate"))
    below = below.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("n").alias("pn"), F.col("good").alias("pg"))

    def others(good: Column, n: Column, k: float, centre: Column) -> Column:
        """The shrunk rate without the row's own part (sums may be off by rounding)."""
        return ((F.greatest(good - F.col("own_good"), F.lit(0.0)) + k * centre)
                / (F.greatest(n - F.col("own_n"), good - F.col("own_good"), F.lit(0.0)) + k))

    # without the row: (sum - own + 0.5) / (n - own + 1)
    outside = others(F.lit(float(total.g or 0.0)), F.lit(float(total.n or 0.0)), 1.0, F.lit(0.5))
    out = (scored.join(hosts, "host", "left")
           .join(below, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
           .withColumn("rate", outside)
           .withColumn("host_rate", F.coalesce(others(F.col("hg"), F.col("hn"), k_host, F.col("rate")), "rate"))
           .withColumn("path_rate", F.coalesce(others(F.col("pg"), F.col("pn"), k_path, F.col("host_rate")), "host_rate")))
    prior = F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    evidence = F.col("z") - F.lit(model.base)
    return out.select("doc_id", evidence.alias("evidence"), "host_rate", "path_rate",
                      _sigmoid(evidence + prior).alias("score"))


def page_sites(pages: DataFrame) -> DataFrame:
    """``(doc_id, host, path)`` of pages whose URL is ``scheme://host/section/number...``: the number is the document."""
    url = F.col("url")
    return pages.select(
        F.expr("try_cast(nullif(regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([0-9]{1,18})', 1), '') as bigint)").alias("doc_id"),
        F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1).alias("host"),
        F.regexp_extract(url, r"^[a-z]+://[^/]+/([^/?#]*)", 1).alias("path")).where("doc_id is not null and host != ''")
