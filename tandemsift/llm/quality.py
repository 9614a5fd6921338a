"""Quality classifier: document evidence and host and path posteriors, shrunk by hierarchical empirical Bayes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows that the document classifier is fitted on, at most: those of the smallest hashes.
SAMPLE = 20_000
#: Sites (host and path) are broadcast up to so many, else joined by a shuffle.
BROADCAST_SITES = 1 << 16
THRESHOLD = 0.5
CLIP = 1e-4
#: Counted in a text, each divided by its words.
SIGNS = {
    "signs": r"[!|*&$%#=~^<>{}@_]",
    "shouts": "!",
    "bars": r"\|",
    "runs": r"[*&$%#]{2,}",
    "capitals": r"(?<![\p{L}\p{N}_])\p{Lu}{2,}",
    "digits": "[0-9]",
}
#: Of all words and lines of a text, whatever they are; see featured().
REPETITION = ("repeats", "distinct", "top", "lines")
FEATURES = (*SIGNS, "letters", *REPETITION, "evidence")
#: Lower-cased words fall into so many buckets by hash; each has a log ratio of good and bad labelled documents.
BUCKETS = 1 << 13
#: A word that the next word equals; possessive, so that long words cost one pass.
REPEATED = rf"(?<!{common.WORD[:-1]})({common.WORD}+)(?=[\x20\x09-\x0D]++\1(?!{common.WORD[:-1]}))"


@dataclass(frozen=True)
class Classifier:
    """Means, deviations and weights of the features, the first weight being the intercept, and the buckets' log ratios."""

    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    ratios: tuple[float, ...]

    def log_odds(self) -> Column:
        terms = [(F.col(f"_{f}") - m) * (w / s) for f, m, s, w in zip(FEATURES, self.means, self.scales, self.weights[1:], strict=True)]
        return sum(terms, F.lit(self.weights[0]))


def most_frequent(words: Column) -> Column:
    """How often the most frequent of some words occurs: the longest run of their sorted array."""

    def step(a: Column, word: Column) -> Column:
        run = F.when(a["word"] == word, a["run"] + 1).otherwise(1)
        return F.struct(word.alias("word"), run.alias("run"), F.greatest(a["most"], run).alias("most"))

    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("most"))
    return F.aggregate(F.sort_array(words), start, step, lambda a: a["most"])


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.lower(word)), F.lit(BUCKETS))


def word_ratios(labelled: DataFrame) -> tuple[float, ...]:
    """For each bucket of words the log of how much more often good documents have one than bad ones do.

    labelled[text, quality]; counts are of documents, so one long text counts once. The driver gets two counts a
    bucket.
    """
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(common.WORD), F.lit(0))
    own = F.array_distinct(F.transform(words, bucket))
    totals = dict(labelled.groupBy(F.col("quality").cast("int")).count().collect())
    seen = labelled.select(F.col("quality").cast("int").alias("quality"), F.explode(own).alias("bucket")).groupBy("bucket").agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0))
    out = [0.0] * BUCKETS
    for at, good, bad in seen.collect():
        out[at] = round(math.log((good + 1) / (totals.get(1, 0) + 2) * (totals.get(0, 0) + 2) / (bad + 1)), 6)
    return tuple(out)


def featured(docs: DataFrame, ratios: tuple[float, ...] | None = None) -> DataFrame:
    """docs with the feature columns; null counts as an empty text.

    Besides the signs: words equal to the word before, distinct words, the most frequent word, each over all
    words, the share of lines that repeat another, and the mean log ratio of all words' buckets.
    """
    text, words, n = F.coalesce("text", F.lit("")), F.col("_all"), F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    counts = {f"_{f}": F.regexp_count(text, F.lit(p)) / n for f, p in (SIGNS | {"repeats": REPEATED}).items()}
    shares = {"_distinct": F.size(F.array_distinct(words)) / n, "_top": most_frequent(words) / n}
    again = (F.size("_rows") - F.size(F.array_distinct("_rows"))) / F.greatest(F.size("_rows"), F.lit(1))
    table = F.split(F.lit(",".join(map(repr, ratios or [0.0]))), ",").cast("array<double>")  # folded to a constant
    evidence = F.aggregate(words, F.lit(0.0), lambda a, w: a + F.get(table, bucket(w).cast("int"))) / n if ratios else F.lit(0.0)
    split = docs.withColumns({"_all": F.regexp_extract_all(text, F.lit(common.WORD), F.lit(0)), "_rows": lines})
    counted = split.withColumn("_words", F.greatest(F.size("_all"), F.lit(1)))
    return counted.withColumns(counts | shares | {"_letters": F.length(text) / n / 10, "_lines": again, "_evidence": evidence}).drop("_words", "_all", "_rows")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, ridge: float = 0.5) -> Classifier:
    """Logistic regression of labels[doc_id, quality] on the features of docs, by Newton steps.

    At most `sample` labelled rows with a known quality take part. Half of them, by hash, give the words' log ratios
    and the others the weights, so that words aren't judged on the documents that they were learnt from. Without
    labelled rows, or with one class only, the weights are the ridge's. A null text counts as empty; rows that
    repeat an id take part each; labels of unknown documents don't.
    """
    known = labels.filter("quality IN (0, 1)").select(F.col("doc_id").alias("_id"), "quality")
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "quality").limit(sample)
    # bounded by the sample, but for documents that repeat an id
    labelled = common.stored(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")), "labelled")
    first = F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)) == 0
    ratios = word_ratios(labelled.filter(first))
    rows = featured(labelled.filter(~first), ratios)
    got = np.array([tuple(r) for r in rows.select("quality", *[f"_{f}" for f in FEATURES]).collect()], float).reshape(-1, len(FEATURES) + 1)
    common.remove(labelled, docs.sparkSession)
    y, x = got[:, 0], got[:, 1:]
    means, scales = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    a, w = np.c_[np.ones(len(x)), (x - means) / scales], np.zeros(len(FEATURES) + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w + np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
    return Classifier(tuple(means.tolist()), tuple(scales.tolist()), tuple(w.tolist()), ratios)


def probability(log_odds: Column) -> Column:
    return F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), log_odds))))))


def strength(between: float, within: float, low: float = 1.0, high: float = 1e4) -> float:
    """Pseudo-counts of a prior: variance within over variance between sites."""
    return min(max(within / between, low), high) if between > 0 else high


@dataclass(frozen=True)
class Priors:
    """What all sites have in common: documents, their summed probability, and the pseudo-counts of both priors."""

    n: int
    total: float
    host_k: float
    path_k: float


def site_sums(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, Priors]:
    """scored[host, path, _p] -> sums of each (host, path) and of its host, and the priors' strengths.

    A host's mean is shrunk toward the global mean and a path's toward its host's; how far follows from how
    much hosts, and paths within hosts, differ beyond what the documents' own spread makes of it (moments over all
    of them, in grouped aggregates).
    """
    own = scored.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path"))
    sums = common.stored(own.agg(F.count("*").alias("_n"), F.sum("_p").alias("_s"), F.sum(F.col("_p") ** 2).alias("_q")), "sites")
    n, s, q, sites, means = sums.agg(*(F.coalesce(F.sum(c), F.lit(0.0)) for c in ("_n", "_s", "_q")), F.count("*"), F.coalesce(F.sum(F.col("_s") ** 2 / F.col("_n")), F.lit(0.0))).first()
    mean = s / n if n else 0.5
    within = max((q - means) / max(1.0, n - sites), CLIP)
    hosts = sums.groupBy(F.col("_host").alias("_h")).agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"))

    def spread(rows: DataFrame, k: Column, t: Column, centre: Column) -> float:
        # what means differ by, over what the spread of documents alone makes of it
        count, square, total = rows.agg(F.count("*"), F.sum(k * (t / k - centre) ** 2), F.sum(k)).first()
        return max(0.0, (square - within * count) / total) if count > 1 else 0.0

    host_k = strength(spread(hosts, F.col("_hn"), F.col("_hs"), F.lit(mean)), within)
    joined = common.stored(sums.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h", "_q"), "paths")
    path_k = strength(spread(joined, F.col("_n"), F.col("_s"), F.col("_hs") / F.col("_hn")), within)
    common.remove(sums, scored.sparkSession)
    return joined, Priors(int(n), s, host_k, path_k)


def posterior_means(priors: Priors, left_out: Column) -> tuple[Column, Column, Column]:
    """Posterior means of the whole, the host and the path, of site sums; left_out is a probability that isn't counted.

    With a null left_out all documents count.
    """
    less, p = F.when(left_out.isNull(), 0).otherwise(1), F.coalesce(left_out, F.lit(0.0))
    whole = F.when(F.lit(priors.n) - less > 0, (F.lit(priors.total) - p) / (F.lit(priors.n) - less)).otherwise(0.5)
    host = (F.col("_hs") - p + priors.host_k * whole) / (F.col("_hn") - less + priors.host_k)
    return whole, host, (F.col("_s") - p + priors.path_k * host) / (F.col("_n") - less + priors.path_k)


def site_posteriors(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """scored[host, path, p] -> posterior mean of each (host, path) over all its documents, and the global mean."""
    sums, priors = site_sums(scored.select(host, path, F.col("p").alias("_p")), host, path)
    _, host_mean, site_mean = posterior_means(priors, F.lit(None).cast("double"))
    return sums.select("_host", "_path", host_mean.alias("host_mean"), site_mean.alias("site_mean")), priors.total / priors.n if priors.n else 0.5


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = THRESHOLD, sample: int = SAMPLE, texts: bool = True
) -> DataFrame:
    """docs[doc_id, text, host, path, ...] with doc_score, host_mean, site_mean, quality_score and keep.

    doc_score is the classifier's probability from the text alone; quality_score replaces its global prior
    by the posterior of the document's site: the log odds move by those of the site less those of all. A document's own
    score isn't counted in its site's means. Texts are worked through once and their scores stored; without
    `texts` the result has no text and less is stored. Where there are urls, take host and path from them.

    Null and empty texts count as one empty word; a null host or path is a site of its own; labels of
    unknown documents or without quality are left out; repeated rows are judged alike; an empty table gives
    none; columns of docs named as the results are replaced, others stay, but names with a leading underscore
    are this function's own.
    """
    model = fit(docs, labels, sample)
    made = ["doc_score", "host_mean", "site_mean", "quality_score", "keep"]
    docs = docs.drop(*made)
    kept = [c for c in docs.columns if texts or c != "text"]
    scored = common.stored(featured(docs, model.ratios).withColumn("_p", probability(model.log_odds())).select(*kept, "_p"), "scored")
    sites, priors = site_sums(scored, host, path)
    few = sites.count() <= BROADCAST_SITES
    joined = scored.join(F.broadcast(sites) if few else sites, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")))
    whole, host_mean, site_mean = posterior_means(priors, F.col("_p"))
    clipped = lambda p: F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), p))
    odds = lambda p: F.log(clipped(p) / (1 - clipped(p)))
    result = joined.withColumns({"host_mean": host_mean, "site_mean": site_mean, "_shift": odds(site_mean) - odds(whole)})
    return result.withColumn("quality_score", probability(odds(F.col("_p")) + F.col("_shift"))).select(
        *kept, F.col("_p").alias("doc_score"), "host_mean", "site_mean", "quality_score", (F.col("quality_score") >= threshold).alias("keep")
    )


def query(spark, sf_dir):
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return classify(docs.select("doc_id", "text", "source", "lang"), labels, texts=False)
