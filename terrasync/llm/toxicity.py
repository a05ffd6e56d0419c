"""Toxicity scores by non-negative positive-unlabelled learning (Kiryo et al., NIPS 2017).

Known are confirmed toxic documents; all others are unlabelled. The risk of a classifier g is that of the positives,
prior * E_p[l(g)], and that of the negatives, which is taken from the unlabelled by what positives among them
add: E_u[l(-g)] - prior * E_p[l(-g)]. This can't be negative for any true g, so where a sample makes it so, a step raises it again.

Features say that a text holds a word or stem, and how densely. Those that positives have significantly more often than
others are kept. Several logistic classifiers, each on half of the unlabelled sample, are trained by numpy in
tasks of their own; a text's score is the logistic of their mean.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bounds of the fit: about so many positives and unlabelled documents are drawn by a hash of their ids, over the whole table.
POSITIVES, UNLABELLED = 8192, 16384
#: Features kept, classifiers, steps of each and their size, shrinking of weights a step.
FEATURES, MEMBERS, STEPS, RATE, SHRINK = 4096, 5, 300, 0.05, 0.01
#: Letters of a stem; a stem is dense at one in so many words.
STEMS, DENSE = (4, 5, 6), (256, 128, 64, 32)
#: A text is searched for words in pieces of so many characters; known words are held up to a number.
PIECE, KNOWN = 1 << 20, 1 << 18
THRESHOLD, FOLDS, HELD_OUT = 0.7, 3, 1
_WORD, _GAP = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")


def words(text: str) -> Counter[str]:
    """Runs of letters in lower case, with their counts. A long text is cut between words, so counts are those of the whole."""
    found: Counter[str] = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        found.update(_WORD.findall(text[at:end].lower()))
        at = end
    return found


def stems(word: str) -> list[str]:
    """The word itself, marked, and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if len(word) > n)]


def levels(count: int, total: int) -> list[int]:
    """The densities that count of total words reach; one alone is no density."""
    return [d for d in DENSE if count > 1 and count * d >= total]


def features(text: str) -> set[str]:
    """The stems of a text, and stem@d where one word in d has it."""
    counts: Counter[str] = Counter()
    found = words(text)
    for w, k in found.items():
        for s in stems(w):
            counts[s] += k
    total = found.total()
    return set(counts) | {f"{s}@{d}" for s, k in counts.items() for d in levels(k, total)}


# ---------------------------------------------------------------- training


class Sparse:
    """A matrix of zeros and ones: rows of feature numbers."""

    def __init__(self, rows: list, width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.column = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row], minlength=self.width)


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def risk(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic risk of positives, and of negatives as estimated, which may be below zero; p and u are classifier values."""
    return prior * np.logaddexp(0, -p).mean(), np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()


def slopes(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives by p and u of what a step lowers: both risks, or minus that of negatives where it is below zero."""
    as_negative, negative = -prior * logistic(p) / len(p), logistic(u) / len(u)
    if risk(p, u, prior)[1] < 0:
        return -as_negative, -negative
    return -prior * logistic(-p) / len(p) + as_negative, negative


def train(positive: Sparse, unlabelled: Sparse, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights and, last, the bias: Adam's steps on the non-negative risk, weights shrunk towards zero."""
    w = np.zeros(positive.width + 1)
    w[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        gp, gu = slopes(positive.times(w[:-1]) + w[-1], unlabelled.times(w[:-1]) + w[-1], prior)
        g = np.append(positive.back(gp) + unlabelled.back(gu), gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - RATE * SHRINK, 0)
    return w


def _fold(id_: Column) -> Column:
    return F.crc32(id_.cast("string")) % FOLDS


def _drawn(id_: Column, most: int, of: int) -> Column:
    """About most of so many ids, by hash."""
    return F.pmod(F.xxhash64(id_, F.lit("toxicity")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(of, 1)))


def significance(k: str, n: str, positives: int, all_of: int) -> Column:
    """G-squared of a feature that k of the positives and n of all texts of the sample have; negative where positives have it less often."""
    rest = max(all_of - positives, 1)
    a, b = F.col(k).cast("double"), F.greatest(F.col(n) - F.col(k), F.lit(0)).cast("double")

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    share = (a + b) / (positives + rest)
    g = sum(term(x, y) for x, y in ((a, positives * share), (positives - a, positives * (1 - share)), (b, rest * share), (rest - b, rest * (1 - share))))
    return F.when(a / positives > b / rest, g).otherwise(-g)


class Model:
    """prior, vocabulary (feature to number) and weights: a row a classifier, the bias last."""

    def __init__(self, prior: float, vocabulary: dict[str, int], weights: np.ndarray):
        self.prior, self.vocabulary, self.weights = prior, vocabulary, weights
        mean = weights.mean(axis=0) if len(weights) else np.zeros(1)
        self.bias = float(mean[-1])
        self.by_stem: dict[str, tuple[float, dict[int, float]]] = {}
        for f, i in vocabulary.items():
            s, _, d = f.partition("@")
            plain, dense = self.by_stem.get(s, (0.0, {}))
            self.by_stem[s] = (plain, dense | {int(d): float(mean[i])}) if d else (float(mean[i]), dense)
        self.known: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        if not self.by_stem:
            return 0.0
        found, counts = words(text), Counter()
        for w, k in found.items():
            if (held := self.known.get(w)) is None:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                held = self.known[w] = tuple(s for s in stems(w) if s in self.by_stem)
            for s in held:
                counts[s] += k
        total, z = found.total(), self.bias
        for s, k in counts.items():
            plain, dense = self.by_stem[s]
            z += plain + sum(dense.get(d, 0.0) for d in levels(k, total))
        return float(logistic(z))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic: str = "toxic = 1") -> Model:
    """A model from the labels of ids outside the held-out fold.

    The prior is the share of toxic ids among those with labels, within 0.001 and 0.5; nothing else is learned from negative labels. An id is
    toxic if any of its labels says so. Texts count once each, so copies don't outweigh others. Ids that
    are null have no labels and aren't drawn. Without positives there is no vocabulary, and every score is 0.
    """
    spark = docs.sparkSession
    known = labels.select(labels[id_col].alias("id"), F.coalesce(F.expr(toxic), F.lit(False)).alias("toxic")).where(F.col("id").isNotNull() & (_fold(F.col("id")) != HELD_OUT))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.count_if("toxic")).first()
    one = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")).where(F.col("id").isNotNull() & (_fold(F.col("id")) != HELD_OUT))
    n_docs = one.count()
    if not n_toxic or not n_docs:
        return Model(0.0, {}, np.zeros((0, 1)))
    prior = min(max(n_toxic / n_known, 0.001), 0.5)

    positives = known.where(F.col("toxic") & _drawn(F.col("id"), POSITIVES, n_toxic)).select("id", F.lit(True).alias("positive"))
    drawn = one.join(F.broadcast(positives), "id", "left").where(F.col("positive") | _drawn(F.col("id"), UNLABELLED, n_docs))  # about POSITIVES ids are sent round

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("hash"), b.column("positive"), b.column("unlabelled"), pa.array(found, pa.list_(pa.string()))], ["hash", "positive", "unlabelled", "features"])

    marked = drawn.select(F.xxhash64("text").alias("hash"), F.coalesce("positive", F.lit(False)).alias("positive"), _drawn(F.col("id"), UNLABELLED, n_docs).alias("unlabelled"), "text")
    sample = marked.mapInArrow(featured, "hash long, positive boolean, unlabelled boolean, features array<string>")
    sample = written(sample.groupBy("hash").agg(F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"), F.any_value("features").alias("features")), "toxicity-sample")
    n_positive, n_all = sample.agg(F.count_if("positive"), F.count_if("unlabelled")).first()

    held = sample.select("positive", "unlabelled", F.explode("features").alias("feature")).groupBy("feature").agg(F.count_if("positive").alias("k"), F.count_if("unlabelled").alias("n")).where("k > 1")
    held = written(held, "toxicity-features")
    least = 2 * math.log(max(held.count(), 2)) + 2  # beyond what chance gives among so many features
    kept = held.withColumn("g", significance("k", "n", n_positive, n_all)).where(F.col("g") > least).orderBy(F.desc("g"), "feature").limit(FEATURES).collect()
    vocabulary = {r.feature: i for i, r in enumerate(kept)}
    if not vocabulary:
        return Model(prior, {}, np.zeros((0, 1)))

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["features"] = [[vocabulary[f] for f in x if f in vocabulary] for x in b["features"]]
            yield b

    def trained(key, pdf: pd.DataFrame) -> pd.DataFrame:
        p, u = (Sparse(pdf.features[pdf[c]].to_list(), len(vocabulary)) for c in ("positive", "unlabelled"))
        return pd.DataFrame({"member": [key[0]], "weights": [train(p, u, prior)]})

    rows = sample.mapInPandas(numbered, "hash long, positive boolean, unlabelled boolean, features array<int>")
    dealt = rows.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1)))).withColumn("unlabelled", F.col("unlabelled") & (F.pmod(F.xxhash64("hash", "member"), F.lit(2)) == 0)).where("positive or unlabelled")
    found = dealt.groupBy("member").applyInPandas(trained, "member int, weights array<double>").collect()
    return Model(prior, vocabulary, np.array([r.weights for r in sorted(found)]))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: its id, held_out, score and predicted. Null texts are empty; a null id isn't held out.

    Whole texts are scored, and nothing but the text. Repeated rows come back each; other columns are ignored, whatever their names.
    """
    one = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    scored = one.mapInArrow(each, f"id {one.schema['id'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(_fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
