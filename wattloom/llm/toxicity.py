"""Toxicity by weak supervision.

1. Cues (words and word beginnings) that mark toxic texts are picked from a
   bounded sample of labelled training rows, by how much more often they occur there.
2. Cues are dealt out to many voters: lexicon voters (any of a list of words), pattern
   voters (any of a list of word beginnings), and voters on how many cues and
   which surface marks a text has. A voter fires or abstains; one fires where there is no cue.
3. A generative label model explains how often voters fire, alone and in pairs, over all
   documents: given the hidden label, a voter fires with some rate, and the covariance
   of two voters is the product of their strengths. Strengths come from triplets of
   voters; what a pair's covariance has beyond its product is their correlation, which
   lowers the weight of both votes.
   Gold labels of the training sample give the prior and a second estimate of the rates;
   the model uses the mean of both.
4. The posterior label of a text weighs the votes that fired and those that abstained; its
   gold label is not looked at. A linear classifier on cues and marks is trained on the
   posteriors of the sampled texts and scores every document.

Only labels of rows that are not held out are used. Rows: a null or
empty text has no cues and gets the score of the intercept. Repeated documents keep
their rows; equal texts count once in the sample. Without labelled rows of both kinds
every score is the share of toxic rows (0 without any). Null labels are ignored; of
several labels of one document the largest counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common

#: Labelled training rows that cues and classifier are fitted on, at most about.
SAMPLE_ROWS = 30_000
#: Cues of a kind kept, at most; the toxic texts one must occur in, as a number and as a
#: share of all toxic texts.
MAX_CUES = 2_000
LEAST_TEXTS = 4
LEAST_SHARE = 0.01
#: A cue's smoothed odds between toxic and other texts, to be a feature and to vote.
LEAST_ODDS = 4.0
VOTING_ODDS = 20.0
LEXICON_VOTERS = 16
PATTERN_VOTERS = 8
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Log odds that all votes on a text can give together: many votes on the same cues are
#: never worth as much as as many independent ones.
MOST_EVIDENCE = 15.0
#: No voter is taken to fire more seldom, or to abstain more seldom, than this.
LOW_RATE = 1e-4
#: Rounds of gradient descent of the classifier and its ridge penalty.
ROUNDS = 1_000
RIDGE = 1e-5

_WORD = re.compile(r"[^\W\d_]+")


def held_out(key: str) -> F.Column:
    """Rows that labels are never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def beginnings(words: set[str]) -> set[str]:
    """Beginnings of words, marked as such."""
    return {w[:k] + "-" for w in words for k in BEGINNINGS if len(w) >= k}


@dataclass
class Model:
    """Cues with their numbers, their voters, and the classifier's weights; the marks
    follow the cues in both."""

    words: dict[str, int] = field(default_factory=dict)
    beginnings: dict[str, int] = field(default_factory=dict)
    stems: set[str] = field(default_factory=set)
    voter: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    @property
    def size(self) -> int:
        return len(self.words) + len(self.beginnings) + MARKS


#: Surface marks of a text: two and three distinct cue words, two cue beginnings,
#: capitals, many exclamation marks, many symbols, no cue.
MARKS = 7
VOTERS = LEXICON_VOTERS + PATTERN_VOTERS + MARKS
NO_VOTER = VOTERS


def features(text: str | None, model: Model) -> list[int]:
    """Numbers of the cues and marks that a text has."""
    text = text or ""
    words = words_of(text)
    found = [model.words[w] for w in words & model.words.keys()]
    parts = beginnings({w for w in words if w[: BEGINNINGS[0]] in model.stems}) & model.beginnings.keys()
    base = len(model.words) + len(model.beginnings)
    size = max(1, len(text))
    marks = (
        len(found) >= 2,
        len(found) >= 3,
        len(parts) >= 2,
        text.isupper(),
        text.count("!") * 50 > size,
        sum(map(text.count, "*$%&#")) * 20 > size,
        not found and not parts,
    )
    return found + [model.beginnings[p] for p in parts] + [base + k for k, on in enumerate(marks) if on]


def votes(numbers: list[int], model: Model) -> np.ndarray:
    """Which voters fire on a text with these features."""
    fired = np.zeros(VOTERS + 1, bool)
    fired[model.voter[numbers]] = True
    return fired[:VOTERS]


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(text, toxic) of at most about ``rows`` labelled rows not held out, equal texts
    once; written, so that both passes see the same rows."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    total = known.count()
    share = 1 << 20
    cut = max(1, min(share, share * rows // max(1, total)))
    few = known.where(F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(share)) < cut)
    # At most about ``rows`` ids by construction.
    joined = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(few), key)
    once = joined.groupBy(F.xxhash64("text").alias("hash")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return common.staged(once.select("text", "toxic"), "labelled")


def _cue_counts(sample: DataFrame) -> DataFrame:
    """(cue, toxic, clean): texts of each kind that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                kinds[int(toxic > 0)].update(words | beginnings(words))
            cues = list(kinds[0].keys() | kinds[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cues, pa.string()), *(pa.array([k[c] for c in cues], pa.int64()) for k in kinds)],
                names=["cue", "clean", "toxic"],
            )

    counted = sample.mapInArrow(run, "cue string, clean long, toxic long")
    return counted.groupBy("cue").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _pick_cues(sample: DataFrame, toxic: int, clean: int) -> Model:
    """The cues most typical of toxic texts, dealt out to voters by turns."""
    rate = lambda c, n: (F.col(c) + 0.5) / F.lit(n + 1.0)
    strong = common.staged(
        _cue_counts(sample)
        .where(F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic))
        .withColumn("odds", rate("toxic", toxic) / rate("clean", clean))
        .where(F.col("odds") >= LEAST_ODDS)
        .withColumn("gain", F.col("toxic") * F.log("odds")),
        "cues",
    )
    model = Model()
    voter = []
    for place, cues, first, count in (
        (~F.col("cue").contains("-"), model.words, 0, LEXICON_VOTERS),
        (F.col("cue").contains("-"), model.beginnings, LEXICON_VOTERS, PATTERN_VOTERS),
    ):
        best = strong.where(place).orderBy(F.desc("gain"), "cue").limit(MAX_CUES).select("cue", "odds").collect()
        strong_so_far = 0
        for cue, odds in best:
            cues[cue] = len(voter)
            voter.append(first + strong_so_far % count if odds >= VOTING_ODDS else NO_VOTER)
            strong_so_far += odds >= VOTING_ODDS
    model.stems = {cue[: BEGINNINGS[0]] for cue in model.beginnings}
    voter += range(LEXICON_VOTERS + PATTERN_VOTERS, VOTERS)
    model.voter = np.array(voter, np.int64)
    return model


def _vote_moments(docs: DataFrame, text: str, model: Model) -> tuple[int, np.ndarray]:
    """Number of documents, and for each pair of voters how many both fire on: sums over
    all documents, added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((VOTERS, VOTERS), np.int64)
        for batch in batches:
            fired = np.array([votes(features(t, model), model) for t in batch.column(0).to_pylist()]).reshape(-1, VOTERS)
            both += fired.astype(np.int64).T @ fired.astype(np.int64)
            total += len(fired)
        rows, columns = np.indices(both.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(rows, -1)),
                pa.array(np.append(columns, -1)),
                pa.array(np.append(both.reshape(-1), total)),
            ],
            names=["i", "j", "n"],
        )

    sums = docs.select(text).mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((VOTERS, VOTERS))
    total = 0
    for i, j, n in sums:
        if i < 0:
            total = n
        else:
            both[i, j] = n
    return total, both


@dataclass
class LabelModel:
    """Rates at which voters fire on toxic and on other texts, and vote weights."""

    prior: float
    toxic_rate: np.ndarray
    clean_rate: np.ndarray
    weight: np.ndarray
    correlation: np.ndarray

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability of a toxic text from the votes that fired and those that did not."""
        on = self.weight * np.log(self.toxic_rate / self.clean_rate)
        off = self.weight * np.log((1 - self.toxic_rate) / (1 - self.clean_rate))
        evidence = np.clip(fired @ on + (1 - fired) @ off, -MOST_EVIDENCE, MOST_EVIDENCE)
        logit = np.log(self.prior / (1 - self.prior)) + evidence
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def with_gold(self, fired: np.ndarray, gold: np.ndarray, count: np.ndarray) -> LabelModel:
        """The model with each rate the mean of its own and of that among gold-labelled
        texts; ``count`` says how many texts a row stands for."""
        rates = []
        for own, kind in ((self.toxic_rate, gold), (self.clean_rate, ~gold)):
            texts = np.where(kind, count, 0)
            seen = (fired.T @ texts + 0.5) / (texts.sum() + 1.0)
            rates.append((own + np.clip(seen, LOW_RATE, 1 - LOW_RATE)) / 2)
        return replace(self, toxic_rate=rates[0], clean_rate=rates[1])


def fit_label_model(total: int, both: np.ndarray, prior: float) -> LabelModel:
    """Rates from first and second moments of the votes.

    With independent voters, cov(i, j) = s_i * s_j for i != j, where s_i is the strength
    sqrt(prior (1 - prior)) (toxic rate - clean rate); so s_i**2 = cov(i, j) cov(i, k) /
    cov(j, k) for any j, k. The median over all pairs j, k withstands correlated pairs.
    """
    prior = min(max(prior, 1e-3), 0.5)
    mean = both.diagonal() / max(1, total)
    covariance = both / max(1, total) - np.outer(mean, mean)
    usable = np.flatnonzero((mean > 1e-5) & (mean < 1 - 1e-5))
    strength = np.zeros(len(mean))
    for i in usable:
        others = usable[usable != i]
        found = []
        for n, j in enumerate(others):
            k = others[n + 1 :]
            ok = covariance[j, k] > 1e-9
            found += (covariance[i, j] * covariance[i, k][ok] / covariance[j, k][ok]).tolist()
        squared = np.median(found) if found else 0.0
        side = np.sign(covariance[i, others].sum()) or 1.0
        strength[i] = side * np.sqrt(max(0.0, squared))
    low, high = LOW_RATE, 1 - LOW_RATE
    toxic_rate = np.clip(mean + strength * np.sqrt((1 - prior) / prior), low, high)
    clean_rate = np.clip(mean - strength * np.sqrt(prior / (1 - prior)), low, high)
    # What is left of the correlation of two voters beyond the common label.
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    rest = (covariance - np.outer(strength, strength)) / np.outer(spread, spread)
    np.fill_diagonal(rest, 0.0)
    correlation = np.clip(rest, -1, 1)
    weight = 1 / (1 + np.maximum(correlation, 0).sum(axis=1))
    weight[np.abs(strength) <= 1e-6] = 0.0
    return LabelModel(prior, toxic_rate, clean_rate, weight, correlation)


def _sample_features(sample: DataFrame, model: Model) -> list[tuple[list[int], bool, int]]:
    """(features, gold, how many texts) of the sample, which bounds the rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t, model) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["f", "toxic"])

    fields = [T.StructField("f", T.ArrayType(T.IntegerType())), T.StructField("toxic", T.IntegerType())]
    counted = common.map_batches(sample.select("text", "toxic"), run, fields).groupBy("f", F.col("toxic") > 0).count()
    return sorted(tuple(r) for r in counted.collect())


def fit_classifier(rows: list[tuple[list[int], bool, int]], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features with soft labels, by gradient descent
    with a step per weight; ``rows``: (features, gold, how many texts)."""
    weights, intercept = np.zeros(size), 0.0
    if not rows:
        return weights, intercept
    count = np.array([n for _, _, n in rows], float)
    owner = np.repeat(np.arange(len(rows)), [len(f) for f, _, _ in rows])
    column = np.array([c for f, _, _ in rows for c in f], np.int64)
    share = count / count.sum()
    seen_w, seen_b = np.full(size, 1e-12), 1e-12
    for _ in range(ROUNDS):
        logit = np.bincount(owner, weights[column], len(rows)) + intercept
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * share
        slope_w, slope_b = np.bincount(column, error[owner], size) + RIDGE * weights, error.sum()
        seen_w, seen_b = seen_w + slope_w**2, seen_b + slope_b**2
        weights -= slope_w / np.sqrt(seen_w)
        intercept -= slope_b / np.sqrt(seen_b)
    return weights, float(intercept)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    sample = training_rows(docs, labels, key, text, label, rows)
    kinds = dict(tuple(r) for r in sample.groupBy(F.col("toxic") > 0).count().collect())
    toxic, clean = kinds.get(True, 0), kinds.get(False, 0)
    prior = toxic / max(1, toxic + clean)
    if not toxic or not clean:
        model = Model()
        model.voter = np.arange(LEXICON_VOTERS + PATTERN_VOTERS, VOTERS)
        model.weights = np.zeros(MARKS)
        model.intercept = float(np.clip(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12)), -30, 30))
        return model
    model = _pick_cues(sample, toxic, clean)
    total, both = _vote_moments(docs, text, model)
    found = _sample_features(sample, model)
    fired = np.array([votes(f, model) for f, _, _ in found], float)
    gold, count = np.array([g for _, g, _ in found]), np.array([n for _, _, n in found])
    label_model = fit_label_model(total, both, prior).with_gold(fired, gold, count)
    model.weights, model.intercept = fit_classifier(found, label_model.posterior(fired), model.size)
    return model


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    logits = np.array([model.weights[features(t, model)].sum() for t in texts]) + model.intercept
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scored(docs: DataFrame, model: Model, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns of every document and its ``_score``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = score_texts(batch.column(text).to_pylist(), model)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(scores)], names=[*kept, "_score"]
        )

    fields = [*(common.renamed(docs.schema[c], c) for c in kept), T.StructField("_score", T.DoubleType())]
    return common.map_batches(docs.select(*dict.fromkeys([*kept, text])), run, fields)
