"""Toxicity by weak supervision.

1. Terms: whole words and word beginnings that stand out in labelled toxic texts (a likelihood ratio that pays for the
   number of candidates tried), found on a sample of the labelled training rows.
2. Voters: the terms dealt into lexicon and prefix voters, a small fixed lexicon, and a density pattern.
3. Label model: votes of all documents, counted by vote pattern, give by expectation maximisation the accuracy of each
   voter and the correlations between voters inside a class; correlated voters share one vote's weight.
4. Classifier: logistic regression on term presence and counts, trained on the posterior labels of the sampled rows.

Labels come only from the rows the caller passes; scores see the text alone. Bounds, all documented parameters:
``MAX_LABELLED`` sampled rows, ``MAX_TERMS`` terms, 2**VOTERS patterns.

Edge cases: null text counts as empty and is scored (no term present); a null label or doc_id in ``labels`` is left out,
several labels of one document count as toxic if one is; without labelled rows, or without terms, every score is 0;
repeated rows are scored each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import id_text, work_table

MAX_LABELLED = 50_000
MAX_TERMS = 600
PREFIX = 5
WORD_VOTERS, PREFIX_VOTERS = 6, 4
VOTERS = WORD_VOTERS + PREFIX_VOTERS + 2
DENSE_PERCENT = 1
THRESHOLD = 0.7
MEMO_ENTRIES = 300_000
FLUSH = 300_000

# A small lexicon of our own.
LEXICON = (
    "idiot stupid moron scum trash loser worthless pathetic disgusting idiota imbécil estúpido basura asqueroso "
    "idiote stupide crétin ordure minable dumm blöd abschaum wertlos widerlich").split()

WORD = re.compile(r"[^\W\d_]+")


def features(chunk: str) -> list[str]:
    """Whole words ("word") and beginnings of longer ones ("word*") of a run without blanks."""
    out = []
    for w in WORD.findall(chunk.lower()):
        out.append(w)
        if len(w) > PREFIX:
            out.append(w[:PREFIX] + "*")
    return out


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic), one row per document, thinned by hash to about ``limit`` rows."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, limit / max(1, one.count()))
    return one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))


def find_terms(docs: DataFrame, sample: DataFrame) -> list[tuple[str, int, int]]:
    """(term, clean documents, toxic documents), strongest first."""
    rows = id_text(docs).join(F.broadcast(sample), "doc_id").select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]):
        seen = (Counter(), Counter())

        def flush():
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in seen)], names=["term", "n0", "n1"])
            seen[0].clear(), seen[1].clear()
            return out

        for batch in batches:
            for toxic, text in zip(batch.column(0), batch.column(1)):
                seen[1 if toxic.as_py() else 0].update({f for c in set(text.as_py().split()) for f in features(c)})
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield flush()
        yield flush()

    counts = rows.mapInArrow(run, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = work_table(counts.where("n1 >= 3"), "term-counts")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sum(n for t, n in totals.items() if not t), sum(n for t, n in totals.items() if t)
    if not n0 or not n1:
        return []
    base = n1 / (n0 + n1)
    share = F.col("n1") / (F.col("n0") + F.col("n1"))
    ratio = F.col("n1") * F.log(share / base) + F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    scored = counts.where(share >= 0.8).withColumn("ratio", ratio)
    tried = max(counts.count(), 1)
    best = scored.where(F.col("ratio") > float(np.log(tried)) + 2).orderBy(F.desc("ratio"), "term").limit(MAX_TERMS)
    return [(r["term"], r["n0"], r["n1"]) for r in best.collect()]


class TermFinder(dict):
    """Run without blanks -> indices of the terms in it."""

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        found = self[chunk] = tuple(sorted({self.index[f] for f in features(chunk) if f in self.index}))
        return found


def voter_of(terms: list[str]) -> list[int]:
    """Voter of each term: words and prefixes are dealt out in turn, so that voters of a kind are of like strength."""
    dealt = {False: 0, True: 0}
    out = []
    for t in terms:
        prefix = t.endswith("*")
        out.append(WORD_VOTERS + dealt[True] % PREFIX_VOTERS if prefix else dealt[False] % WORD_VOTERS)
        dealt[prefix] += 1
    return out


def votes(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, text_hash, votes (bit j: voter j says toxic), hits (distinct runs with a term) and the terms found."""
    shared = docs.sparkSession.sparkContext.broadcast([*terms, *(w for w in LEXICON if w not in set(terms))])
    n_terms = len(terms)
    voters = voter_of(terms)

    def run(batches: Iterator[pa.RecordBatch]):
        finder = TermFinder(shared.value)
        lexicon = {finder.index[w] for w in LEXICON}
        for batch in batches:
            rows = []
            for doc_id, text, text_hash in zip(*batch.columns):
                chunks = set(text.as_py().split())
                found = [x for x in map(finder.__getitem__, chunks) if x]
                all_ = {i for x in found for i in x}
                mine = sorted(i for i in all_ if i < n_terms)
                hits = sum(1 for x in found if x[0] < n_terms)
                mask = 0
                for i in mine:
                    mask |= 1 << voters[i]
                if all_ & lexicon:
                    mask |= 1 << (VOTERS - 2)
                if hits >= 3 and 100 * hits >= DENSE_PERCENT * len(chunks):
                    mask |= 1 << (VOTERS - 1)
                rows.append((doc_id.as_py(), text_hash.as_py(), mask, hits, mine))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc_id", "text_hash", "votes", "hits", "terms"])

    hashed = id_text(docs).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInArrow(run, "doc_id long, text_hash long, votes int, hits int, terms array<int>")


@dataclass
class LabelModel:
    """Class share, vote probabilities by class, correlations inside a class, and what each vote counts."""

    prior: float
    accuracy: np.ndarray  # [class, voter]: probability of a vote
    correlation: np.ndarray  # [voter, voter], mean over the classes
    weight: np.ndarray

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        one, zero = np.log(self.accuracy[1] / self.accuracy[0]), np.log((1 - self.accuracy[1]) / (1 - self.accuracy[0]))
        odds = np.log(self.prior / (1 - self.prior)) + (bits * one + (1 - bits) * zero) @ self.weight
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(patterns: dict[int, float], known: dict[int, tuple[float, float]], rounds: int = 30) -> LabelModel:
    """``patterns``: documents by vote pattern; ``known``: labelled (clean, toxic) documents by pattern, which keep their class."""
    masks = sorted(patterns | known)
    bits = np.asarray([[m >> j & 1 for j in range(VOTERS)] for m in masks], float)
    fixed = np.asarray([known.get(m, (0, 0)) for m in masks], float)
    free = np.maximum(np.asarray([patterns.get(m, 0) for m in masks], float) - fixed.sum(1), 0)
    model = LabelModel(0.5, np.empty((2, VOTERS)), np.zeros((VOTERS, VOTERS)), np.ones(VOTERS))
    toxic = np.clip(bits.sum(1) / 2, 0.02, 0.98)
    for turn in range(rounds):
        mass = np.stack([free * (1 - toxic), free * toxic]) + fixed.T
        if not turn and fixed.sum(0).min() > 0:
            mass = fixed.T  # start from what the labelled rows say
        total = mass.sum(1)
        model.prior = float(np.clip(total[1] / total.sum(), 1e-4, 0.5))
        model.accuracy = np.clip((mass @ bits + 0.1) / (total[:, None] + 0.2), 1e-4, 1 - 1e-4)
        correlations = []
        for k in (0, 1):
            away = bits - model.accuracy[k]
            cov = (away * mass[k][:, None]).T @ away / max(total[k], 1e-9)
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            correlations.append(np.clip(cov / np.outer(scale, scale), -1, 1))
        model.correlation = np.mean(correlations, axis=0)
        model.weight = 1 / (1 + np.maximum(model.correlation - np.eye(VOTERS), 0).sum(1))
        toxic = model.posterior(bits)
    return model


class Classifier:
    """Logistic regression on [1, log hits, votes, terms]."""

    def __init__(self, n_terms: int):
        self.n_terms = n_terms
        self.weights = np.zeros(2 + VOTERS + n_terms)

    def matrix(self, votes_: np.ndarray, hits: np.ndarray, terms: list) -> np.ndarray:
        x = np.zeros((len(votes_), len(self.weights)), np.float32)
        x[:, 0] = 1
        x[:, 1] = np.log1p(hits)
        for j in range(VOTERS):
            x[:, 2 + j] = votes_ >> j & 1
        for i, found in enumerate(terms):
            x[i, [2 + VOTERS + t for t in found]] = 1
        return x

    def fit(self, x: np.ndarray, target: np.ndarray, steps: int = 400, penalty: float = 1e-4) -> None:
        """Full-batch gradient steps with momentum; both classes weigh the same."""
        share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
        each = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share))
        speed = np.zeros_like(self.weights)
        for _ in range(steps):
            off = (1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))) - target) * each
            speed = 0.9 * speed - 0.1 * (off @ x / len(x) + penalty * self.weights)
            self.weights += speed

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_hash, score, predicted for every document; ``labels`` (doc_id, toxic) are the training rows only."""
    sample = work_table(labelled_sample(labels), "labelled")
    terms = [t for t, _, _ in find_terms(docs, sample)]
    if not terms:
        return id_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    voted = work_table(votes(docs, terms), "votes")
    patterns = {r["votes"]: float(r["n"]) for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 2**VOTERS
    trained = voted.join(F.broadcast(sample), "doc_id")
    known: dict[int, list[float]] = {}
    for r in trained.groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")).collect():
        known.setdefault(r["votes"], [0.0, 0.0])[1 if r["toxic"] else 0] += r["n"]
    model = fit_label_model(patterns, {m: (a, b) for m, (a, b) in known.items()})
    rows = trained.select("votes", "hits", "terms").limit(2 * MAX_LABELLED).toArrow()  # the labelled sample, bounded by its parameter
    classifier = Classifier(len(terms))
    x = classifier.matrix(rows.column("votes").to_numpy(), rows.column("hits").to_numpy(), rows.column("terms").to_pylist())
    bits = np.asarray([[m >> j & 1 for j in range(VOTERS)] for m in rows.column("votes").to_pylist()], float)
    classifier.fit(x, model.posterior(bits))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            fitted = shared.value
            p = fitted.score(fitted.matrix(batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "text_hash", "score", "predicted"])

    return voted.mapInArrow(run, "doc_id long, text_hash long, score double, predicted int")
