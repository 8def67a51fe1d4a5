"""Toxicity scores from a weighted finite-state pattern grammar over clauses.

Five small transducers read the words of a clause. The insult transducer is a weighted trie:
it follows a word's letters from state to state and puts out the weight of the deepest state
it reaches, or of the whole word where that is known. Its weights are learned: log odds of
whole words and word beginnings in toxic against other labelled documents of a bounded
sample, where a beginning keeps a state only if it was seen in enough toxic documents. The
least weight that counts is relative to the mix of labels (see ``Insults.cut_at``) and chosen
on an inner fold of the training rows.
The threat, target, negation and reported-speech transducers are short word lists that switch
a clause's registers: a threat word before a target adds weight, a target near the insult
raises it, a negation shortly before the insult and a verb of reported speech earlier in the
clause lower it. The strength of a clause is the sum of what its matched words give.

A document is described by its matched clauses: the strongest, their sum, their number and
their share. A logistic model with these four inputs, fitted on the same sample, gives the
score. Words of no matched clause play no part.

Null and empty texts have no clause and score as clean documents do. Without usable labels of
both kinds the score is 0 for every row. Null ids are never held out and match no label; rows
that repeat get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, memo_of, spill
from clickwarden.llm.quality import keep_rows, labelled_texts

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:,\n]+")

TARGETS = frozenset((
    "you your yours yourself he she they them him her his their these those people everyone "
    "du dich dir dein deine ihr euch sie ihn ihm leute alle tu te toi ton ta vous votre il elle ils elles gens "
    "tú ti tu usted ustedes vosotros él ella ellos ellas gente todos").split())
THREATS = frozenset((
    "kill hurt destroy beat shoot stab burn crush die töten umbringen schlagen zerstören sterben verletzen "
    "tuer frapper détruire mourir blesser brûler matar golpear destruir morir herir quemar").split())
NEGATIONS = frozenset("not never no nor isn't nicht nie kein keine niemals ne pas jamais nunca jamás tampoco".split())
REPORTS = frozenset((
    "said says reported quoted claimed wrote sagte sagt berichtete schrieb zitierte behauptete "
    "dit disait écrit rapporte cité affirmait dijo dice escribió informó citó afirmó").split())
NEGATION_REACH, TARGET_REACH = 3, 4
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.6, 0.8, 1.25, 2.0
STEM_LENGTHS = (3, 4, 5, 6, 7, 8, 9)
CUTS = (-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0)  # log odds of a toxic text, tried on the inner fold
LEAST = 0.1
INNER_FOLDS = 5


@dataclass
class Insults:
    """Weighted trie; keys ending in ``$`` are whole words. Weights below ``least`` give nothing."""

    weights: dict[str, float]
    least: float = 2.5
    prior: float = 0.0  # log odds of a clean text in the rows learned from
    memo: dict[str, float] = field(default_factory=dict, repr=False)

    def cut_at(self, odds: float) -> Insults:
        """The same trie, where a match must make a toxic text likelier than ``odds`` (log odds) in rows of this mix."""
        return replace(self, least=max(odds + self.prior, LEAST))

    def weight(self, word: str) -> float:
        out = self.memo.get(word)
        if out is None:
            out = self.weights.get(word + "$")
            if out is None:
                for n in reversed(STEM_LENGTHS):
                    if n <= len(word) and word[:n] in self.weights:
                        out = self.weights[word[:n]]
                        break
            out = out if out is not None else 0.0
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = out
        return out if out >= self.least else 0.0


def stems(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in STEM_LENGTHS if n <= len(word))]


def clause_strength(words: list[str], insults: Insults) -> float:
    """Weight that the composed transducers give to one clause; 0 if nothing matches."""
    total, negated, reported, target, threat = 0.0, -9, False, -9, -9
    for at, word in enumerate(words):
        if word in NEGATIONS:
            negated = at
        elif word in REPORTS:
            reported = True
        if word in TARGETS:
            if at - threat <= TARGET_REACH and threat >= 0:
                total += THREAT_WEIGHT * (NEGATED if threat - negated <= NEGATION_REACH else 1) * (REPORTED if reported else 1)
                threat = -9
            target = at
        if word in THREATS:
            threat = at
        weight = insults.weight(word)
        if weight:
            near = at - target <= TARGET_REACH or any(w in TARGETS for w in words[at + 1:at + 1 + TARGET_REACH])
            total += weight * (TARGETED if near else 1) * (NEGATED if at - negated <= NEGATION_REACH else 1) * (
                REPORTED if reported else 1)
    return total


def matched_clauses(text: str | None, insults: Insults) -> list[tuple[str, float]]:
    """The clauses with a match and their strengths, in the text's order."""
    lower = (text or "").lower()
    weight = insults.weight
    words = set(WORD.findall(lower))
    hits = {w for w in words if weight(w)}
    if not hits and not (words & THREATS and words & TARGETS):
        return []
    out = []
    for clause in CLAUSE.split(lower):
        found = WORD.findall(clause)
        if hits.isdisjoint(found) and THREATS.isdisjoint(found):
            continue
        strength = clause_strength(found, insults)
        if strength > 0:
            out.append((clause.strip(), strength))
    return out


def describe(text: str | None, insults: Insults) -> list[float]:
    return summary([s for _, s in matched_clauses(text, insults)], text)


def describe_at(text: str | None, cuts: list[Insults]) -> list[float]:
    """Inputs under each of ``cuts``, one trie with rising least weights, one after another.
    A clause that matches under any of them matches under the first."""
    clauses = [WORD.findall(c) for c, _ in matched_clauses(text, cuts[0])]
    out = []
    for insults in cuts:
        strengths = [clause_strength(c, insults) for c in clauses]
        out += summary([s for s in strengths if s > 0], text)
    return out


def summary(strengths: list[float], text: str | None) -> list[float]:
    if not strengths:
        return [0.0] * 4
    return [max(strengths), np.log1p(sum(strengths)), np.log1p(len(strengths)),
            1000 * len(strengths) / (len(text) + 100)]


def learn_insults(rows: DataFrame, min_documents: int = 4, max_states: int = 30_000) -> Insults:
    """Weights from ``rows`` (text, label), a bounded sample. Equal texts of one label count once.
    Counts are taken per task and summed by Spark."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        memo_of("toxicity")
        for batch in column_batches(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {s for w in set(WORD.findall((text or "").lower())) if len(w) > 2 for s in stems(w)}
                (toxic if label else clean).update(found)
        keys = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
             pa.array([clean[k] for k in keys], pa.int64())], ["stem", "toxic", "clean"])

    # copies would count one author's words many times; only whole texts tell them, since openings may be a source's header
    rows = rows.select("text", "label").distinct()
    totals = rows.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in totals}
    if not n.get(0) or not n.get(1):
        return Insults({})
    counted = rows.mapInArrow(count, "stem string, toxic long, clean long").groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= min_documents)
    weight = F.log((F.col("toxic") + 0.3) / (n[1] + 1.0)) - F.log((F.col("clean") + 1.0) / (n[0] + 2.0))
    # a state is worth keeping where words in toxic documents are far above chance, or to overrule such a state
    kept = counted.withColumn("weight", weight).orderBy(
        F.desc(F.col("toxic") * F.abs("weight")), "stem").limit(max_states).select("stem", "weight").collect()
    return Insults({r["stem"]: r["weight"] for r in kept}, prior=float(np.log((n[0] + 2.0) / (n[1] + 1.0))))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, float]:
    """Newton's method for a few inputs."""
    scale = x.std(0) + 1e-9
    z = np.c_[x / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        ridge = penalty * np.r_[np.ones(x.shape[1]), 0]
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1])


@dataclass
class Grammar:
    insults: Insults
    weights: np.ndarray
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.intercept, -30, 30)))


def measured(rows: DataFrame, cuts: list[Insults]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (row, cut, 4), labels and inner folds of ``rows`` (doc_id, text, label, fold)."""

    def measure(batches):
        memo_of("toxicity")
        for batch in column_batches(batches):
            values = [describe_at(t, cuts) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(
                values, pa.list_(pa.float64()))], ["doc_id", "label", "fold", "x"])

    sample = rows.select("doc_id", "text", "label", "fold").mapInArrow(
        measure, "doc_id long, label int, fold int, x array<double>").orderBy("doc_id", "label", "x").toPandas()
    x = np.array(sample["x"].tolist(), np.float64).reshape(-1, len(cuts), 4)
    return x, sample["label"].to_numpy(np.float64), sample["fold"].to_numpy()


def choose_cut(rows: DataFrame) -> float:
    """The one of CUTS under which a grammar learned without the inner fold predicts that fold best (log loss).
    Equal texts share a fold; equal losses go to the cut nearest 0, which also stands where a side has not both labels."""
    part = learn_insults(rows.filter("fold != 0"))
    x, y, fold = measured(rows, [part.cut_at(c) for c in CUTS])
    inner = fold == 0
    if min(len(set(y[inner].tolist())), len(set(y[~inner].tolist()))) < 2:
        return 0.0
    losses = []
    for k in range(len(CUTS)):
        weights, intercept = fit_logistic(x[~inner, k], y[~inner])
        margin = np.clip(x[inner, k] @ weights + intercept, -30, 30)
        losses.append(round(float(np.mean(np.logaddexp(0, margin) - y[inner] * margin)), 6))
    return min(zip(losses, map(abs, CUTS), CUTS, strict=True))[2]


def fit_grammar(docs: DataFrame, labels: DataFrame, max_train_rows: int = 12_000) -> Grammar:
    """Learn from at most ``max_train_rows`` labelled documents outside the held-out fold."""
    rows = spill(labelled_texts(docs, labels, "toxic", max_train_rows).withColumn(
        "fold", F.pmod(F.xxhash64("text"), F.lit(INNER_FOLDS)).cast("int")), "toxicity_sample")
    insults = learn_insults(rows)
    if insults.weights:
        insults = insults.cut_at(choose_cut(rows))
    x, y, _ = measured(rows, [insults])
    if not len(y) or y.min() == y.max():
        return Grammar(insults, np.zeros(4), -30.0)
    weights, intercept = fit_logistic(x[:, 0], y)
    return Grammar(insults, weights, intercept)


def toxicity_scores(docs: DataFrame, labels: DataFrame, grammar: Grammar | None = None, **options) -> DataFrame:
    """Score of every row of ``docs``, with its matched clauses and the strongest of them."""
    grammar = grammar or fit_grammar(docs, labels, **options)

    def apply(batches):
        memo_of("toxicity")
        for batch in column_batches(batches):
            x = np.array([describe(t, grammar.insults) for t in batch.column(1).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grammar.score(x)), pa.array(np.expm1(x[:, 2]).round().astype(np.int64)),
                 pa.array(x[:, 0])], ["doc_id", "score", "clauses", "strongest"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        apply, "doc_id long, score double, clauses long, strongest double")


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    grammar = fit_grammar(docs, labels, **options)
    return keep_rows(docs, lambda texts: grammar.score(
        np.array([describe(t, grammar.insults) for t in texts.to_pylist()]).reshape(-1, 4)) < threshold)
