"""Toxicity by weak supervision.

Voters are lexicon entries (words) and patterns (word beginnings) that the labelled rows of the training folds make
likely: each votes for toxic where it occurs and abstains elsewhere. Those that vote alike in all rows (a word and its
beginnings, say) are one voter. There is no limit on their number: a voter stays if some toxic row has fewer than two stronger
ones, so the lexicon grows with the evidence, and no language's or subject's words are crowded out by another's. (Keeping
more per row lets in words that are frequent by chance: with three, one clean document in a thousand is taken for toxic.)

A generative label model then looks at the votes alone: it estimates each voter's accuracy, and from the correlations that
are left among the rows taken for toxic, which voters say the same thing twice; a voter's evidence is divided by how often
others repeat it. Its posterior labels train a linear classifier over the voters, which scores whole texts.

Training uses a bounded sample of labelled rows (``labelled_rows``, chosen by a hash of the id); scoring covers every
row in one pass without any exchange. Labels are used only of rows outside the held-out fold.

Defined results: a null or empty text has no vote and gets the base score; repeated rows and null ids are scored like
any others; a row without label is only scored; an empty label table leaves no voters, and every score is the prior's.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import python_tasks
from rollkeep.llm.encoders import forget, tidy

TWINS = 0.8  # voters more correlated than this are taken for the same evidence
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class WeakLabels:
    """``labelled_rows``: most labelled rows that are used. ``cover``: a voter stays if a toxic row has fewer stronger ones.
    ``beginnings``: lengths of the word beginnings that are patterns. ``evidence``: a voter's log ratio must stay above this
    when two standard errors less. ``threshold``: a document is toxic from this score on."""

    labelled_rows: int = 20_000
    cover: int = 2
    beginnings: tuple[int, ...] = (4, 5, 6)
    evidence: float = 1.0
    rounds: int = 30
    ridge: float = 0.05
    threshold: float = 0.7
    folds: int = 3
    held_out: int = 1


@dataclass(frozen=True)
class Model:
    """Weights of voters, and the voter of each feature; a beginning is its letters with a star."""

    weights: dict[str, float]
    bias: float
    beginnings: tuple[int, ...]
    voters: dict[str, str]

    def votes(self, text: str) -> set[str]:
        return {self.voters[f] for f in features(text, self.beginnings, self.voters)}

    def score(self, text: str) -> float:
        logit = self.bias + math.fsum(self.weights[v] for v in self.votes(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def features(text: str, beginnings: tuple[int, ...], wanted=None) -> set[str]:
    """Words of a text and beginnings of longer words, all of them or those wanted."""
    words = set(WORD.findall(text.lower()))
    found = words if wanted is None else {w for w in words if w in wanted}
    for n in beginnings:
        starts = {w[:n] + "*" for w in words if len(w) > n}
        found = found | (starts if wanted is None else {s for s in starts if s in wanted})
    return found


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, rules: WeakLabels, key: str, text: str, label: str) -> DataFrame:
    """doc_id, text and label of at most ``labelled_rows`` ids, none of them held out.

    A text counts once, with the smallest of its ids, and as toxic if any of its rows is: else every word of a text that was
    copied a few times would look like evidence.
    """
    marked = labels.select(F.col(key).cast("long").alias("labelled"), F.col(label).cast("int").alias("y"))
    marked = marked.where((fold(F.col("labelled"), rules.folds) != rules.held_out) & F.col("y").isin(0, 1))
    sample = marked.groupBy("labelled").agg(F.max("y").alias("y")).orderBy(F.xxhash64("labelled"), "labelled").limit(rules.labelled_rows)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # The sample has at most so many rows of two numbers.
    labelled = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
    return labelled.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y")).select("doc_id", "text", "y")


def mined(rows: DataFrame, rules: WeakLabels) -> tuple[list[tuple[str, int, int]], int, int]:
    """The likely features, strongest first, with the number of toxic and of clean rows they occur in, and the numbers of such
    rows. The sample's words bound how many there are."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                (toxic if y else clean).update(features(text, rules.beginnings))
                (toxic if y else clean)[""] += 1
            if len(toxic) + len(clean) > 100_000:
                yield _counted(toxic, clean)
                toxic, clean = Counter(), Counter()
        if toxic or clean:
            yield _counted(toxic, clean)

    counts = rows.select("text", "y").mapInPandas(tidy(count), "feature string, t long, c long")
    sums = counts.groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 3").persist()
    try:
        total = sums.where("feature = ''").first()
        n_toxic = int(total["t"]) if total else 0
        n_clean = int(total["c"]) if total else 0
        ratio = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
        error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
        likely = sums.where((F.col("feature") != "") & (ratio - 2 * error > rules.evidence))
        best = likely.orderBy(F.desc(ratio - 2 * error), "feature").collect()
    finally:
        sums.unpersist()
    return [(r["feature"], r["t"], r["c"]) for r in best], n_toxic, n_clean


def _counted(toxic: Counter, clean: Counter) -> pd.DataFrame:
    names = list(toxic.keys() | clean.keys())
    return pd.DataFrame({"feature": names, "t": [toxic[n] for n in names], "c": [clean[n] for n in names]})


def voted(rows: DataFrame, names: list[str], rules: WeakLabels) -> tuple[list[list[int]], np.ndarray]:
    """The features that occur in each training row, as places in ``names``, and whether the row is toxic; at most
    ``labelled_rows`` rows."""
    place = {v: i for i, v in enumerate(names)}

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(place[v] for v in features(t, rules.beginnings, place)) for t in batch["text"]]
            if found:
                yield pd.DataFrame({"votes": found, "y": batch["y"].to_numpy()})

    found = rows.select("text", "y").mapInPandas(tidy(vote), "votes array<int>, y int").limit(rules.labelled_rows).collect()
    return [row["votes"] for row in found], np.array([row["y"] for row in found], dtype=bool)


def chosen_voters(found: list[list[int]], toxic: np.ndarray, count: int, cover: int) -> tuple[list[int], np.ndarray]:
    """The features that stand for a voter, in order, and of each feature the place of its voter among them, or -1.

    ``found`` has the features of each row by strength. Features that occur in the same rows are one voter, which the
    strongest of them stands for; of the voters, those stay that some toxic row has fewer than ``cover`` stronger ones of.
    """
    rows_of: list[list[int]] = [[] for _ in range(count)]
    for row, listed in enumerate(found):
        for feature in listed:
            rows_of[feature].append(row)
    first: dict[tuple[int, ...], int] = {}
    kept, voter, covered = [], np.full(count, -1), np.zeros(len(found), dtype=np.int64)
    for feature, rows in enumerate(rows_of):
        same = tuple(rows)
        if same in first:
            voter[feature] = voter[first[same]]
            continue
        first[same] = feature
        hit = [row for row in rows if toxic[row]]
        if hit and covered[hit].min() < cover:
            covered[hit] += 1
            voter[feature] = len(kept)
            kept.append(feature)
    return kept, voter


def matrix(found: list[list[int]], voter: np.ndarray, count: int) -> np.ndarray:
    """The votes as zeros and ones."""
    out = np.zeros((len(found), count), dtype=np.float32)
    for i, listed in enumerate(found):
        places = voter[listed]
        out[i, places[places >= 0]] = 1
    return out


def label_model(votes: np.ndarray, guess: np.ndarray, prior: float, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxic for each row, each voter's accuracy and its independence, by expectation maximisation.

    ``guess``: first accuracies (of the rows in which a voter fires, the share that is toxic); each counts as ten rows.
    A voter that fires moves a row's log odds from the prior's towards its accuracy's.
    Voters that fire together in the rows taken for toxic, beyond what their rates explain, share their evidence.
    """
    n, _ = votes.shape
    odds = math.log(prior / (1 - prior))
    accuracy, independence = np.clip(guess, 0.02, 0.995), np.ones(len(guess))
    posterior = np.full(n, prior)
    for _ in range(rounds):
        after = votes @ (independence * (np.log(accuracy / (1 - accuracy)) - odds)) + odds
        after = 1 / (1 + np.exp(-np.clip(after, -30, 30)))
        change, posterior = np.abs(after - posterior).max() if n else 0, after
        accuracy = np.clip((posterior @ votes + 10 * guess) / (votes.sum(axis=0) + 10), 0.02, 0.995)
        inner = votes - (posterior @ votes) / max(posterior.sum(), 1e-6)
        held = (inner * posterior[:, None]).T @ inner
        scale = np.sqrt(np.maximum(np.diag(held), 1e-9))
        same = held / np.outer(scale, scale)
        np.fill_diagonal(same, 0)
        independence = 1 / (1 + np.where(same > TWINS, same, 0).sum(axis=1))
        if change < 1e-4:
            break
    return posterior, accuracy, independence


def linear(votes: np.ndarray, target: np.ndarray, ridge: float, steps: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by damped Newton steps."""
    n, m = votes.shape
    x = np.hstack([votes, np.ones((n, 1), dtype=votes.dtype)]).astype(np.float64)
    w, penalty = np.zeros(m + 1), np.full(m + 1, ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rules: WeakLabels = WeakLabels(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    python_tasks(docs.sparkSession, 256)
    rows = training_rows(docs, labels, rules, key, text, label)
    voters, n_toxic, n_clean = mined(rows, rules)
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    if not voters:
        return Model({}, math.log(prior / (1 - prior)), rules.beginnings, {})
    names = [v for v, _, _ in voters]
    found, toxic = voted(rows, names, rules)
    kept, voter = chosen_voters(found, toxic, len(names), rules.cover)
    votes = matrix(found, voter, len(kept))
    guess = np.array([(voters[k][1] + 0.5) / (voters[k][1] + voters[k][2] + 1) for k in kept])
    posterior, _, _ = label_model(votes, guess, prior, rules.rounds)
    weights, bias = linear(votes, posterior, rules.ridge)
    named = {name: names[kept[voter[i]]] for i, name in enumerate(names) if voter[i] >= 0}
    return Model({names[k]: float(w) for k, w in zip(kept, weights)}, bias, rules.beginnings, named)


def score(docs: DataFrame, model: Model, rules: WeakLabels = WeakLabels(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    python_tasks(docs.sparkSession, 256)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "held_out"]].assign(score=[model.score(t) for t in batch["text"]])

    held = F.coalesce(fold(F.col(key), rules.folds) == rules.held_out, F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    scored = rows.mapInPandas(tidy(run), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= rules.threshold).cast("int"))


def scores_of(model: Model):
    """The score of a text as a column function, for use beside a row's other columns."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        forget()
        return values.map(lambda t: model.score(t or "")).astype("float64")

    return run
