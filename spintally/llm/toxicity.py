"""Toxicity as ordinal regression with cumulative links.

Features are words and the beginnings of longer words, lower-cased. Those that occur
more often in documents labelled toxic than chance allows are kept; a document's value
is ``log(1 + occurrences)``. The labels say toxic or not; the grades among the toxic
come from how often such features stand in them: the labelled toxic documents are
cut into equal parts by that number. One set of weights serves all thresholds,

    P(grade > k) = sigmoid(score - threshold_k),   threshold_0 < threshold_1 < ...

and the output is the expected grade. A document is rejected if it is more likely
toxic than not.

The model is fitted on at most ``max_labelled`` labelled documents (those with the
smallest hash of their id), a bound that does not depend on the corpus; scoring reads
all documents in full. All features of these documents with a significant excess are
used, so the documents bound their number. Where several texts share a labelled id, the
model is fitted on the greatest of them in string order, and all are scored.

Defined results: null, empty and blank texts have no features and get the base
severity; repeated rows are scored alike; without toxic labels nothing is rejected
(severity zero); an empty table gives an empty result; kept columns named like a new one
give way to it. Texts are scored whole, a few MB at a time and one text at least.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.llm.ragged import Memo
from spintally.llm.rows import map_texts
from spintally.llm.tables import saved

#: Grades above zero.
GRADES = 3
MAX_LABELLED = 20_000
MIN_TOXIC_DOCS = 3
#: Least standard score of a feature's excess among toxic documents.
MIN_EXCESS = 5.0
PREFIXES = (4, 5, 6)
WORD = regex.compile(r"[^\W\d_]+")
MEMO_WORDS = 200_000


def features_of(word: str) -> list[str]:
    """A word and its beginnings (marked by a dash) as features."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def word_features(self, word: str) -> list[str]:
        return [f for f in features_of(word) if f in self.weights]


def occurrences(text: str, known, memo: dict) -> dict[str, int]:
    """How often each known feature occurs; ``memo`` holds words seen before."""
    out: dict[str, int] = {}
    for word in WORD.findall(text.lower()):
        own = memo.get(word)
        if own is None:
            own = memo[word] = [f for f in features_of(word) if f in known]
        for feature in own:
            out[feature] = out.get(feature, 0) + 1
    return out


def labelled_sample(docs, labels, id_col, text_col, toxic_col, max_labelled) -> DataFrame:
    """``text`` and ``toxic`` of a bounded number of labelled documents, one per id."""
    marked = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max(F.col(f"`{toxic_col}`").cast("int")).alias("toxic")
    )
    marked = marked.filter("id is not null and toxic is not null")
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # max_labelled narrow rows at most; copies of an id shrink to one text before the shuffle
    found = own.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.max("text").alias("text"), F.max("toxic").alias("toxic")
    )
    return saved(found.select("text", "toxic"))


def associated(sample: DataFrame, n_clean: int, n_toxic: int) -> list[str]:
    """Features with a significant excess in toxic documents of the bounded sample, in order."""

    kind = pa.list_(pa.string())

    def compute(texts):
        words = (set(WORD.findall(text.lower())) for text in texts)
        return [pa.array([list({f for w in own for f in features_of(w)}) for own in words], kind)]

    counted = (
        map_texts(sample, compute, "features array<string>", "text", ["toxic"])
        .select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("in_toxic"), F.count("*").alias("in_all"))
        .filter(F.col("in_toxic") >= MIN_TOXIC_DOCS)
    )
    share = n_toxic / (n_toxic + n_clean)
    expected = F.col("in_all") * share
    excess = (F.col("in_toxic") - expected) / F.sqrt(expected * (1 - share))
    strong = counted.filter(excess >= MIN_EXCESS).select("feature")
    return sorted(r.feature for r in strong.collect())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    grades: int = GRADES,
    max_labelled: int = MAX_LABELLED,
) -> Model:
    sample = labelled_sample(docs, labels, id_col, text_col, toxic_col, max_labelled)
    counted = sample.groupBy(F.col("toxic") > 0).count().collect()
    sizes = dict(map(tuple, counted))
    if not sizes.get(True) or not sizes.get(False):
        return Model({}, (30.0,) * grades)
    names = associated(sample, sizes[False], sizes[True])
    held = sample.sparkSession.sparkContext.broadcast({name: i for i, name in enumerate(names)})
    memo = Memo(MEMO_WORDS)

    def compute(texts):
        known = held.value
        rows = [occurrences(text, known, memo) for text in texts]
        return [
            pa.array([[known[f] for f in row] for row in rows], pa.list_(pa.int32())),
            pa.array([list(row.values()) for row in rows], pa.list_(pa.int32())),
        ]

    fields = "place array<int>, times array<int>"
    rows = map_texts(sample, compute, fields, "text", ["toxic"]).collect()  # max_labelled at most
    toxic = np.array([r.toxic > 0 for r in rows])
    which = np.repeat(np.arange(len(rows)), [len(r.place) for r in rows])
    place = np.array([p for r in rows for p in r.place], np.int64)
    times = np.array([t for r in rows for t in r.times], float)
    target = np.where(toxic, grade_of(np.bincount(which, times, len(rows)), toxic, grades), 0)
    weights, thresholds = cumulative_link(which, place, np.log1p(times), target, len(names), grades)
    kept = {name: float(w) for name, w in zip(names, weights) if abs(w) > 1e-4}
    return Model(kept, tuple(thresholds.tolist()))


def grade_of(evidence: np.ndarray, toxic: np.ndarray, grades: int) -> np.ndarray:
    """Grade 1 to ``grades`` by the evidence's place among the toxic documents."""
    cuts = np.quantile(evidence[toxic], np.arange(1, grades) / grades)
    return 1 + np.searchsorted(cuts, evidence, "left")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def cumulative_link(
    which: np.ndarray,
    place: np.ndarray,
    value: np.ndarray,
    target: np.ndarray,
    n_features: int,
    grades: int,
    ridge: float = 0.1,
    steps: int = 600,
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of the most likely model, by Adam.

    Thresholds are a first one and positive steps, so their order cannot break.
    """
    n = len(target)
    free = np.zeros(n_features + grades)
    free[n_features] = 1.0
    momentum, scale = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, steps + 1):
        weights, first, steps_up = free[:n_features], free[n_features], np.exp(free[n_features + 1 :])
        thresholds = first + np.append(0, np.cumsum(steps_up))
        score = np.bincount(which, weights[place] * value, n)
        above = np.ones((n, grades + 2))
        above[:, 1:-1] = sigmoid(score[:, None] - thresholds[None, :])
        above[:, -1] = 0
        slope = above * (1 - above)
        rows = np.arange(n)
        chance = np.maximum(above[rows, target] - above[rows, target + 1], 1e-9)
        by_score = (slope[rows, target] - slope[rows, target + 1]) / chance
        by_threshold = np.zeros(grades)
        for k in range(grades):
            own = slope[:, k + 1] / chance
            by_threshold[k] = own[target == k].sum() - own[target == k + 1].sum()
        gradient = np.empty_like(free)
        gradient[:n_features] = np.bincount(place, by_score[which] * value, n_features) - ridge * weights
        gradient[n_features] = by_threshold.sum()
        behind = np.cumsum(by_threshold[::-1])[::-1]
        gradient[n_features + 1 :] = behind[1:] * steps_up
        momentum = 0.9 * momentum + 0.1 * gradient
        scale = 0.999 * scale + 0.001 * gradient**2
        rate = 0.05 / (1 + step / 200)
        free = free + rate * (momentum / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8)
        # every feature was kept for its excess in toxic documents, so none speaks against it
        free[:n_features] = np.maximum(free[:n_features], 0)
    steps_up = np.exp(free[n_features + 1 :])
    return free[:n_features], free[n_features] + np.append(0, np.cumsum(steps_up))


def score(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and the verdict, one row per input row.

    ``severity`` is the expected grade, ``grade`` the likeliest one, ``p_toxic`` the chance of
    any grade above zero, ``rejected`` whether that is over one half.
    """
    held, memo = docs.sparkSession.sparkContext.broadcast(model), Memo(MEMO_WORDS)

    def compute(texts):  # every task has a memo of its own
        own = held.value
        scores = np.zeros(len(texts))
        for row, text in enumerate(texts):
            found = occurrences(text, own.weights, memo)
            scores[row] = sum(own.weights[f] * np.log1p(n) for f, n in found.items())
        above = sigmoid(scores[:, None] - np.array(own.thresholds)[None, :])
        edges = np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], axis=1)
        grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)
        return [
            pa.array(above.sum(axis=1)),
            pa.array(grade, pa.int32()),
            pa.array(above[:, 0]),
            pa.array(above[:, 0] > 0.5),
        ]

    fields = "severity double, grade int, p_toxic double, rejected boolean"
    return map_texts(docs, compute, fields, text_col, keep)
