"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Grades come in order 0 < 1 < ... < K - 1.  One weight per feature is shared by
all thresholds: P(grade >= j) = sigmoid(w.x - theta_j), theta increasing.  The
expected severity is the sum of these probabilities over j = 1..K-1, and a
document is flagged if P(grade >= 1) is at least one half.

Features are words (runs of ASCII letters, digits and non-ASCII bytes, lower
case) and their first 4 to 7 bytes, hashed; the value is log(1 + count).  Of
the features of the training sample the ``FEATURES`` with the strongest link
to the grade (likelihood ratio of presence against grade >= 1) are kept, if
it is more than chance gives the best of as many features, and
the weights are fitted by Adam steps, each followed by a shrinkage towards 0.

Training reads at most about ``SAMPLE`` labelled documents of each of the
``MAX_GRADES`` most frequent grades (an expected number, by a hash of the id;
twice that is the bound, cut in the order of the hash, so reruns agree), each
text once, texts of over ``SAMPLE_CHARS`` characters left out; grades weigh as
they occur in all labels.  The chosen ids are broadcast to the documents, so
no text is shuffled.  Labels of only two levels get a third grade: the upper
half of the higher one by the amount of evidence.  Prediction covers every whole text.

Defined results: NULL and empty texts have no feature and get the base rate's
severity; labels that are NULL or whose document is missing teach nothing;
without a label of each of two grades every severity is 0 and nothing is
flagged; rows that share an id are each predicted.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, save, slices
from ticketlens.llm.words import NOT_ALNUM, span_hashes, spans

SAMPLE = 2000
SAMPLE_CHARS = 20_000
MAX_GRADES = 16  # of a dirty grade column the most frequent ones teach
FEATURES = 4096
PREFIXES = (4, 5, 6, 7)
L1 = 0.002
RATE = 0.05
STEPS = 1500
BLOCK_CHARS = 400_000
RESULT_SCHEMA = "doc_id long, grade int, severity double, p_toxic double, toxic boolean"


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # K - 1 of them, increasing
    filter: np.ndarray  # bit per low 16 bits of a kept hash


def hashed_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every occurrence."""
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    starts, ends = spans(NOT_ALNUM[data])
    doc = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, side="right")
    rows, found = [doc], [span_hashes(data, starts, ends)]
    for n in PREFIXES:
        longer = np.flatnonzero(ends - starts > n)
        rows.append(doc[longer])
        found.append(span_hashes(data, starts[longer], starts[longer] + n, n))
    return np.concatenate(rows), np.concatenate(found)


def _known(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature number, value) of the kept features in the texts."""
    n = len(model.features)
    if not texts or not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    doc, feature = hashed_features(texts)
    some = np.flatnonzero(model.filter[(feature & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(model.features, feature[some]), n - 1)
    hit = model.features[at] == feature[some]
    cell, count = np.unique(doc[some[hit]] * n + at[hit], return_counts=True)
    return cell // n, cell % n, np.log1p(count)


def select_features(texts: list[str], positive: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` features whose presence tells most about ``positive`` (G statistic)."""
    hashes, owners = [], []
    for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
        doc, feature = hashed_features(texts[a:b])
        pair = np.unique(np.stack([feature, (doc + a).astype(np.uint64)]), axis=1)
        hashes.append(pair[0])
        owners.append(pair[1].astype(np.int64))
    feature, doc = np.concatenate(hashes), np.concatenate(owners)
    names, at = np.unique(feature, return_inverse=True)
    n, n1 = len(texts), float(positive.sum())
    with1 = np.bincount(at, positive[doc].astype(float), len(names))
    having = np.bincount(at, minlength=len(names)).astype(float)
    gain = np.zeros(len(names))
    for seen, share in (
        (with1, having * n1 / n), (having - with1, having * (n - n1) / n),
        (n1 - with1, (n - having) * n1 / n), (n - n1 - having + with1, (n - having) * (n - n1) / n),
    ):
        gain += 2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(share, 1e-12))
    gain[having < 3] = 0
    best = np.lexsort((names, -gain))[:size]
    # a gain that chance alone would hardly give to any of the features
    return np.sort(names[best[gain[best] > 2 * np.log(len(names) + 1.0) + 2]])


def objective(
    w: np.ndarray, theta: np.ndarray, cells: tuple[np.ndarray, np.ndarray, np.ndarray], share: np.ndarray, target: np.ndarray
) -> tuple[float, np.ndarray]:
    """Loss and its gradient by (w, theta): minus the weighted log-likelihood of every threshold's answer.

    ``cells`` are (text number, feature number, value), ``target`` has a row
    per threshold telling which texts lie above it.
    """
    doc, col, val = cells
    n, d = len(share), len(w)
    score = np.bincount(doc, val * w[col], n) if d else np.zeros(n)
    z = np.clip(score[None, :] - theta[:, None], -60, 60)
    p = 1 / (1 + np.exp(-z))
    error = share * (p - target)
    on_w = np.bincount(col, val * error.sum(axis=0)[doc], d) if d else np.zeros(0)
    loss = float((share * (np.logaddexp(0, z) - target * z)).sum())
    return loss, np.concatenate([on_w, -error.sum(axis=1)])


def fit(texts: list[str], grades: np.ndarray, weight: np.ndarray, size: int = FEATURES, l1: float = L1, steps: int = STEPS) -> Model:
    """Weights and thresholds from texts, their grades 0..K-1 and sample weights."""
    k = int(grades.max()) + 1
    model = Model(select_features(texts, grades > 0, size), np.zeros(0), np.zeros(k - 1), np.zeros(1 << 16, dtype=bool))
    model.filter[(model.features & np.uint64(0xFFFF)).astype(np.int64)] = True
    n, d = len(texts), len(model.features)
    doc, col, val = (np.concatenate(x) for x in zip(*[_known_from(model, texts, a, b) for a, b in slices([len(t) for t in texts], BLOCK_CHARS)]))
    share = weight / weight.sum()
    above = np.array([(share * (grades >= j)).sum() for j in range(1, k)])
    theta = -np.log(np.clip(above, 1e-9, 1 - 1e-9) / np.clip(1 - above, 1e-9, 1))
    w = np.zeros(d)
    # one weighted logistic loss per threshold, all on the same weights (Adam steps)
    target = np.stack([grades >= j for j in range(1, k)]).astype(float)
    m, v = np.zeros(d + k - 1), np.zeros(d + k - 1)
    for t in range(1, steps + 1):
        _, gradient = objective(w, theta, (doc, col, val), share, target)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w = w - move[:d]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        theta = np.maximum.accumulate(theta - move[d:])
    model.weights, model.thresholds = w, theta
    return model


def split_top_grade(texts: list[str], grades: np.ndarray) -> np.ndarray:
    """Labels of two levels as three grades: the upper half of grade 1, by the evidence in the text, is grade 2.

    Evidence is the number of words with a feature that is more frequent in
    grade 1 (of the features ``select_features`` keeps).
    """
    probe = Model(select_features(texts, grades > 0, FEATURES), np.zeros(0), np.zeros(1), np.zeros(1 << 16, dtype=bool))
    probe.filter[(probe.features & np.uint64(0xFFFF)).astype(np.int64)] = True
    doc, col, val = (np.concatenate(x) for x in zip(*[_known_from(probe, texts, a, b) for a, b in slices([len(t) for t in texts], BLOCK_CHARS)]))
    d = len(probe.features)
    share1 = np.bincount(col, (grades[doc] > 0).astype(float), d) / max(1, (grades > 0).sum())
    share0 = np.bincount(col, (grades[doc] == 0).astype(float), d) / max(1, (grades == 0).sum())
    evidence = np.bincount(doc, np.expm1(val) * (share1 > share0)[col], len(texts)) if d else np.zeros(len(texts))
    top = evidence >= np.median(evidence[grades > 0])
    return np.where((grades > 0) & top & (evidence > 0), 2, grades)


def _known_from(model: Model, texts: list[str], a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, col, val = _known(model, texts[a:b])
    return doc + a, col, val


def predict(model: Model, texts: list[str]) -> np.ndarray:
    """P(grade >= j) for j = 1..K-1, one row per text."""
    doc, col, val = _known(model, texts)
    score = np.bincount(doc, val * model.weights[col], len(texts)) if len(col) else np.zeros(len(texts))
    return 1 / (1 + np.exp(-np.clip(score[:, None] - model.thresholds[None, :], -60, 60)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    sample_chars: int = SAMPLE_CHARS,
) -> Model | None:
    """Fit on a bounded sample of labelled documents; ``grade`` is a whole number over ``labels``."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), grade.cast("int").alias("grade"))
    known = known.where(F.col("id").isNotNull() & (F.col("grade") >= 0))
    counted = known.groupBy("grade").count().orderBy(F.desc("count"), "grade").limit(MAX_GRADES).collect()
    sizes = {r["grade"]: r["count"] for r in counted}
    if len(sizes) < 2:
        return None
    bound = 2 * sample * len(sizes)
    rank = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for g, n in sorted(sizes.items()):
        chosen = chosen | ((F.col("grade") == g) & (rank < int(min(1.0, sample / n) * (1 << 30)) + 1))
    # the ids go to the texts, at most ``bound`` of them; what a bound cuts is last in rank
    picked = known.where(chosen).distinct().withColumn("rank", rank).orderBy("rank", "id", "grade").limit(bound)
    picked = F.broadcast(save(picked, "toxicity-sample"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.length("text").between(1, sample_chars))
    rows = texts.join(picked, "id").orderBy("rank", "id", F.xxhash64("text"), "grade").limit(bound).collect()
    once = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["text"], r["grade"])):
        once.setdefault(r["text"], r["grade"])
    levels = sorted(set(once.values()))
    if len(levels) < 2:
        return None
    grades = np.array([levels.index(g) for g in once.values()])
    drawn = np.bincount(grades, minlength=len(levels))
    weight = np.array([sizes[g] for g in levels])[grades] / drawn[grades]
    if len(levels) == 2:
        grades = split_top_grade(list(once), grades)
    return fit(list(once), grades, weight)


def grade_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, grade (most thresholds passed at one half), severity, p_toxic, toxic of every row."""
    spark = docs.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by FEATURES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = [np.zeros((0, 1))]
            if shared.value is None:
                rows = [np.zeros((len(texts), 1))]
            else:
                rows = [predict(shared.value, texts[a:b]) for a, b in slices([len(t) for t in texts], BLOCK_CHARS)] or rows
            p = np.concatenate(rows)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array((p >= 0.5).sum(axis=1), pa.int32()),
                    pa.array(p.sum(axis=1)),
                    pa.array(p[:, 0]),
                    pa.array(p[:, 0] >= 0.5),
                ],
                ["doc_id", "grade", "severity", "p_toxic", "toxic"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT_SCHEMA)
