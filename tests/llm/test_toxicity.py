"""Toxicity: held-out recall and precision, ordered grades, edge rows."""

import numpy as np
from conftest import plan_text
from llm_fixtures import edge_docs, edge_rows, no_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from ticketlens.llm import toxicity
from ticketlens.llm.toxicity import fit, grade_documents, predict, split_top_grade, train

MILD, SEVERE = "vexbad vexsad".split(), "vexawful vexvile".split()


def made(n, seed=0):
    rs = np.random.RandomState(seed)
    texts, grades = [], []
    for i in range(n):
        g = rs.choice([0, 0, 1, 2])
        words = prose(seed * 10_000 + i, rs.randint(10, 80)).split()
        for _ in range(g * 3):
            words.insert(rs.randint(0, len(words)), rs.choice(MILD if g == 1 else SEVERE))
        texts.append(" ".join(words))
        grades.append(g)
    return texts, np.array(grades)


def test_held_out_grades():
    texts, grades = made(600)
    model = fit(texts, grades, np.ones(len(texts)))
    assert (np.diff(model.thresholds) >= 0).all()
    new, truth = made(300, 1)
    p = predict(model, new)
    assert (p[:, 0] >= p[:, 1]).all()  # ordered thresholds on one score
    assert ((p[:, 0] >= 0.5) == (truth > 0)).mean() > 0.97
    severity = p.sum(axis=1)
    assert severity[truth == 0].mean() < severity[truth == 1].mean() < severity[truth == 2].mean()


def test_whole_texts_count():
    texts, grades = made(600)
    model = fit(texts, grades, np.ones(len(texts)))
    late = prose(3, 3000) + " " + " ".join(SEVERE * 4)
    assert predict(model, [late, prose(3, 3000)])[:, 0].round().tolist() == [1, 0]


def test_two_levels_are_split_by_evidence():
    texts, grades = made(400)
    three = split_top_grade(texts, (grades > 0).astype(int))
    assert set(three) == {0, 1, 2} and ((three > 0) == (grades > 0)).all()


def test_documents_with_labels(spark):
    texts, grades = made(400)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g > 0)) for i, g in enumerate(grades) if i % 2], "doc_id long, toxic int")
    rows = grade_documents(docs, train(docs, labels, F.col("toxic"))).collect()
    right = [r["toxic"] == bool(grades[r["doc_id"]] > 0) for r in rows if r["doc_id"] % 2 == 0]
    assert np.mean(right) > 0.95
    assert all(0 <= r["severity"] <= 2 and r["grade"] in (0, 1, 2) for r in rows)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (20, 0), (None, 1), (21, None), (999, 0)], "doc_id long, toxic int")
    model = train(edge_docs, labels, F.col("toxic"))
    rows = grade_documents(edge_docs, model).collect()
    assert len(rows) == len(edge_rows)
    assert {r["severity"] for r in rows if r["doc_id"] in (4, 5, 6)} == {[r for r in rows if r["doc_id"] == 4][0]["severity"]}
    none = train(edge_docs, labels.where("doc_id > 1000"), F.col("toxic"))
    assert none is None
    assert {(r["severity"], r["toxic"]) for r in grade_documents(edge_docs, none).collect()} == {(0.0, False)}
    assert grade_documents(no_docs, model).collect() == []


def test_gradient_of_the_objective():
    rs = np.random.RandomState(2)
    n, d, k = 30, 7, 4
    cells = rs.randint(0, n, 90), rs.randint(0, d, 90), rs.rand(90)
    share = rs.rand(n)
    grades = rs.randint(0, k, n)
    target = np.stack([grades >= j for j in range(1, k)]).astype(float)
    w, theta = rs.randn(d), np.sort(rs.randn(k - 1))
    _, gradient = toxicity.objective(w, theta, cells, share, target)
    point = np.concatenate([w, theta])
    for i in range(d + k - 1):
        step = np.zeros(d + k - 1)
        step[i] = 1e-5
        up, down = (toxicity.objective((point + s)[:d], (point + s)[d:], cells, share, target)[0] for s in (step, -step))
        assert abs((up - down) / 2e-5 - gradient[i]) < 1e-6


def test_steps_lower_the_objective():
    """The fitted weights beat the base rate alone."""
    texts, grades = made(200)
    fitted, start = fit(texts, grades, np.ones(len(texts))), fit(texts, grades, np.ones(len(texts)), steps=0)
    truth = np.stack([grades >= 1, grades >= 2], axis=1)
    loss = [-np.log(np.where(truth, p, 1 - p)).mean() for p in (predict(fitted, texts), predict(start, texts))]
    assert loss[0] < 0.3 * loss[1]


def test_labelled_texts_are_picked_without_a_shuffle_of_texts(spark, monkeypatch):
    """The chosen ids are broadcast; texts leave their partition only when they are among the bounded sample."""
    texts, grades = made(200)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades)], "doc_id long, toxic int")
    frame = type(docs)
    plans, real = [], frame.collect

    def collect(self):
        plans.append(plan_text(self))
        return real(self)

    monkeypatch.setattr(frame, "collect", collect)
    train(docs, labels, F.col("toxic"))
    picking = [p for p in plans if "text" in p]
    assert len(picking) == 1 and "BroadcastHashJoin" in picking[0] and "TakeOrderedAndProject" in picking[0]
    assert "SortMergeJoin" not in picking[0] and "Exchange hashpartitioning" not in picking[0]


def test_sample_is_bounded_and_the_same_each_time(spark):
    """A hot label id and many repeated documents can't grow the sample, and reruns draw the same rows."""
    texts, grades = made(120)
    docs = spark.createDataFrame([(i % 40, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades[:40])] + [(3, int(grades[3]))] * 300, "doc_id long, toxic int")
    a, b = (train(d, labels, F.col("toxic"), sample=10) for d in (docs, docs.repartition(7)))
    assert (a.features == b.features).all() and (a.weights == b.weights).all()


def test_dirty_grades_do_not_reach_the_driver(spark, monkeypatch):
    texts, _ = made(60)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MAX_GRADES", 5)
    assert len(train(docs, labels, F.col("toxic")).thresholds) == 4
