import math
import zlib

import numpy as np
import pytest
from conftest import prose

from gridclimate.llm.linear import COST, LEAST_TEXTS, calibration, dual_coordinate_descent, frequent_ratios, log_count_ratios
from gridclimate.llm.quality_model import TOKEN, quality, quality_model, word_cells
from gridclimate.llm.toxicity import SPAN, char_cells, toxicity, toxicity_model

SF = "/root/testdata/sf0.01"


def held(doc_id, folds, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == rest


def accuracy(spark, scored, label):
    rows = scored.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    return sum(r["predicted"] == r[label] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic, good = toxicity(docs, labels), quality(docs, labels)
    assert toxic.count() == good.count() == docs.count()
    assert accuracy(spark, toxic, "toxic") >= 0.9 and accuracy(spark, good, "quality") >= 0.93


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    rows = [(i, prose(i, 30) + (" vilest" if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, i % 2, i % 2) for i in range(60)]
    lies = [(i, 1 - t if held(i, 5, 0) else t, q) for i, t, q in labels]
    a, b = (toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int, quality int")).orderBy("doc_id").collect() for x in (labels, lies))
    assert a == b and all(r["predicted"] == r["doc_id"] % 2 for r in a)
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in a)


def test_awkward_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0), (9, 0, 1), (10, None, None), (None, 1, 1), (12, 1, 1), (12, 1, 1), (17, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    for run in (toxicity, quality):
        got = run(odd_docs, labels).collect()
        assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
        assert run(no_docs, labels).collect() == []
        assert all(r["predicted"] == 0 for r in run(odd_docs, labels.where("false")).collect())


def test_long_texts_are_read_whole():
    text = prose(1, 2_000)
    assert set(char_cells(text)) == set(char_cells(text[:1500])) | set(char_cells(text[1496:]))
    assert len(char_cells("ab" * SPAN)) == len(char_cells("ab" * 50))
    assert len(char_cells("")) == len(char_cells("ab")) == len(word_cells("")) == 0


def test_solver_separates():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 1]), np.array([3, 2])]
    labels = np.array([1, 1, 0, 0])
    w = dual_coordinate_descent(rows, [np.ones(2)] * 4, labels, 4, epochs=50)
    assert [(w[r].sum() > 0) == bool(y) for r, y in zip(rows, labels)] == [True] * 4
    assert log_count_ratios(np.array([[9.0, 0.0], [0.0, 9.0]]))[1] > 0


def test_held_out_recall_and_precision_of_toxic(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).where("held_out").join(labels, "doc_id").where("toxic in (0, 1)").select("predicted", "toxic").collect()
    caught = sum(r["predicted"] and r["toxic"] for r in rows)
    assert caught / sum(r["toxic"] for r in rows) >= 0.7 and caught / sum(r["predicted"] for r in rows) >= 0.75


def test_the_half_follows_the_margins():
    margins, labels = np.array([-3.0, -2.5, -2.0, -1.0, -0.8]), np.array([0, 0, 0, 1, 1])
    slope, offset = calibration(margins, labels, (30.0, 2.0))
    assert ((slope * margins + offset > 0) == labels.astype(bool)).all()
    assert frequent_ratios(np.array([[0.0, 0.0], [1.0, 9.0]])).tolist()[0] == 0


def runs_of(text):
    return {int(c) for n in (3, 4, 5) for i in range(len(text) - n + 1) for c in char_cells(text[i:i + n])}


def pairs_of(text):
    tokens = TOKEN.findall(text)
    return {int(c) for i in range(max(len(tokens) - 3, 1)) for c in word_cells(" ".join(tokens[i:i + 4]))}


@pytest.mark.parametrize("run, model, column, cells, folds, rest", [
    (toxicity, toxicity_model, "toxic", runs_of, 5, 0), (quality, quality_model, "quality", pairs_of, 3, 1)])
def test_ratios_weights_and_scores_against_loops(spark, run, model, column, cells, folds, rest):
    texts = {i: prose(i, 12) + (" vilest scum here" if i % 3 == 0 else " kindest words here" if i % 5 else "") for i in range(60)}
    texts |= {60: "", 61: "one", 62: "vilest"}
    own = {i: int(i % 3 == 0) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(own.items()), f"doc_id long, {column} int")
    ratios, weights, slope, offset = model(docs, labels)
    train = [i for i in own if not held(i, folds, rest)]
    sets = {i: cells(t) for i, t in texts.items()}

    counts = {c: [sum(c in sets[i] for i in train if own[i] == label) for label in (0, 1)] for c in set().union(*(sets[i] for i in train))}
    sums = [sum(n[label] for n in counts.values()) + len(ratios) for label in (0, 1)]
    want = {c: math.log((n[1] + 1) / sums[1]) - math.log((n[0] + 1) / sums[0]) if sum(n) >= LEAST_TEXTS else 0.0 for c, n in counts.items()}
    assert all(abs(ratios[c] - r) < 1e-5 for c, r in want.items())

    def vector(i):
        values = {c: want[c] for c in sets[i] if c in want}
        norm = math.sqrt(sum(v * v for v in values.values()))
        return {c: v / norm for c, v in values.items()} if norm else {}

    # the least squared hinge loss, found by plain gradient steps on dense rows
    place = {c: k for k, c in enumerate(sorted(want))}
    x, y = np.zeros((len(train), len(place))), np.array([1.0 if own[i] else -1.0 for i in train])
    for k, i in enumerate(train):
        for c, v in vector(i).items():
            x[k, place[c]] = v
    cost = COST * np.where(y > 0, (y < 0).sum() / (y > 0).sum(), 1.0)
    loss = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    best, step = np.zeros(len(place)), 1 / (1 + 2 * cost.max() * np.linalg.norm(x, 2) ** 2)
    for _ in range(4000):
        best -= step * (best - 2 * x.T @ (cost * y * np.maximum(0, 1 - y * (x @ best))))
    fitted = np.array([float(weights[c]) for c in sorted(want)])
    assert loss(best) <= loss(fitted) * (1 + 1e-6) and loss(fitted) <= loss(best) * 1.02
    assert np.count_nonzero(weights) == np.count_nonzero(fitted)

    got = {r["doc_id"]: r for r in run(docs, labels).collect()}
    assert set(got) == set(texts)
    for i in texts:
        margin = sum(float(weights[c]) * v for c, v in vector(i).items())
        score = 1 / (1 + math.exp(-(slope * margin + offset))) if sets[i] else 0.5
        assert abs(got[i]["score"] - score) < 1e-4 and got[i]["predicted"] == (got[i]["score"] >= 0.5)
