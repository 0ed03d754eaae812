import collections
import math

import pytest
from conftest import prose
from test_decontaminate import brute as contaminated
from test_near_dedup import brute as components

import corpus_pipeline
from gridclimate.llm import lm_score
from gridclimate.llm.lm_score import backoff_scores
from gridclimate.llm.workload import QUERIES


def brute_scores(rows, order, cutoff=2):
    docs = [(i, [w.lower() for w in (t or "").encode().split()]) for i, t in rows]
    counts = collections.Counter(tuple(w[k:k + n]) for _, w in docs for n in range(1, order + 1) for k in range(len(w) - n + 1))
    total = sum(len(w) for _, w in docs)

    def score(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= cutoff:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(0.4) + score(gram[1:])

    return [(i, len(w), sum(score(tuple(w[max(0, k - order + 1):k + 1])) for k in range(len(w))) / len(w) if w else None) for i, w in docs]


@pytest.mark.parametrize("order", [2, 3])
def test_scores(odd_docs, order):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = backoff_scores(odd_docs, order, cutoff=2).collect()
    shape = lambda rows: sorted((repr(i), n, round(s, 9) if s is not None else -1e9) for i, n, s in rows)
    assert shape(map(tuple, got)) == shape(brute_scores(rows, order))


@pytest.mark.parametrize("name, order, cutoff", [("op10_lm_score", 3, 1), ("op10_lm_score_order3", 3, 1), ("op10_lm_score_order2", 2, 2)])
def test_registered_scores(spark, tmp_path, name, order, cutoff):
    rows = [(1, prose(1, 60)), (2, prose(1, 40) + " once only"), (3, prose(3, 30)), (4, None), (5, "one two")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    want = brute_scores(rows, order, cutoff)
    assert len(got) == len(want)
    for i, n, score in want:
        assert got[i][0] == n and (got[i][1] is None if score is None else abs(got[i][1] - score) < 2e-6)


def test_wide_counts_give_the_same_scores(odd_docs, monkeypatch):
    assert lm_score._count_type(2**32 - 1) == "<u4" and lm_score._count_type(2**32) == "<u8"
    narrow = sorted(map(repr, backoff_scores(odd_docs, order=3, cutoff=1).collect()))
    monkeypatch.setattr(lm_score, "_count_type", lambda words: "<u8")
    assert sorted(map(repr, backoff_scores(odd_docs, order=3, cutoff=1).collect())) == narrow


def test_empty(no_docs):
    assert backoff_scores(no_docs).collect() == []


def test_stages_against_brute_force(spark, tmp_path):
    """Toxic and poor documents go, one of each group stays, contaminated ones go, the rest is packed whole."""
    sf = str(tmp_path)
    bench = prose(900, 40)
    rows, labels = [], []
    for i in range(80):
        toxic, poor = i % 4 == 1, i % 4 == 2
        text = prose(i, 60)
        text = text + " vilest vilewort" if toxic else " ".join(f"{w}&&&" for w in text.split()) if poor else text
        rows.append((i, text))
        labels.append((i, int(not poor), int(toxic)))
    clean = prose(0, 60)
    rows += [(100, clean), (101, clean + " tail"), (102, bench), (103, prose(103, 50)), (103, prose(103, 50)), (104, prose(104, 200) + " " + " ".join(bench.split()[:12])), (None, prose(105, 40))]
    spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert not any("vile" in t for _, t in kept["toxicity"]) and len(kept["toxicity"]) == len(rows) - 20
    assert not any("&&&" in t for _, t in kept["quality classifier"]) and len(kept["quality classifier"]) == len(rows) - 40
    before = sorted(set(kept["quality classifier"]), key=repr)
    assert kept["near-dedup"] == [r for r, c in zip(before, components(before, 5)) if c[2] == r[0]]
    assert kept["decontamination"] == [r for r, c in zip(kept["near-dedup"], contaminated(kept["near-dedup"], [(1, bench)])) if not c[5]]
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert sum(r["length"] for r in pieces if r["start"] == 0) and {r["doc_id"] for r in pieces} == {i for i, _ in kept["decontamination"]}
    assert corpus_pipeline.STAGES[3][1](spark, docs.where("false"), sf).collect() == []


def test_one_row_of_each_group_stays(spark):
    """Near copies under one id and without an id, repeated rows, null and empty texts."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    near = a.replace(a.split()[0], "other", 1)
    rows = [(1, a), (1, near), (None, a), (None, a), (None, near), (5, b), (4, b), (4, b), (None, c), (None, c), (-3, prose(9, 30)), (2, prose(9, 30)), (7, None), (7, None), (8, None), (9, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "clash", "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, node string, hash string")
    got = corpus_pipeline.STAGES[2][1](spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    first = [x for x in kept if x[1] in (a, near)]
    assert len(first) == 1 and first[0][0] == 1  # one row for the whole group
    assert sorted([x for x in kept if x[1] not in (a, near)], key=repr) == sorted([(4, b), (None, c), (-3, prose(9, 30)), (7, None), (8, None), (9, ""), (None, None)], key=repr)


def test_stages_on_nothing_and_on_null_texts(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.createDataFrame([(1, None, "clash"), (2, "", "clash"), (None, None, "x")], "doc_id long, text string, score string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).collect() == [], name
        rows = stage(spark, docs, sf).collect()
        assert len(rows) == 3, name  # nothing to learn from, nothing to reject
