"""Fill-in-middle against regular expressions and slicing of whole texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from gridclimate.llm.fill_middle import Marks, fill_in_middle, middle_digest, unit_marks, words_of

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    units = [m.group() for m in UNIT.finditer(text)]
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    pool = ["a", "bc", " ", "\t", "\n", "\x0b", "\x1f", "\x00", "\xa0", "é", "日本", "\U0001f600", "é", "<", "P>", "<P", "> ", " ", "\x85", "!", "\x7f"]
    made = ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(600)]
    return [*made, None, "", " ", "  \n", "x", " x", "x ", "a <P> b", "<S>", "t<M>", "<<S>> <", "word " * 300_000, "é" * 700_000]


def test_every_column_against_regular_expressions(spark, texts, odd_docs):
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts, 1)], "doc_id long, text string").repartition(3)
    got = fill_in_middle(docs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(r["doc_id"], r["text"])) for r in docs.collect())
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    odd = [tuple(r) for r in fill_in_middle(odd_docs).collect()]  # repeated rows, null ids, clashing columns
    assert sorted(map(repr, odd)) == sorted(repr(expected(r["doc_id"], r["text"])) for r in odd_docs.collect())


def test_texts_come_back_from_outputs(spark, texts, no_docs):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
    rows = middle_digest(docs).collect()
    assert {r["doc_id"]: r["restored_sha256"] for r in rows} == want
    assert all(r["output_sha256"] == hashlib.sha256(expected(r["doc_id"], texts[r["doc_id"]])[5].encode()).hexdigest() for r in rows)
    assert middle_digest(no_docs).collect() == []


def test_rates_and_seeds(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('some words ', 10) as text")
    share = docs.sparkSession.createDataFrame(fill_in_middle(docs, rate=100, spm=0).select("form").toPandas()).groupBy("form").count().collect()
    assert [(r["form"], r["count"]) for r in share] == [("psm", 400)]
    assert fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0
    a, b = (fill_in_middle(docs, seed=s, rate=100).select("doc_id", "output").collect() for s in (1, 2))
    assert sum(x != y for x, y in zip(sorted(a), sorted(b))) > 300


def test_rank_and_select_agree_with_counting():
    r = np.random.default_rng(2)
    for n in (1, 7, 8, 9, 63, 64, 65, 1000):
        data = r.choice(np.frombuffer(b"a b\n\xc3\xa9", np.uint8), n)
        cuts = np.unique(np.concatenate([[0, n], r.integers(0, n + 1, 5)]))
        offsets = np.sort(np.concatenate([cuts, cuts[:2]]))  # empty texts among them
        marks = unit_marks(words_of(data), offsets)
        flags = (marks.view(np.uint8) > 0)[:n]
        ranked, at = Marks(marks), np.arange(n + 1)
        assert (ranked.rank(at) == np.concatenate([[0], np.cumsum(flags)])).all()
        assert (ranked.select(np.arange(1, flags.sum() + 1)) == np.flatnonzero(flags) + 1).all()
