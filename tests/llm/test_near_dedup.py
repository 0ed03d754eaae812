import collections
import re

import numpy as np
import pyarrow as pa
from conftest import edited, prose

from gridclimate.llm.common import gram_hashes, string_buffers, word_hashes
from gridclimate.llm.near_dedup import band_keys, components, fast_sketch, near_duplicates


def shingles(text, n):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows, n=4):
    """Component (smallest id over links) of every (id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    links = collections.defaultdict(set)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            if x and y and rows[a][0] is not None and rows[b][0] is not None and 100 * len(x & y) >= 80 * len(x | y):
                links[a].add(b)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen]
        out.append((rows[a][0], len(sets[a]), None if rows[a][0] is None else min(ids)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_awkward_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs).collect()
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == key(brute(rows))
    assert all(r["kept"] == (r["component_id"] in (None, r["doc_id"])) for r in got)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_hot_groups_and_chains(spark):
    """A large group around one text, and a chain whose ends are far apart."""
    base = prose(50, 100)
    rows = [(i, edited(base, i, i % 7)) for i in range(1000, 1150)]
    chain = prose(60, 100).split()
    for step in range(8):
        rows.append((step, " ".join([f"new{step}x{i}" for i in range(4 * step)] + chain[4 * step:])))
    rows += [(2000 + i, prose(70, 30)) for i in range(60)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == key(brute(rows))


def test_sketch_fills_and_estimates():
    random = np.random.default_rng(0)
    common, left, right = (random.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = [np.concatenate([common, left]), np.concatenate([common, right]), common[:1]]
    sketch = fast_sketch(np.concatenate(sets), np.repeat(np.arange(3), [len(s) for s in sets]), 3, 120)
    assert (sketch != np.iinfo(np.uint64).max).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.8) < 0.15
    assert band_keys(sketch, 30, 4).shape == (3, 30)


def test_words_do_not_depend_on_segments():
    text = (prose(5, 400_000) + " " + "y" * 3_000_000 + " end").encode()
    offsets, data = string_buffers(pa.array([text.decode()]))
    hashes, counts = word_hashes(data, offsets)
    assert counts.tolist() == [400_002]
    offsets, data = string_buffers(pa.array([prose(5, 400_000)[:1000]]))
    assert (word_hashes(data, offsets)[0][:100] == hashes[:100]).all()
    assert len(gram_hashes(hashes, 4)) == 400_002 - 3


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links, "path").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
