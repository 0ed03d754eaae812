import hashlib
import re

from conftest import prose

from gridclimate.llm.common import small_side
from gridclimate.llm.decontaminate import contamination


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            theirs = words(item)
            n = min(13, len(theirs))
            windows = {tuple(theirs[i:i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item_id))
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return out


def key(rows):
    return sorted(rows, key=repr)


def test_spans_edges_and_short_items(spark):
    item, other = prose(200, 40).split(), prose(201, 30).split()
    docs = [(i, " ".join(prose(300 + i, 30).split() + item[i:i + 10 + i] + prose(400 + i, 25).split())) for i in range(16)]
    docs += [(50, " ".join(item)), (51, " ".join(item).upper() + "."), (52, "; ".join(item[3:16])), (53, " ".join(item[:12])), (54, None), (55, ""),
             (56, " ".join((other[:20] + ["gap"]) * 3)), (57, "say two words now"), (58, "lone"), (59, " ".join(item[:20] + item[10:30])), (50, "other text"), (50, "other text")]
    items = [(1, " ".join(item)), (2, " ".join(other)), (3, None), (4, ""), (5, "Two words"), (6, "lone"), (7, " ".join(item)), (10, " ".join(other[5:18]))]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert key(tuple(r) for r in got.drop("row_hash").collect()) == key(brute(docs, items))


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    items = [(i, t) for i, t in rows if t][:3] + [(None, rows[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    listed = [x for x in items if x[0] is not None]
    got = contamination(odd_docs, bench).drop("row_hash")
    assert key(tuple(r) for r in got.collect()) == key(brute(rows, listed))
    assert contamination(no_docs, bench).collect() == []
    assert not any(r["contaminated"] or r["n_items"] for r in contamination(odd_docs, bench.where("false")).collect())


def test_wide_windows_are_not_sent_to_every_task(spark):
    few = spark.createDataFrame([("x" * 100,), (None,)], "window string")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(few, 2)) and not hinted(small_side(few, 1)) and not hinted(small_side(few, 2, text_bytes=99))
