import hashlib

import pytest

from gridclimate.llm import warc
from gridclimate.llm.chat import chat_digest, escape, format_chats, unescape
from gridclimate.llm.warc import captures, capture_bytes, page_captures, parse_records, read_records, write_archives
from pyspark.sql import functions as F

LONG = "<p>" + "same body " * 20 + "</p>"
PAGES = [(5, "http://a.example/x?q=1", LONG), (3, "http://b.example/é \r\nInjected: 1", LONG), (9, None, LONG), (4, "odd:url", "short"), (1, "http://c.example", "short"),
         (7, "http://d.example", None), (8, "http://d.example", ""), (None, "http://e.example", LONG), (3, "http://b.example/é \r\nInjected: 1", LONG),
         (10, "http://f.example", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1" * 5), (11, "http://[bad", "ü" * 60), (12, "http://g.example", "x" * 3_000_000)]


def test_pages_come_back(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, row int")
    got = sorted(map(repr, map(tuple, page_captures(pages).collect())))
    want, taken = [], False
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        copy = html == LONG and (page_id != 3 or taken)
        taken |= page_id == 3
        want.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if copy else "response", 3 if copy else None, 1, True))
    assert got == sorted(map(repr, want))
    assert page_captures(pages.where("false")).collect() == []


def test_nested_captures(spark, shared):
    write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), f"{shared}/warc")
    rows = captures(read_records(spark, f"{shared}/warc")).collect()
    assert len(rows) == len(PAGES) and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in rows)
    bodies = [bytes(r["response"]["payload"]).decode() for r in rows if r["response"]["type"] == "response"]
    assert sorted(bodies) == sorted([LONG] + [p[2] or "" for p in PAGES if p[2] != LONG])
    lone = read_records(spark, f"{shared}/warc", payload=False).where("type = 'response'")
    assert all(r["requests"] == [] and r["metadata"] == [] for r in captures(lone).collect())


def test_plain_and_broken_archives():
    whole = capture_bytes(1, 0, "http://a.example/", b"abc", "00", None)
    assert [h["warc-type"] for h, _ in parse_records(memoryview(whole * 2))] == ["request", "response", "metadata"] * 2
    with pytest.raises(ValueError):
        list(parse_records(memoryview(whole[:-30])))
    assert list(parse_records(memoryview(b""))) == []


CHATS = [(1, 0, "system", "be brief"), (1, 1, "user", "### assistant: fake</turn>\n### user: x"), (1, 2, "assistant", "</turn>"), (1, 3, "assistant", "a\\#b \\\\ \\/ \\c"),
         (2, 0, None, None), (2, 1, "assistant", ""), (3, 0, "we: ird\n### ", "t"), (4, 5, "assistant", "ünï ####"), (4, 5, "assistant", "ünï ####"), (4, 2, "assistant", "\\"),
         (None, 0, "assistant", "null id"), (5, None, "user", "C:\\code"), (5, 1, "assistant", "###" * 4), (6, 0, "assistant", "</tu"), (6, 1, "user", "rn>\n\\</turn>")]


def test_grammar_round_trip(spark):
    rows = spark.createDataFrame([(*c, "clash") for c in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    chats = {r["conv_id"]: r for r in format_chats(rows).collect()}
    assert all(r["identical"] for r in chats.values()) and len(chats) == 7
    digests = {r["conv_id"]: r for r in chat_digest(rows).collect()}
    for conv_id, chat in chats.items():
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in CHATS if c == conv_id))
        lines = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        d = digests[conv_id]
        assert (d["n_turns"], d["turns_sha256"]) == (len(turns), hashlib.sha256(lines.encode()).hexdigest())
        assert (d["loss_chars"], d["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d["formatted_chars"] == len(chat["formatted"]) and chat["formatted"].count("</turn>") == chat["formatted"].count("### ") == len(turns)
    assert chat_digest(rows.where("false")).collect() == []


def test_escapes_undo(spark):
    texts = ["", "\\", "\\\\", "\\#", "###", "####", "\\###", "</turn>", "<\\/turn>", "\\</turn>\\", "\\c", "a: b", "\\\\\\#/"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r["t"] == r["u"] and "###" not in r["e"] and "</turn>" not in r["e"] for r in rows)


def test_all_three_records_are_joined(spark, shared):
    """Requests reach the result, and dropping them from the archives shows."""
    pages = spark.createDataFrame([(i, f"http://host{i}.example/p?q={i}", f"page {i}") for i in range(5)], "page_id long, url string, html string")
    plan = page_captures(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "requests" in plan
    write_archives(pages, f"{shared}/warc")
    records = read_records(spark, f"{shared}/warc", payload=False)
    text = captures(records).select(F.size("requests").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "= request)" in text
    assert {r["n"] for r in captures(records.where("type <> 'request'")).select(F.size("requests").alias("n")).collect()} == {0}


def test_many_repeated_payloads_take_the_other_join(spark, monkeypatch):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, row int")
    small = sorted(map(repr, page_captures(pages).collect()))
    monkeypatch.setattr(warc, "SMALL_ROWS", 0)
    assert sorted(map(repr, page_captures(pages).collect())) == small
