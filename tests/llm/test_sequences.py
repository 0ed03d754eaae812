"""Packing and token shards against the tokenizer itself."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import prose
from tokenizers import Tokenizer

from gridclimate.llm.packing import hilbert_keys, pack, packed_index, power_cuts
from gridclimate.llm.token_shards import feistel, read_shards, stride, token_shards, write_shards
from gridclimate.llm.tokens import END_ID, MARK, Vocabulary, default_path, token_pieces, vocabulary


def ids_of(text, path=None):
    own = Tokenizer.from_file(path or default_path())
    return own.encode(text or "", add_special_tokens=False).ids + [END_ID]


TEXTS = ["", "Hello, world!  it's 42", "a\x01b c \x01", "<|endoftext|>x y", "İ Σς ß ﬁ é ́", "a\tb\r\nc\x0bd\x85e\xa0f", "日本語 text", "x" * 900, None,
         "long " + "ab" * 700_000 + " word", " ", "\n\n", *[prose(i, 200) for i in range(40)], prose(77, 250_000)]


def listed(column, path, kept=1 << 20):
    out = []
    for row, ids, edges in token_pieces(column, path, kept):
        assert row == len(out) and ids.dtype == np.uint16
        out += [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
    return out


def test_looked_up_ids_are_the_tokenizers():
    want = [ids_of(t) for t in TEXTS]
    for kept in (1 << 12, 1 << 26):  # all but nothing kept, and everything
        for _ in range(2):
            assert listed(pa.array(TEXTS), default_path(), kept) == want
    sliced = pa.array(["skip", *TEXTS, "skip"]).slice(1, len(TEXTS))
    assert listed(sliced, default_path()) == want
    assert listed(pa.array([], pa.string()), default_path()) == []


def test_a_word_is_read_once_whatever_follows_it(monkeypatch):
    """Words of letters are kept without the punctuation behind them, and read side by side without marks."""
    read, encode = [], Vocabulary._encode
    monkeypatch.setattr(Vocabulary, "_encode", lambda self, texts: read.extend(texts) or encode(self, texts))
    own = Vocabulary(default_path())
    read.clear()
    text = "brolmic brolmic, brolmic. trévasse!! brolmic? trévasse; (brolmic) Жук: brolmic"
    ids, edges = own.ids_of(pa.array([text]))
    assert ids.tolist() == ids_of(text) and edges.tolist() == [0, len(ids)]
    assert {c for c in own.known if c[-1].isalpha()} == {"brolmic", "trévasse", "(brolmic", "Жук"}
    many = " ".join(a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in ("lorg", "merf", "öst", "ñu"))
    read.clear()
    assert own.ids_of(pa.array([many]))[0].tolist() == ids_of(many)
    assert [t for t in read if t] == [many]  # no mark, and one text for all


def test_ids_of_odd_letters_marks_and_punctuation():
    """Texts of letters, combining marks, signs, added tokens and blanks in any order, also together with plain words."""
    units = ["a", "E", "t", "é", "É", "ß", "ẞ", "İ", "ſ", "ŉ", "×", "÷", "Ж", "я", "Σ", "ς", "日", "한", "क", "ि", "ª", "\u0301", "\u0308", "\u0338", "\u030a", "K", "\u3164",
             "'", "'s", "'LL", ",", ".", "=", "<", ">", "|", "_", "-", "»", "¿", "\u200d", "7", "٣", " ", " ", " ", "\n", "\t", "\r", "\xa0", "\x85", MARK,
             "<|endoftext|>", "<|ENDOFTEXT|>", "</w>", "word", "prose", "😀"]
    deal = random.Random(3)
    texts = ["".join(deal.choices(units, k=deal.randint(0, 30))) for _ in range(3000)]
    texts += [" ".join("".join(deal.choices(["a", "é", "İ", "ẞ", "日", "t", "ʰ", "ŉ", "\u3164", "ß"], k=deal.randint(1, 6))) for _ in range(deal.randint(0, 40))) for _ in range(300)]
    own = Tokenizer.from_file(default_path())
    want = [own.encode(t, add_special_tokens=False).ids + [END_ID] for t in texts]
    assert listed(pa.array(texts), default_path()) == want
    assert [x for t in texts[:200] for x in listed(pa.array([t]), default_path(), 1 << 12)] == want[:200]


def test_two_tokenizer_files_in_one_worker():
    byte = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t for t in TEXTS if t is None or len(t) < 10_000]
    for path in (default_path(), byte, default_path()):
        assert listed(pa.array(texts), path) == [ids_of(t, path) for t in texts]
    assert vocabulary(default_path(), 5).by_chunk and not vocabulary(byte, 5).by_chunk  # leading blanks belong to its words


def test_more_ids_than_16_bits_hold(monkeypatch):
    class Large:
        @staticmethod
        def from_file(path):
            return type("T", (), {"get_vocab_size": lambda self, with_added_tokens: 70_000})()

    monkeypatch.setattr("tokenizers.Tokenizer", Large)
    with pytest.raises(ValueError, match="16 bits"):
        Vocabulary("any.json")


def test_pieces_hold_every_id_once(odd_docs, no_docs):
    pieces = pack(odd_docs, length=256).collect()
    texts = sorted((repr(r["doc_id"]), bytes(np.array(ids_of(r["text"]), dtype=np.uint16))) for r in odd_docs.collect())
    by_sequence = {}
    for r in pieces:
        assert len(r["ids"]) == 2 * r["length"] and r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in rows)
        assert [r["offset"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        assert total <= 256 and total & (total - 1) == 0  # a full one, or a power of two: no padding at all
    whole, current = [], None
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):  # documents lie end to end in sequence order
        if r["start"] == 0:
            current = [repr(r["doc_id"]), b"", r["doc_tokens"]]
            whole.append(current)
        assert len(current[1]) == 2 * r["start"] and current[0] == repr(r["doc_id"])
        current[1] += bytes(r["ids"])
    assert sorted((i, b) for i, b, _ in whole) == texts and all(len(b) == 2 * n for _, b, n in whole)
    assert pack(no_docs).collect() == []


def test_checksums(odd_docs):
    want = {r["doc_id"]: np.array(ids_of(r["text"]), dtype="<u4") for r in odd_docs.where("doc_id in (1, 9, 12)").collect()}
    for r in packed_index(odd_docs.where("doc_id in (1, 9, 12)")).collect():
        assert r["ids_crc32"] == zlib.crc32(want[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes())


def test_hilbert_curve_is_connected():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 4, indexing="ij"), -1).reshape(-1, 4)
    path = points[np.argsort(hilbert_keys(points, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert power_cuts(1500) == [1024, 256, 128, 64, 16, 8, 4] and power_cuts(0) == []


def test_feistel_is_a_permutation():
    for size in (1, 2, 3, 10, 97, 4096, 5000):
        slots = feistel(np.arange(size), size, key=3)
        assert sorted(slots.tolist()) == list(range(size))
    assert (feistel(np.arange(5000), 5000, 3) != feistel(np.arange(5000), 5000, 4)).mean() > 0.9
    assert len(feistel(np.arange(0), 0, 1)) == 0


def read_record(path, slot, per_shard, length):
    file, = glob.glob(f"{path}/part-{slot // per_shard:05d}-*")
    with open(file, "rb") as f:
        f.seek(slot % per_shard * stride(length))
        return f.read(stride(length))


@pytest.mark.parametrize("spill", [None, "20"])
def test_shards_resume_by_arithmetic(spark, odd_docs, no_docs, shared, spill):
    """Every slot lies where arithmetic finds it, also when the sort spills, and holds the tokenizer's ids."""
    setting = "spark.shuffle.spill.numElementsForceSpillThreshold"
    if spill:
        spark.conf.set("spark.sql.windowExec.buffer.spill.threshold", spill)
        spark.conf.set("spark.sql.sortMergeJoinExec.buffer.spill.threshold", spill)
    path = f"{shared}/shards"
    docs = odd_docs
    if spill:  # the setting is read when a sorter is made
        before = spark.sparkContext._jsc.sc().conf().get(setting, None)
        spark.sparkContext._jsc.sc().conf().set(setting, spill)
        docs = odd_docs.unionByName(spark.createDataFrame([(1000 + i, prose(i, 400)) for i in range(60)], "doc_id long, text string"), allowMissingColumns=True)
    try:
        index = write_shards(docs, path, key=7, length=128, per_shard=64 if spill else 16).collect()
    finally:
        if spill:
            spark.conf.unset("spark.sql.windowExec.buffer.spill.threshold")
            spark.conf.unset("spark.sql.sortMergeJoinExec.buffer.spill.threshold")
            conf = spark.sparkContext._jsc.sc().conf()
            conf.remove(setting) if before is None else conf.set(setting, before)
    per_shard = 64 if spill else 16
    back = {r["slot"]: r for r in read_shards(spark, path, 128, per_shard).collect()}
    assert sorted(back) == sorted(r["slot"] for r in index) == list(range(len(index))) and len(index) > 2 * per_shard
    assert all((r["shard"], r["record"]) == divmod(s, per_shard) for s, r in back.items())
    got = {}
    for r in index:
        record = read_record(path, r["slot"], per_shard, 128)  # one seek
        assert int.from_bytes(record[:8], "little") == r["slot"] and int.from_bytes(record[8:12], "little") == r["n"] == back[r["slot"]]["n"]
        ids = np.frombuffer(record, dtype="<u2", count=r["n"], offset=12)
        assert zlib.crc32(ids.astype("<u4").tobytes()) == back[r["slot"]]["ids_crc32"]
        assert r["begins"] == sorted(r["begins"]) and r["begins"][0] == 0 and len(r["begins"]) == len(r["doc_ids"])
        for i, a, b in zip(r["doc_ids"], r["begins"], [*r["begins"][1:], r["n"]]):
            got.setdefault(i, []).append(ids[a:b].tolist())
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).extend(ids_of(r["text"]))
    assert {i: sorted(x for part in parts for x in part) for i, parts in got.items()} == {i: sorted(x) for i, x in want.items()}
    short = [i for i, x in want.items() if i is not None and i not in (2, 13) and len(got[i]) == 1]
    assert short and all(got[i][0] == want[i] for i in short)  # in order, where a document is one piece


def test_a_record_out_of_place_is_noticed(spark, shared):
    length = 4
    def record(slot):
        return slot.to_bytes(8, "little") + (2).to_bytes(4, "little") + bytes(2 * length) + b"\n"

    import os
    os.makedirs(f"{shared}/bad")
    with open(f"{shared}/bad/part-00000-x.txt", "wb") as f:
        f.write(record(1) + record(0))
    with pytest.raises(Exception, match="order of their slots"):
        read_shards(spark, f"{shared}/bad", length, 16).collect()


def test_shards_of_documents_and_of_nothing(odd_docs, no_docs):
    rows = token_shards(odd_docs, length=128).collect()
    assert {x for r in rows for x in r["doc_ids"]} == {r["doc_id"] for r in odd_docs.collect()}
    assert token_shards(no_docs).collect() == []
