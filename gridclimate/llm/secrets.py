"""Secret scans (operator 13).

Method: dictionary-primed novelty. The most frequent stand-alone words of all documents are
the identifier dictionary that zstandard is primed with. A candidate is a run of
credential characters close behind a sensitive word. What it costs is measured, not
guessed: behind the code around it, a block of fixed frame text is compressed with and
without it. The frame keeps blocks large enough to be compressed at all and gives letters,
digits and signs the same code lengths each time. A candidate that adds `NOVELTY` bytes a character or more is made of
nothing that the dictionary or its surroundings hold, so it is reported as `novel`; names,
paths and words cost little and are not.

Most texts hold neither a sensitive word nor a long enough run of hexadecimal digits; bytes
tell that for a batch at once, and only the others are searched by pattern.

The three fixed patterns (assign, access, hex) are the base: their spans always stay, and a
novel span is added only where it touches none of them. Novelty is measured for the values
of base spans too and returned as `n_confirmed`.

Spans are in code points, end exclusive; an assign span is its whole match. The dictionary
is bounded by `DICTIONARY_WORDS` and the frame by `FRAME_BYTES`; their counts come from all documents.

Defined cases: a null text is an empty one and has no spans; null ids are kept and repeated rows
scanned like any other; an empty table gives no rows and an empty dictionary; a long text is scanned whole, a long
candidate compressed whole; a candidate's own repeats around it do not make it known; equal
word counts are settled by the word; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import mapped, pieces, string_buffers

# --- Fixed values: base patterns, kinds in order, least lengths --------------------------
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "novel"]
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
# --- end of fixed values ------------------------------------------------------------------

#: Words that make what follows sensitive, whatever their case.
SENSITIVE = ["passw", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "accesskey", "private_key",
             "credential", "bearer", "authorization", "signature", "akia"]
#: Characters between a sensitive word and a candidate, on one line.
REACH = 48
#: Least characters of a candidate.
LEAST = 16
#: Characters of surrounding code on either side of a candidate.
AROUND = 192
#: Compressed bytes that a character of a novel string adds at least.
NOVELTY = 0.8
DICTIONARY_WORDS = 8192
#: Frame text: words next in frequency to those of the dictionary, then this.
FRAME_BYTES = 600
FRAME = """when every quiet river bends beyond the old mill we follow its course by lamp and never ask how far a journey goes. \
some of us sing, others just watch clouds drift over fields of maize; a few keep notes: names of birds, hours of rain, the price of bread. \
just before dawn a baker lights his oven, kneads dough, hums a tune. his daughter packs warm loaves, jokes with the miller, rides away. \
by noon market squares fill up with voices, dogs, carts, boxes of figs and quince, jars of honey, wax, wool and salt. \
no one hurries. evening comes, shutters close, embers glow, and soft wind carries the last words out across the valley."""
LEVEL = 3
#: Words counted in one task before they are handed on.
HELD_WORDS = 200_000

_assign, _access = re.compile(ASSIGN), re.compile(ACCESS)
#: The same matches as those of the plain pattern that are long enough: runs are maximal.
_hex = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
_sensitive = re.compile("|".join(map(re.escape, SENSITIVE)))
_run = re.compile(rf"[A-Za-z0-9+/_.~-]{{{LEAST},}}={{0,2}}")
_word = re.compile(r"(?<![A-Za-z0-9+/_.=~-])[A-Za-z]{4,32}(?![A-Za-z0-9+/_=~-])")


_UPPER = {c: c + 32 for c in range(65, 91)}
_HEX_BYTE = np.zeros(256, dtype=bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


def _long_hex(offsets: np.ndarray, data: np.ndarray) -> set[int]:
    """Rows with a run of hexadecimal digits that is long enough."""
    rows: set[int] = set()
    for a, b in pieces(offsets):
        block, edges = _HEX_BYTE[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]
        begins, ends = block.copy(), block.copy()
        begins[1:] &= ~block[:-1]
        ends[:-1] &= ~block[1:]
        inner = edges[(edges > 0) & (edges < len(block))]  # no run crosses the edge of two texts
        begins[inner], ends[inner - 1] = block[inner], block[inner - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        found = begins[ends - begins + 1 >= LEAST_HEX]
        rows.update((np.searchsorted(edges, found, side="right") - 1 + a).tolist())
    return rows


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Start, place of the kind, end and start of the value, of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end(), m.start(2)) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in _access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end(), m.start()) for m in _hex.finditer(text)]
    return sorted(out)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs of credential characters that begin within reach behind a sensitive word, on its line or the next."""
    done = 0
    for word in _sensitive.finditer(text.translate(_UPPER)):
        at, stop = max(word.end(), done), word.end() + REACH
        if at < stop and (line := text.find("\n", at, stop)) >= 0 and (second := text.find("\n", line + 1, stop)) >= 0:
            stop = second
        while at <= stop and (found := _run.search(text, at, min(stop + LEAST, len(text)))):
            at = done = _run.match(text, found.start()).end()
            yield found.start(), done


class Novelty:
    """Marginal compressed size by a zstandard compressor primed with a dictionary of words."""

    def __init__(self, words: list[str], rarer: list[str]):
        import zstandard

        settings = {"level": LEVEL, "write_content_size": False}
        if words:
            primed = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
            settings["dict_data"] = primed
        self._compressor, self._block = zstandard.ZstdCompressor(**settings), zstandard.COMPRESSOBJ_FLUSH_BLOCK
        self._frame = f"{' '.join(rarer)} {FRAME}"[:FRAME_BYTES]

    def _size(self, code: bytes, text: str) -> int:
        stream = self._compressor.compressobj()
        stream.compress(code)
        stream.flush(self._block)
        return len(stream.compress(text.encode()) + stream.flush(self._block))

    def __call__(self, text: str, begin: int, end: int) -> float:
        """Bytes a character that text[begin:end] adds to a block behind the code around it."""
        own = text[begin:end]
        code = f"{text[max(begin - AROUND, 0):begin]}\n{text[end:end + AROUND]}\n".replace(own, " ").encode()
        return (self._size(code, self._frame + own) - self._size(code, self._frame)) / len(own)


def identifier_words(docs: DataFrame, most: int) -> list[str]:
    """The most frequent stand-alone words of all texts, the most frequent first."""
    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(_word.findall(text.as_py() or ""))
                if len(counts) > HELD_WORDS:
                    yield flush()
        yield flush()

    counted = mapped(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]  # at most `most` short words


def secret_spans(docs: DataFrame, novelty: float = NOVELTY, most: int = DICTIONARY_WORDS) -> DataFrame:
    """Spans of every text: doc_id, spans (array of start, kind, end and novelty: bytes that a character of the value adds), by start and kind."""
    words = identifier_words(docs, most + FRAME_BYTES // 4)  # a word has four letters at least

    def run(batches):
        cost = Novelty(words[:most][::-1], words[most:])
        for batch in batches:
            rows, long_runs = [], _long_hex(*string_buffers(batch.column(1)))
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                lower = text.lower()
                if i not in long_runs and not any(w in lower for w in SENSITIVE):
                    rows.append([])
                    continue
                found = [(a, k, b, cost(text, v, b)) for a, k, b, v in base_spans(text)]
                covered = [(a, b) for a, _, b, _ in found]
                for a, b in candidates(text):
                    if not any(a < y and x < b for x, y in covered) and (bytes_each := cost(text, a, b)) >= novelty:
                        found.append((a, 3, b, bytes_each))
                rows.append([{"start": a, "kind": KINDS[k], "end": b, "novelty": c} for a, k, b, c in sorted(found)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.struct(
                [("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("novelty", pa.float64())])))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, spans array<struct<start: bigint, kind: string, end: bigint, novelty: double>>")


def secret_digest(docs: DataFrame, novelty: float = NOVELTY, most: int = DICTIONARY_WORDS) -> DataFrame:
    """Counts by kind, the base spans as a checksum and all spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return secret_spans(docs, novelty, most).select(
        "doc_id", *[count(of_kind(k)).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count(of_kind("novel")).alias("n_novel"),
        count(lambda s: (s["kind"] != "novel") & (s["novelty"] >= novelty)).alias("n_confirmed"))
