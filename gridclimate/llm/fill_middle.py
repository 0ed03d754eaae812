"""Fill-in-middle transformation (operator 11).

Method: the texts of a batch lie end to end as UTF-8 and are read as 64-bit words. Word
arithmetic marks the top bit of every byte that ends a unit (a byte that is not blank
before one that is, and the last byte of a text). A population count per word, summed up,
gives the units before any byte; the n-th unit's end is found by searching these sums
for its word and then, inside the word, by comparing the running sums of its eight marks with the
rank wanted. Code points are counted with the same structure over the bytes that begin one.
No text is split into a list of its units.

A unit is `[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+`, or the blanks that end a text. Blanks are
single bytes that occur inside no other character, so cuts never split a character.

Defined cases: a null text is an empty one; empty texts and texts that hold a marker stay
plain; a null id counts as an empty one in the hash; rows are handled one by one, so repeated
rows give equal rows; an empty table gives no rows; a text longer than a piece is a piece of
its own; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, mapped, pieces, string_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of the texts that are transformed, and of those the percent with the suffix first.
RATE, SPM = 50, 80
ONES, HIGH, LOW = U64(0x0101010101010101), U64(0x8080808080808080), U64(0x7F7F7F7F7F7F7F7F)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian words, filled up with zeros to one word beyond the end."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def blank_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that is 0x20 or 0x09 to 0x0D. No sum leaves its byte."""
    low = words & LOW
    other = (low ^ U64(0x20) * ONES) + LOW
    control = (low + U64(0x80 - 0x09) * ONES) & ~(low + U64(0x80 - 0x0E) * ONES)
    return (~other | control) & ~words & HIGH


def unit_marks(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The top bit of each byte that ends a unit."""
    blank = blank_marks(words)
    after = blank >> U64(8)
    after[:-1] |= blank[1:] << U64(56)
    marks = ~blank & after & HIGH
    last = offsets[1:][np.diff(offsets) > 0] - 1
    np.bitwise_or.at(marks, last >> 3, U64(0x80) << ((last & 7) << 3).astype(U64))
    return marks


def character_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that does not continue a character."""
    return ~(words & ~(words << U64(1))) & HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.before = marks, np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        below = (U64(1) << ((at & 7) << 3).astype(U64)) - U64(1)
        return self.before[at >> 3] + np.bitwise_count(self.marks[at >> 3] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The place just behind the nth marked byte, counted from 1."""
        word = np.searchsorted(self.before, nth, side="left") - 1
        sums = (self.marks[word] >> U64(7) & ONES) * ONES
        reached = (sums | HIGH) - (nth - self.before[word]).astype(U64) * ONES & HIGH
        return word * 8 + 9 - np.bitwise_count(reached)


def middles(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of each text, the bytes where its middle begins and ends, and the code points of prefix and middle."""
    words = words_of(data)
    units = Marks(unit_marks(words, offsets))
    begin, before = offsets[:-1], units.rank(offsets[:-1])
    n = units.rank(offsets[1:]) - before
    counts = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    cuts = np.broadcast_to(begin, counts.shape).copy()
    inside = counts > 0
    cuts[inside] = units.select((before + counts)[inside])
    characters = Marks(character_marks(words))
    at = [characters.rank(x) for x in (begin, *cuts)]
    return n, cuts[0], cuts[1], at[1] - at[0], at[2] - at[1]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Every text in its training form: doc_id, n (units), form, prefix_chars, middle_chars (null where plain) and output.

    Cuts and form come from the SHA-256 of `seed:doc_id`, so they are the same wherever a row is handled.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring("__digest", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"__h{i}") for i in range(4)]
    rows = docs.select("doc_id", "text", digest.alias("__digest")).select("doc_id", "text", *groups)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        p, s, m = marks
        for batch in batches:
            offsets, data = string_buffers(batch.column(1))
            hashes = [batch.column(i).to_numpy() for i in range(2, 6)]
            for a, b in pieces(offsets):
                edges = offsets[a:b + 1] - offsets[a]
                block = data[offsets[a]:offsets[b]]
                n, left, right, before, within = middles(block, edges, hashes[0][a:b], hashes[1][a:b])
                shaped, behind = hashes[2][a:b] % 100 < rate, hashes[3][a:b] % 100 < spm
                whole, forms, outputs = block.tobytes(), [], []
                for i, (begin, x, y, end) in enumerate(zip(edges[:-1].tolist(), left.tolist(), right.tolist(), edges[1:].tolist())):
                    text = whole[begin:end]
                    if not shaped[i] or not text or any(k in text for k in marks):
                        forms.append("plain")
                        outputs.append(text)
                    elif behind[i]:
                        forms.append("spm")
                        outputs.append(b"".join((s, whole[y:end], p, whole[begin:x], m, whole[x:y])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, whole[begin:x], s, whole[y:end], m, whole[x:y])))
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n), pa.array(forms, pa.string()),
                    pa.array(before, pa.int64(), mask=plain), pa.array(within, pa.int64(), mask=plain),
                    pa.array(outputs, pa.binary()).cast(pa.string())], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(rows, run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, read from the output and its form alone."""
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows the first, the second and the middle marker. No marker occurs inside a part."""
        body = F.substring(output, len(first) + 1, F.char_length(output))
        head = F.substring_index(body, second, 1)
        rest = F.substring_index(body, second, -1)
        return head, F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_first, prefix_second, last = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_second, last, suffix_first))
            .otherwise(output))


def middle_digest(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The transformation with checksums in place of texts: of the output and of what is read back from it."""
    back = restored(F.col("output"), F.col("form"))
    return fill_in_middle(docs, seed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
