"""Token ids by a public tokenizer file, looked up once per distinct chunk of a piece of texts.

`word_bpe_49k.json` splits at white space and never merges across it, so the ids of a
text are those of its blank-separated chunks in order. Nor does it merge punctuation into a word before it,
so a chunk also ends there: a word has one entry, whatever follows it. The texts of a piece are cut into
chunks with numpy, Arrow numbers the distinct ones; only these are looked up, and the ids
are gathered with numpy. A worker keeps the ids of short chunks it has met, per tokenizer file and
up to a fixed number of bytes, and has the tokenizer read only new ones, many at once: an id that closes a word
tells words of letters apart, marks the others. A file that does not split so, told by probes, is cut at blanks
alone or has whole texts encoded.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridclimate.llm.common import pieces, string_buffers

#: Id that closes every document.
END_ID = 1
#: Bytes of chunks and their ids that a worker keeps; when they are full, the third met first stays, which holds the frequent ones.
KEPT_BYTES = 96 << 20
#: Characters of a chunk that is kept at most, and what a kept chunk costs besides its characters and ids.
SHORT, ENTRY_BYTES = 64, 150
#: New chunks handed to the tokenizer together.
TOGETHER = 512
#: Stands between new chunks; a control character that no sane text holds.
MARK = "\x01"
#: Bytes that part chunks.
BLANK = np.zeros(256, dtype=bool)
BLANK[[10, 32]] = True
#: ASCII punctuation that ends a chunk of letters. The low line belongs to words in some files.
PUNCTUATION = string.punctuation.replace("_", "")
#: The last two bytes of a text that ends with a letter: ASCII, or U+00C0 to U+017F and U+0400 to U+047F, without the signs
#: among them and the dotted capital I, whose small form ends with a mark that belongs to the punctuation.
LETTER = np.zeros((256, 256), dtype=bool)
LETTER[:, list(string.ascii_letters.encode())] = True
LETTER[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1], 0x80:0xC0] = True
LETTER[0xC3, [0x97, 0xB7]] = LETTER[0xC4, 0xB0] = False
#: Texts that a file which splits at white space encodes as it does their chunks.
PROBES = ["a b", "Hello, world!  it's 42", "x\ny  z\n\n1 2 3", " lead and trail ", "don't stop (now) 3.14 - a_b", "ß é 日本 語\nend", "the The THE\n the"]
#: Texts that a file which splits punctuation from the word before it encodes as it does their chunks.
CUT_PROBES = [f"x{c} éa{c}{c} the{c}the Ж{c}s It{c}ll 4{c}a" for c in PUNCTUATION]
CUT_PROBES += [" ".join(f"{bytes([a, b]).decode()[-1]}," for a, b in np.argwhere(LETTER).tolist() if a in (32, 0xC3, 0xC4, 0xC5, 0xD0, 0xD1) and (a == 32) == (b < 128))]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ids(found) -> np.ndarray:
    return np.array(found.ids, dtype=np.uint16)


def chunks_of(texts: pa.Array, cuts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Chunks of texts, end to end, and where each text's begin among them. `cuts` tells the bytes that end a chunk after a letter."""
    offsets, data = string_buffers(texts)
    kept = ~BLANK[data]
    begins = kept.copy()
    begins[1:] &= ~kept[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = kept[first]
    at = np.flatnonzero(cuts[data])
    begins[at[LETTER[data.take(at - 2, mode="wrap"), data[at - 1]]]] = True
    solid, starts = data[kept], np.flatnonzero(begins[kept])
    chunks = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(solid))), pa.py_buffer(solid)])
    return chunks, np.searchsorted(np.flatnonzero(begins), offsets)


class Vocabulary:
    """Ids of texts by one tokenizer file, with the chunks met so far."""

    def __init__(self, path: str, kept: int = KEPT_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker on every core
        from tokenizers import Tokenizer

        self.own, self.kept = Tokenizer.from_file(path), kept
        if self.own.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError(f"{path} has more ids than 16 bits hold")
        self.mark = self._encode([MARK])[0]
        self.cuts = np.zeros(256, dtype=bool)
        self.by_chunk = self._splits(PROBES)
        added = "".join(x.content for x in self.own.get_added_tokens_decoder().values())
        self.cuts[[ord(c) for c in PUNCTUATION if c not in added]] = True
        if not self._splits([*PROBES, *CUT_PROBES]):
            self.cuts[:] = False
        self.closing = self._closing()
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.arena, self.used, self.bytes = np.zeros(1 << 16, np.uint16), 0, 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [_ids(x) for x in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _splits(self, texts: list[str]) -> bool:
        """Whether the ids of texts are those of their chunks in order."""
        return all(
            np.array_equal(whole, np.concatenate(self._encode(chunks_of(pa.array([text]), self.cuts)[0].to_pylist())))
            for text, whole in zip(texts, self._encode(texts)))

    def _closing(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Which ids close a word, and how many bytes each id covers, if the file marks the ends of words."""
        end = getattr(self.own.model, "end_of_word_suffix", None)
        if not end:
            return None
        closing, widths = np.zeros(1 << 16, dtype=bool), np.zeros(1 << 16, dtype=np.int64)
        for token, i in self.own.get_vocab(with_added_tokens=False).items():
            closing[i], widths[i] = token.endswith(end), len(token.removesuffix(end))
        return closing, widths

    def _words(self, group: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and sizes of chunks that are one word each to the file; nothing if the ids do not cover them so, byte by byte."""
        ids, = self._encode([" ".join(group)])
        closing, widths = self.closing
        ends, covered = np.flatnonzero(closing[ids]), np.cumsum(widths[ids])
        if len(ends) != len(group) or ends[-1] != len(ids) - 1 or not np.array_equal(covered[ends], np.cumsum([len(c.encode()) for c in group])):
            return None
        return ids, np.diff(ends, prepend=-1)

    def _read(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks end to end, and how many each has. Many are encoded together: words of letters side by side, others with marks between them."""
        parts, sizes = [], []
        for group in (chunks[i:i + TOGETHER] for i in range(0, len(chunks), TOGETHER)):
            if self.closing is not None and all(map(str.isalpha, group)) and (found := self._words(group)):
                parts.append(found[0])
                sizes.append(found[1])
                continue
            ids, = self._encode([f" {MARK} ".join(group)])
            cuts = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else ()
            if len(cuts) == len(group) - 1:
                parts.append(np.delete(ids, cuts))
                sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
            else:  # a chunk holds the mark
                single = self._encode(group)
                parts += single
                sizes.append([len(x) for x in single])
        return (np.concatenate(parts), np.concatenate(sizes)) if parts else (np.zeros(0, np.uint16), np.zeros(0, np.int64))

    def _keep(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember chunks, none of them known."""
        n, end = len(self.known), self.used + len(ids)
        if n + len(chunks) > len(self.starts):
            self.starts, self.lengths = (np.resize(x, 2 * (n + len(chunks))) for x in (self.starts, self.lengths))
        if end > len(self.arena):
            self.arena = np.resize(self.arena, 2 * end)
        self.arena[self.used:end] = ids
        self.starts[n:n + len(chunks)], self.lengths[n:n + len(chunks)] = self.used + np.cumsum(sizes) - sizes, sizes
        self.known.update(zip(chunks, range(n, n + len(chunks))))
        self.used, self.bytes = end, self.bytes + sum(map(len, chunks)) + ENTRY_BYTES * len(chunks) + 2 * len(ids)

    def _forget(self) -> None:
        stay = len(self.known) // 3
        self.known = dict(islice(self.known.items(), stay))
        self.used = int(self.starts[stay - 1] + self.lengths[stay - 1]) if stay else 0
        self.bytes = sum(ENTRY_BYTES + len(c) for c in self.known) + 2 * self.used

    def _gather(self, distinct: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct chunks in the order of the codes, and how many each code has. The last code is the end id."""
        if self.bytes > self.kept:
            self._forget()
        at = np.fromiter(map(self.known.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(at < 0).tolist()
        short, long = [i for i in new if len(distinct[i]) <= SHORT], [i for i in new if len(distinct[i]) > SHORT]
        short.sort(key=lambda i: not distinct[i].isalpha())  # words of letters together
        at[short] = np.arange(len(self.known), len(self.known) + len(short))
        chunks = [distinct[i] for i in short]
        self._keep(chunks, *self._read(chunks))
        # long chunks and the end id lie behind the arena, for this piece alone
        held = [*self._encode([distinct[i] for i in long]), np.array([END_ID], np.uint16)]
        sizes = np.array([len(x) for x in held])
        starts, lengths = np.append(self.starts[at], 0), np.append(self.lengths[at], 0)
        starts[[*long, -1]], lengths[[*long, -1]] = self.used + np.cumsum(sizes) - sizes, sizes
        source = np.concatenate([self.arena[:self.used], *held])
        counts = lengths[codes]
        ends = np.cumsum(counts)
        return source[np.repeat(starts[codes] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)], counts

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (no nulls), each closed by the end id, end to end, and the offsets of the texts."""
        if not self.by_chunk:
            parts = [np.append(x, np.uint16(END_ID)) for x in self._encode(texts.to_pylist())]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        chunks, edges = chunks_of(texts, self.cuts)
        coded = pc.dictionary_encode(chunks)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.insert(coded.indices.to_numpy().astype(np.int64), edges[1:], len(distinct))
        ids, counts = self._gather(distinct, codes)
        ends = np.cumsum(counts)[edges[1:] + np.arange(len(texts))]
        return ids, np.concatenate([[0], ends])


@lru_cache(maxsize=2)
def vocabulary(path: str, kept: int) -> Vocabulary:
    """The worker's vocabulary of a tokenizer file."""
    return Vocabulary(path, kept)


def token_pieces(column: pa.Array, path: str, kept: int = KEPT_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row where a piece of the texts begins, the ids of its texts as 16-bit numbers, end to end, and their offsets. A null is an empty text."""
    own = vocabulary(path, kept)
    texts = column.cast(pa.large_string()).fill_null("")
    offsets, _ = string_buffers(column)
    for a, b in pieces(offsets):
        ids, edges = own.ids_of(texts.slice(a, b - a))
        yield a, ids, edges
