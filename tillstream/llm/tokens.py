"""Token ids of whole texts by a public tokenizer file, fast enough for a corpus.

A byte-level BPE splits a text before each space that stands alone, around a line end that does, and
between a letter and a mark, so what lies between has its own ids. The texts of a span are cut there
as one buffer of bytes; each different piece is looked up once a span, and ids are gathered by piece.
Texts with two white-space characters in a row, or with an added token in them, are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries of the table of pieces in each Python worker (about 40 bytes each); at the bound it starts
# anew with the pieces of the span at hand.
PIECES = 500_000
# New pieces that are encoded as one text.
JOINED = 1_000
# Characters that are cut and looked up at a time.
SPAN = 4_000_000
SPACE, LINE_END, MARKS = 32, 10, b".,!?;:"
# Neighbouring white space by any Unicode version's count.
DOUBLE_SPACE = re.compile("[\\s᠎​﻿]{2}")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces begin: at spaces, line ends, and marks between a letter up to U+023F and one of these."""
    ends = (data == SPACE) | (data == LINE_END)
    marks = np.nonzero(np.isin(data, np.frombuffer(MARKS, np.uint8)))[0]
    marks = marks[(marks > 1) & np.append(ends, True)[marks + 1]]
    last, lead = data[marks - 1], data[marks - 2]
    ascii_letter = ((last | 32) >= 97) & ((last | 32) <= 122)
    # two bytes: U+00C0 to U+023F are letters but for the signs of multiplication and division
    wide = (last >= 128) & (last < 192) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    ends[marks[ascii_letter | wide]] = True
    return np.nonzero(ends)[0]


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = re.compile("|".join(map(re.escape, added.values())) or "(?!)")
        vocabulary = {i: len(t) for t, i in self.tokenizer.get_vocab().items()}  # a character stands for a byte
        vocabulary.update((i, len(t.encode())) for i, t in added.items())
        self.width = np.zeros(max(vocabulary) + 1, np.int64)
        self.width[list(vocabulary)] = list(vocabulary.values())
        self.line_end = self.whole(["\n"])[0]
        marks = [bytes([m]) for m in MARKS]
        self._enter(pa.array(marks, pa.large_binary()), *self._each(marks))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _enter(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The table: pieces, their ids one after the other, and how many each has."""
        self.pieces, self.ids, self.sizes = pieces, ids, sizes

    def _each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each) of pieces encoded one by one."""
        ids = self.whole([(p[1:] if p[0] == LINE_END else p).decode() for p in pieces])
        ids = [self.line_end + x if p[0] == LINE_END else x for p, x in zip(pieces, ids)]
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same from one text of all pieces. As the ids' bytes are those of the text, it shows whether
        a piece, or the line end that it begins with, ends within a token; then they are encoded one by one."""
        text = b"".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.width[ids])
        edges = np.cumsum([len(p) for p in pieces])
        last = np.minimum(np.searchsorted(ends, edges), len(ends) - 1)
        lines = (edges - [len(p) - 1 for p in pieces])[[p[0] == LINE_END for p in pieces]]
        if not len(ends) or not np.array_equal(ends[last], edges) or not np.isin(lines, ends).all():
            return self._each(pieces)
        return ids, np.diff(last, prepend=-1)

    def _known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each piece begin, how many they are) of different pieces."""
        at = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(at.is_null())
        if len(new):
            listed = new.to_pylist()
            found = [self._new(listed[k:k + JOINED]) for k in range(0, len(listed), JOINED)]
            self._enter(pa.concat_arrays([self.pieces, new]), np.concatenate([self.ids, *(x for x, _ in found)]),
                        np.concatenate([self.sizes, *(x for _, x in found)]))
        numbers = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[numbers < 0] = np.arange(len(self.pieces) - len(new), len(self.pieces))
        firsts = np.cumsum(self.sizes) - self.sizes
        ids, firsts, sizes = self.ids, firsts[numbers], self.sizes[numbers]
        if len(self.pieces) > PIECES:
            kept = numbers if len(numbers) < PIECES // 2 else np.arange(0)
            kept = np.unique(np.append(np.arange(len(MARKS)), kept))  # the marks are never new
            of = np.zeros(len(self.pieces), bool)
            of[kept] = True
            self._enter(self.pieces.take(pa.array(kept)), ids[np.repeat(of, self.sizes)], self.sizes[kept])
        return ids, firsts, sizes

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of texts that can be cut, all in one buffer, a line end before each."""
        data = ("\n" + "\n".join(texts)).encode()
        starts = _cuts(np.frombuffer(data, np.uint8))
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        ids, firsts, sizes = self._known(cut.dictionary)
        which = cut.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        ids = ids[np.repeat(firsts[which] - ends + lengths, lengths) + np.arange(ends[-1])]
        # the piece that each text begins with, from which the line end's ids go
        first = np.searchsorted(starts, np.cumsum([0] + [len(t.encode()) + 1 for t in texts]))
        at = np.append(0, ends)[first]
        skip = len(self.line_end) // 4
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield ids[a + skip:b].tobytes()

    def _span(self, texts: list[str]) -> Iterator[bytes]:
        plain = [not DOUBLE_SPACE.search(t) and not self.added.search(t) for t in texts]
        whole = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
        cut = self._plain([t for t, p in zip(texts, plain) if p]) if any(plain) else iter(())
        return (next(cut if p else whole) for p in plain)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text in turn; a missing text has none."""
        span, chars = [], 0
        for text in texts:
            span.append(text or "")
            chars += len(span[-1])
            if chars > SPAN:
                yield from self._span(span)
                span, chars = [], 0
        yield from self._span(span)

    def encode_rows(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """Each row, whose last value is a text, with the text's ids in its place."""
        waiting = deque()

        def texts() -> Iterator[str | None]:
            for row in rows:
                waiting.append(row[:-1])
                yield row[-1]
        for ids in self.encode(texts()):
            yield (*waiting.popleft(), ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)
