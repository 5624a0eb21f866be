"""Packing of tokenised documents into training sequences of equal attention cost.

Documents are packed in blocks of about ``BLOCK_TOKENS`` tokens, each inside the task that reads
them: nothing is shuffled. A block of T tokens opens T div 4096 sequences of 4096 and, for the rest,
one sequence for each binary digit of T mod 4096, so the sequences hold T tokens exactly and none
needs padding. The cost of a piece of n tokens is ``n + n * n / QUADRATIC``: the layers' linear work
and attention inside the document. Pieces go, longest first, to the sequence of the lowest cost so far
that has room. One for which no sequence has room is cut to fill the roomiest.

Every document ends with ``END_ID``; null and empty texts are that id alone. Each row is a document
of its own, also where rows or ids repeat; ties go to the earlier row and sequence. A text of any
length is cut over as many sequences as it needs. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hiretide.llm.common import by_bytes, code_path, type_of
from hiretide.llm.token_counts import _json_tokenizer
from hiretide.llm.words import Words, blocks, split_words, word_hashes

SEQUENCE, END_ID = 4096, 2
BLOCK_TOKENS, QUADRATIC = 4 << 20, 2048.0
CACHED_WORDS, CACHED_BYTES, BATCH_BYTES = 1_000_000, 64 << 20, 4 << 20
SEPARATOR, JOINED = "0", 200


class WordEncoder:
    """Ids of texts whose tokens never reach over white space: each distinct word is encoded once by
    the library. Words are found by their 64-bit hashes in sorted arrays, some 30 bytes a word and its own
    bytes; these are compared before its ids are used, and a word that only shares a known one's hash
    goes to the library each time."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _json_tokenizer(path)
        mark = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, ascending, and the place of each in ``ends``
        self.place = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)
        self.bytes = np.zeros(0, np.uint8)  # of the words, in the order of ``ends``
        self.bytes_ends = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Words without the separator go to the library joined by it, many at a time: a digit
        between spaces is a token of its own, so its id shows where each word's ids end."""
        alone = np.array([self.mark is None or SEPARATOR in w for w in words], bool)
        order = np.argsort(alone, kind="stable")
        words = [words[i] for i in order.tolist()]
        raw = [x.encode() for x in words]
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(raw), np.uint8)])
        self.bytes_ends = np.concatenate([
            self.bytes_ends, self.bytes_ends[-1] + np.cumsum(list(map(len, raw)), dtype=np.int64)])
        apart, rest = words[:len(words) - int(alone.sum())], words[len(words) - int(alone.sum()):]
        if apart:
            joined = [f" {SEPARATOR} ".join([*apart[i:i + JOINED], ""])
                      for i in range(0, len(apart), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in
                                  self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
            marks = np.flatnonzero(ids == self.mark)
            self._add(np.delete(ids, marks), marks - np.arange(len(marks)))
        if rest:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self._add(np.fromiter(chain.from_iterable(found), np.uint32),
                      np.cumsum(list(map(len, found))))
        known = np.concatenate([self.known, hashes[order]])
        first = len(self.ends) - 1 - len(words)
        place = np.concatenate([self.place, np.arange(first, first + len(words))])
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], place[order]

    def _add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text. New words of all texts go to the library in one call."""
        w = split_words(column)
        hashes, first, which = np.unique(word_hashes(w, lower=False), return_index=True,
                                         return_inverse=True)
        new = np.flatnonzero(~self._has(hashes))
        if len(self.known) + len(new) > CACHED_WORDS or len(self.bytes) > CACHED_BYTES:
            self._clear()
            new = np.arange(len(hashes))
        if len(new):
            starts, stops = w.start[first[new]].tolist(), w.stop[first[new]].tolist()
            data = w.data.tobytes()
            self._learn(hashes[new], [data[a:b].decode() for a, b in zip(starts, stops)])
        at = self.place[np.searchsorted(self.known, hashes)][which]
        begin = self.ends[at]
        size = self.ends[at + 1] - begin
        stop = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(int(stop[-1])) + np.repeat(begin - stop[:-1], size)]
        cuts = stop[w.first].tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        other = np.unique(np.searchsorted(w.first, self._unlike(w, at), side="right") - 1)
        for i in other.tolist():  # texts with a word that another of the same hash stands for
            out[i] = np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
        return out

    def _unlike(self, w: Words, at: np.ndarray) -> np.ndarray:
        """The words that are not, byte by byte, the known ones at ``at``."""
        size, begin = w.stop - w.start, self.bytes_ends[at]
        same = size == self.bytes_ends[at + 1] - begin
        for a, b in blocks(w):
            own = np.flatnonzero(same[a:b]) + a
            first = np.cumsum(size[own]) - size[own]
            step = np.arange(int(size[own].sum())) - np.repeat(first, size[own])
            unlike = w.data[step + np.repeat(w.start[own], size[own])] != self.bytes[
                step + np.repeat(begin[own], size[own])]
            if unlike.any():
                same[own[np.unique(np.searchsorted(first, np.flatnonzero(unlike), side="right") - 1)]] = False
        return np.flatnonzero(~same)

    def _has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return self.known[at] == hashes


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def capacities(total: int, most: int = SEQUENCE) -> list[int]:
    """Lengths of sequences that hold ``total`` tokens without padding."""
    rest = total % most
    return [most] * (total // most) + [1 << k for k in reversed(range(most.bit_length()))
                                       if rest >> k & 1]


def pack(lengths: list[int], most: int = SEQUENCE,
         quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    room = np.array(capacities(sum(lengths), most), np.int64)
    filled, cost = np.zeros_like(room), np.zeros(len(room))
    pieces: list[tuple[int, int, int, int, int]] = []

    def place(doc: int, start: int, n: int, at: int) -> None:
        pieces.append((doc, start, n, at, int(filled[at])))
        filled[at] += n
        room[at] -= n
        cost[at] += n + n * n / quadratic

    waiting, full = [], 0
    for doc, n in enumerate(lengths):
        for k in range(n // most):  # a whole sequence each, and there are as many
            place(doc, k * most, most, full)
            full += 1
        if n % most:
            waiting.append((-(n % most), doc, n - n % most))
    heapq.heapify(waiting)
    while waiting:
        n, doc, start = heapq.heappop(waiting)
        fits = np.where(room >= -n, cost, np.inf)
        at = int(fits.argmin())
        if fits[at] == np.inf:
            at = int(room.argmax())
            cut = int(room[at])
            heapq.heappush(waiting, (n + cut, doc, start + cut))
            n = -cut
        place(doc, start, -n, at)
    return pieces


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per piece: id, ``start`` and ``length`` in the document's ids, their ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset`` there, and ``sequence_length``."""
    schema = T.StructType([T.StructField(id_col, type_of(df, id_col)), *(
        T.StructField(c, T.LongType()) for c in (
            "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
            "sequence_length"))])

    def block(ids: list, tokens: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(t) for t in tokens]
        pieces = pack(lengths)
        sizes = capacities(sum(lengths))
        columns = list(zip(*((
            s, n, zlib.crc32(tokens[d][s:s + n].astype("<u4").tobytes()), lengths[d],
            first + q, at, sizes[q]) for d, s, n, q, at in pieces)))
        docs = pa.concat_arrays(ids).take(pa.array([p[0] for p in pieces], pa.int64()))
        return pa.RecordBatch.from_arrays(
            [docs, *(pa.array(c, pa.int64()) for c in columns)], names=schema.names), len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        first = TaskContext.get().partitionId() << 33
        ids: list = []
        tokens: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
                ids.append(part.column(0))
                for own in encoder.encode(part.column(1)):
                    tokens.append(np.append(own, np.uint32(END_ID)))
                    size += len(tokens[-1])
                if size >= block_tokens:
                    out, n = block(ids, tokens, first)
                    yield out
                    ids, tokens, size, first = [], [], 0, first + n
        if tokens:
            yield block(ids, tokens, first)[0]

    code_path(df.sparkSession)
    return df.select(id_col, text_col).mapInArrow(run, schema)
