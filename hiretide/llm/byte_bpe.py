"""Byte-level BPE without regular expressions: token boundaries come from array scans.

Pre-tokenisation is a finite automaton over classes of code points. A class already holds the one
or two code points ahead that matter (white space before a word, a contraction such as ``'ll``), so
each code point is a function from states to states. Composing functions is associative. Most classes
fix the next state whatever came before; from these the state follows by one table lookup. Stretches
that hold an apostrophe are settled by a doubling scan that composes the functions themselves. Where
the function says a token starts, the bytes are cut; each distinct slice is merged by rank once and
its ids are kept. The offsets of the slices go with the ids, so that ids decode to the same bytes.

Null and empty texts have no ids. Rows are independent: ties, repeated rows and equal ids each give
one row. Texts of any length are done whole; a long slice without boundary is merged with a heap.
Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, by_bytes, type_of

BATCH_BYTES, CACHED_SLICES, CACHED_BYTES, HEAP_FROM = 4 << 20, 300_000, 64, 200

# Classes of code points, and the symbols they become when the next ones are known.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
(S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_SPACE_LAST, S_WHITE_LAST, S_WHITE,
 S_END) = range(9)
# States: nothing open; inside letters, numbers, others, white space; after a space that the next
# code point joins; one or two letters of a contraction to come.
FREE, IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, JOIN, ONE_MORE, TWO_MORE = range(8)
_WHITE_SPACE = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                0x205F, 0x3000]  # the Unicode property White_Space, fixed values; and the space

#: Letters and numbers that Unicode 16 added, fixed values, for interpreters with an older table.
_NEW_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
                (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x113B5),
                (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
                (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x1E5D0, 0x1E5ED),
                (0x1E5F0, 0x1E5F0))
_NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
                (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
_GAPS = (0x105CA, 0x1138A, 0x1138C, 0x1138D, 0x1138F, 0x113B6)  # unassigned inside these ranges


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """``step[symbol, state]``: the next state; ``starts[symbol, state]``: a token starts here."""
    step, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, inside in ((S_LETTER, IN_LETTER), (S_NUMBER, IN_NUMBER), (S_OTHER, IN_OTHER),
                           (S_WHITE, IN_WHITE)):
        step[symbol] = inside
        starts[symbol, inside] = False
        starts[symbol, JOIN] = symbol == S_WHITE
    step[S_LETTER, [ONE_MORE, TWO_MORE]] = FREE, ONE_MORE
    starts[S_LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, after in ((S_SHORT, ONE_MORE), (S_LONG, TWO_MORE)):
        step[symbol] = after
        step[symbol, [IN_OTHER, JOIN]] = IN_OTHER  # not at a token's start: no contraction
        starts[symbol, [IN_OTHER, JOIN]] = False
    step[S_SPACE_LAST], step[S_WHITE_LAST], step[S_END] = JOIN, FREE, FREE
    return step, starts


STEP, STARTS = _automaton()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            table[code] = kind
    for kind, ranges in ((LETTER, _NEW_LETTERS), (NUMBER, _NEW_NUMBERS)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[list(_GAPS)] = OTHER
    table[_WHITE_SPACE] = WHITE
    table[32] = SPACE
    return table


def _symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of the code points of texts that each end with one place of their own (``ends``)."""
    kind = _classes()[codes]
    symbol = np.choose(kind, [S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_WHITE]).astype(np.uint8)
    solid = kind < SPACE
    solid[ends] = False
    last = np.zeros(len(codes), bool)
    last[:-1] = solid[1:]
    symbol[last & (kind == SPACE)] = S_SPACE_LAST
    symbol[last & (kind == WHITE)] = S_WHITE_LAST
    quote = np.flatnonzero(codes == ord("'"))
    if len(quote):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        symbol[quote[short]], symbol[quote[long]] = S_SHORT, S_LONG
    symbol[ends] = S_END
    return symbol


def composed(functions: np.ndarray, longest: int) -> np.ndarray:
    """Inclusive scan: row i becomes the composition of the functions up to i, by doubling, when
    no function depends on more than the ``longest`` before it."""
    reach = 1
    while reach < longest:
        later = functions.copy()
        later[reach:] = np.take_along_axis(functions[reach:], functions[:-reach], axis=1)
        functions, reach = later, reach * 2
    return functions


def token_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a token starts at each code point; places in ``ends`` stand after each text."""
    symbol = _symbols(codes, ends)
    before = np.empty_like(symbol)
    before[0], before[1:] = S_END, symbol[:-1]
    # Entry states where the symbol before leaves one state only, apart from contractions.
    state = STEP[:, FREE][before]
    quoted = (symbol == S_SHORT) | (symbol == S_LONG)
    if quoted.any():
        # Stretches begin after a symbol whose function is constant.
        constant = (symbol >= S_SPACE_LAST)
        stretch = np.cumsum(constant)
        hit = np.zeros(int(stretch[-1]) + 1, bool)
        hit[stretch[quoted]] = True
        chosen = np.flatnonzero(hit[stretch])
        part = symbol[chosen]
        lengths = np.bincount(stretch[chosen])
        entry = composed(STEP[part], int(lengths.max()))[:, FREE]
        # A stretch at the very beginning has no constant symbol before it: it starts free.
        state[chosen[1:]] = np.where(constant[chosen[1:]], state[chosen[1:]], entry[:-1])
        if not constant[0] and chosen[0] == 0:
            state[0] = FREE
    return STARTS[symbol, state]


@dataclass
class Slices:
    """Tokens' bytes are ``data[offsets[i]:offsets[i + 1]]``; ``first[t]``: the first one of text t."""

    data: bytes
    offsets: np.ndarray
    first: np.ndarray


def slices(texts: list[str]) -> Slices:
    codes = np.frombuffer("\x00".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    starts = token_starts(codes, ends)
    starts[ends] = False
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    width[ends] = 0
    place = np.cumsum(width) - width
    at = np.flatnonzero(starts)
    data = "".join(texts).encode()
    return Slices(data, np.append(place[at], len(data)),
                  np.searchsorted(at, np.concatenate([[0], ends])))


class Ranks:
    """Merges by rank, with the ids of short slices kept."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.kept: dict[bytes, list[int]] = {}
        self.older: dict[bytes, list[int]] = {}

    def ids(self, piece: bytes) -> list[int]:
        """Ids of one slice."""
        found = self.kept.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                rank = self.ranks.get(piece)
                found = [rank] if rank is not None else self.merged(piece)
            if len(piece) <= CACHED_BYTES:
                if len(self.kept) >= CACHED_SLICES:
                    self.kept, self.older = {}, self.kept
                self.kept[piece] = found
        return found

    def merged(self, piece: bytes) -> list[int]:
        if len(piece) > HEAP_FROM:
            return self._merged_by_heap(piece)
        ranks, none = self.ranks, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != none:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merged_by_heap(self, piece: bytes) -> list[int]:
        """The same in n log n: lowest rank first, leftmost among equals, neighbours by links."""
        ranks, n = self.ranks, len(piece)
        stop = list(range(1, n + 1))  # of the part that begins at i; 0 once it is gone
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1)
                if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if stop[a] != b or b >= n or stop[b] != c:
                continue
            stop[a], stop[b] = c, 0
            if c < n:
                left[c] = a
                if (r := ranks.get(piece[a:stop[c]])) is not None:
                    heapq.heappush(heap, (r, a, c, stop[c]))
            if left[a] >= 0 and (r := ranks.get(piece[left[a]:c])) is not None:
                heapq.heappush(heap, (r, left[a], a, c))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at:stop[at]]])
            at = stop[at]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def encode_texts(texts: list[str], path: str) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
    """Per text: ids, byte offsets of its slices (and the end), and the number of ids of each."""
    cut, ranks, out = slices(texts), ranks_of(path), []
    data, ends = cut.data, cut.offsets.tolist()
    for a, b in zip(cut.first.tolist(), cut.first.tolist()[1:]):
        lists = [ranks.ids(data[x:y]) for x, y in zip(ends[a:b], ends[a + 1:b + 1])]
        ids = [i for found in lists for i in found]
        out.append((ids, cut.offsets[a:b + 1] - cut.offsets[a],
                    np.fromiter(map(len, lists), np.int64, len(lists))))
    return out


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids``, ``offsets`` of the pre-token slices in the text's UTF-8 bytes with the
    end, and ``ids_per_slice``."""

    def run(batch: pa.RecordBatch):
        for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
            done = encode_texts([t or "" for t in part.column(1).to_pylist()], path)
            yield [part.column(0), *([x[k] for x in done] for k in range(3))]

    return arrow_map(df.select(id_col, text_col), run, [
        (id_col, type_of(df, id_col)), ("ids", T.ArrayType(T.LongType())),
        ("offsets", T.ArrayType(T.LongType())), ("ids_per_slice", T.ArrayType(T.LongType()))])


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that its ids stand for."""

    def run(batch: pa.RecordBatch):
        ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
        yield [*batch.columns, [ranks_of(path).decode(i or []) for i in ids]]

    return arrow_map(encoded, run, [*((c, type_of(encoded, c)) for c in encoded.columns),
                                    ("decoded", T.BinaryType())])


def digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, and SHA-256 of the ids (32 bits each) and of what they decode to."""

    def run(batch: pa.RecordBatch):
        ranks = ranks_of(path)
        for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
            done = [x[0] for x in encode_texts([t or "" for t in part.column(1).to_pylist()], path)]
            yield [part.column(0), [len(i) for i in done],
                   [hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for i in done],
                   [hashlib.sha256(ranks.decode(i)).hexdigest() for i in done]]

    return arrow_map(df.select(id_col, text_col), run, [
        (id_col, type_of(df, id_col)), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
        ("decoded_sha256", T.StringType())])
