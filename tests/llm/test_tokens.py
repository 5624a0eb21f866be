import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from hiretide.llm import byte_bpe, packing, token_counts

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
WORD = P.path("word_bpe_49k.json")
BYTE = P.path("byte_bpe_50k.json")
PARTS = ["'s", "'", "l", "ll", "'re", "'ve", " ", "  ", "\n", "\t", "a", "Z", "1", "९", "!", "é", "中", "🙂",
         "　", "\x85", "\x1c", "​", "'d", "\r\n", "́", "ß", "<|endoftext|>", "\x00", "0 "]
ODD = ["", "  ", " a\n\n b", "don't STOP　now\x1cb", "x" * 5000 + " y", "ΑΣ ΑΣΑ Σ", "'" * 1000 + "s",
       "1234 5,6 0 a0b 00 'll we'll", "a b\tc\r\nd", "İ İ", "a ́b\ńc", "ab" * 3000,
       "x" * 300 + " " * 500 + "y" * 700, "日本語 テキスト 🙂👍🏽 a​b", "<|startoftext|>x<|endoftext|>"]


@pytest.fixture(scope="module")
def texts(docs):
    chosen = random.Random(5)
    mixed = ["".join(chosen.choice(PARTS) for _ in range(chosen.randint(0, 25))) for _ in range(4000)]
    return ODD + mixed + [r.text for r in docs.collect()]


@pytest.fixture(scope="module")
def library():
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_round_trip(texts, library):
    ranks = byte_bpe.ranks_of(MULTI)
    for text, (ids, offsets, per) in zip(texts, byte_bpe.encode_texts(texts, MULTI)):
        assert ids == library.encode_ordinary(text)
        data, at = text.encode(), 0
        assert ranks.decode(ids) == data and offsets[-1] == len(data)
        for a, b, n in zip(offsets, offsets[1:], per):  # each slice decodes by itself
            assert ranks.decode(ids[at:at + n]) == data[a:b]
            at += n


def test_every_code_point_has_the_class_the_library_gives_it(library):
    points = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    for before, after in (("a", "a"), ("1", "1"), (" ", ""), ("!", "!")):
        probes = [before + c + after for c in points]
        for probe, got in zip(probes, byte_bpe.encode_texts(probes, MULTI)):
            assert got[0] == library.encode_ordinary(probe)


def test_scan_equals_stepping_through_the_states():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 9, 3000).astype(np.uint8)
    state, wanted = 0, []
    for s in symbols:
        state = byte_bpe.STEP[s, state]
        wanted.append(state)
    got = byte_bpe.composed(byte_bpe.STEP[symbols], len(symbols))[:, 0]
    assert got.tolist() == wanted


def test_merging_with_and_without_heap_agree():
    ranks = byte_bpe.ranks_of(MULTI)
    chosen = random.Random(3)
    for _ in range(300):
        piece = bytes(chosen.choice(b"aabbcth e\xc3\xa9") for _ in range(chosen.randint(2, 150)))
        assert ranks._merged_by_heap(piece) == ranks.merged(piece)


def test_digest_over_documents(docs, edge_docs, no_docs, library):
    for frame in (docs, edge_docs):
        rows = byte_bpe.digest(frame, MULTI).collect()
        wanted = []
        for r in frame.collect():
            ids = library.encode_ordinary(r.text or "")
            wanted.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                           hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))
    assert byte_bpe.digest(no_docs, MULTI).collect() == []


def test_encode_then_decode(edge_docs):
    encoded = byte_bpe.encode(edge_docs, MULTI)
    got = byte_bpe.decode(encoded, MULTI).collect()
    assert sorted(bytes(r.decoded) for r in got) == sorted(
        (r.text or "").encode() for r in edge_docs.collect())


def test_counts_are_the_library_s(texts, docs, edge_docs, no_docs):
    t = Tokenizer.from_file(BYTE)
    wanted = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_counts.count_tokens(texts, BYTE).tolist() == wanted
    for text in texts[:500]:
        assert "".join(token_counts.safe_pieces(text, 5)) == text
        assert sum(len(t.encode(p, add_special_tokens=False).ids)
                   for p in token_counts.safe_pieces(text, 5)) == len(
            t.encode(text, add_special_tokens=False).ids)
    for frame in (docs, edge_docs):
        got = token_counts.token_counts(frame, BYTE).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
            (str(r.doc_id), len((r.text or "").encode()), n, n > 512) for r in frame.collect()
            for n in [len(t.encode(r.text or "", add_special_tokens=False).ids)])
    assert token_counts.token_counts(no_docs, BYTE).collect() == []


def test_word_encoder_is_the_library(texts):
    t, own = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    for text, got in zip(texts, own.encode(pa.array(texts))):
        assert got.tolist() == t.encode(text, add_special_tokens=False).ids


def test_words_of_equal_hash_keep_their_own_ids(texts, monkeypatch):
    real = packing.word_hashes
    monkeypatch.setattr(packing, "word_hashes", lambda w, lower: real(w, lower) % np.uint64(50))
    t, own = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    for part in (texts[:300], texts[100:400]):
        for text, got in zip(part, own.encode(pa.array(part))):
            assert got.tolist() == t.encode(text, add_special_tokens=False).ids


def test_mirrored_long_words_keep_their_own_ids():
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    t, own = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    for text, got in zip([a, b, f"{b} {a}"], own.encode(pa.array([a, b, f"{b} {a}"]))):
        assert got.tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("total", [0, 1, 4095, 4096, 4097, 12_345])
def test_capacities_need_no_padding(total):
    sizes = packing.capacities(total)
    assert sum(sizes) == total
    assert all(s == 4096 or s & (s - 1) == 0 for s in sizes)


def check_pieces(rows, tokens):
    """Every id in one piece; sequences gapless and full."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r.start)
        at = 0
        for r in own:
            ids = tokens[doc]
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(tokens[doc])
    assert set(by_doc) == set(tokens)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at == own[0].sequence_length and (at == 4096 or at & (at - 1) == 0)


def test_packing_covers_every_id(docs):
    t = Tokenizer.from_file(WORD)
    tokens = {r.doc_id: [*t.encode(r.text, add_special_tokens=False).ids, 2] for r in docs.collect()}
    check_pieces(packing.pack_documents(docs, WORD).collect(), tokens)
    check_pieces(packing.pack_documents(docs, WORD, block_tokens=9000).collect(), tokens)


def test_packing_edges(edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs.filter("doc_id > 1"), WORD).collect()
    t = Tokenizer.from_file(WORD)
    check_pieces(rows, {r.doc_id: [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
                        for r in edge_docs.filter("doc_id > 1").collect()})
    # Rows of one id and of none are documents of their own: each id's pieces are those of its rows.
    named = {}
    for r in packing.pack_documents(edge_docs.filter("doc_id IS NULL OR doc_id = 1"), WORD).collect():
        named.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    whole = {}
    for r in edge_docs.filter("doc_id IS NULL OR doc_id = 1").collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
        whole.setdefault(r.doc_id, []).append(ids)
    for ident, docs_ in whole.items():
        assert sum(n for _, n, _, _ in named[ident]) == sum(map(len, docs_))
        assert {k for _, _, _, k in named[ident]} == {len(d) for d in docs_}
        assert all(any(crc == zlib.crc32(np.array(d[a:a + n], "<u4").tobytes()) for d in docs_)
                   for a, n, crc, _ in named[ident])
    assert packing.pack_documents(no_docs, WORD).collect() == []


def test_costs_are_balanced():
    chosen = random.Random(2)
    lengths = [min(1500, int(chosen.lognormvariate(6, 1)) + 1) for _ in range(4000)]
    cost = {}
    for doc, _, n, at, _ in packing.pack(lengths):
        cost[at] = cost.get(at, 0) + n + n * n / packing.QUADRATIC
    whole = [cost[i] for i, s in enumerate(packing.capacities(sum(lengths))) if s == 4096]
    order = {}  # against filling one sequence after another with the same documents
    at = 0
    for n in sorted(lengths, reverse=True):
        while n:
            part = min(n, 4096 - at % 4096)
            order[at // 4096] = order.get(at // 4096, 0) + part + part * part / packing.QUADRATIC
            at, n = at + part, n - part
    assert np.std(whole) < 0.1 * np.std(list(order.values()))
    assert max(whole) <= 4096 + 4096 * 4096 / packing.QUADRATIC
