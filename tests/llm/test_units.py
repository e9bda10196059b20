"""Byte-level BPE and packing."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import cases
from threadmood.llm import blocks, byte_bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    encoding = library()
    want = Counter((r.doc_id, tuple(encoding.encode_ordinary(r.text or ""))) for r in docs.select("doc_id", "text").collect())
    ids = byte_bpe.encode(docs, RANKS, PATTERN)
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids.collect()) == want
    decoded = Counter((r.doc_id, bytes(r.bytes)) for r in byte_bpe.decode(ids, RANKS).collect())
    assert decoded == Counter((r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect())


ENCODER, LIBRARY = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), PATTERN), library()
TEXTS = st.lists(st.text(st.sampled_from("ab eé\n\t 　\x85\xa01²'s.,!<|>日"), max_size=40), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_any_white_space_and_repetition(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    for _, data, bounds in blocks.blocks(batch, 0):
        ids, starts = ENCODER(data, bounds)
    found = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert found == [LIBRARY.encode_ordinary(text) for text in texts]


def test_a_lower_rank_made_by_a_merge_comes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 260, b"bcd": 290, b"aba": 270}
    for word in (b"abcd", b"ababc", b"abab", b"abcabcd", b"aaabbb"):
        [own] = [byte_bpe.replay_merges([word], byte_bpe.Merges.of_ranks(ranks))[0].tolist()]
        encoding = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
        assert own == encoding.encode_ordinary(word.decode())


def test_empty_tables(spark):
    assert byte_bpe.decode(byte_bpe.encode(cases.empty(spark), RANKS, PATTERN), RANKS).count() == 0
    assert packing.pack(cases.empty(spark), TOKENIZER).count() == 0


def test_pieces_hold_every_id_once_without_padding(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id, np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    rows = packing.pack(docs, TOKENIZER).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id, r.doc_tokens].append((r.start, r.length, bytes(r.tokens)))
        assert len(r.tokens) == 4 * r.length > 0
    by_document = defaultdict(list)
    for (i, blob), n in want.items():
        by_document[i, len(blob) // 4] += [blob] * n
    assert set(documents) == set(by_document)
    for key, blobs in by_document.items():
        # Rows of one id and length lie over each other: every id of each of them is in one piece.
        pieces, total = Counter(), Counter()
        for start, length, tokens in documents[key]:
            pieces.update((start + k, tokens[4 * k : 4 * k + 4]) for k in range(length))
        for blob in blobs:
            total.update((k, blob[4 * k : 4 * k + 4]) for k in range(len(blob) // 4))
        assert pieces == total
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert packing.CAPACITY - packing.CAPACITY // packing.SLACK <= at <= packing.CAPACITY or at & (at - 1) == 0


def test_documents_that_fit_stay_whole_and_padding_is_little(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = packing.pack(docs, TOKENIZER).collect()
    pieces = Counter(r.doc_id for r in rows if r.doc_tokens <= packing.CAPACITY)
    assert sum(pieces.values()) < 1.5 * len(pieces)
    used, sequences = sum(r.length for r in rows), Counter()
    for r in rows:
        sequences[r.sequence_id] += r.length
    room = sum(n if n & (n - 1) == 0 else packing.CAPACITY for n in sequences.values())
    assert used > 0.98 * room


@pytest.mark.parametrize("lengths", [[300] * 400, [9] * 5000, [600, 17] * 300, [1024] * 5, [5000, 3], [513] * 200, [1] * 3000])
def test_bins_take_a_fixed_count_of_whole_documents(lengths):
    bins, out = packing.Bins(3, 1024), []
    for i, size in enumerate(lengths):
        out += bins.add((i, 0, size, bytes(4 * size), size))
        held = [*bins.waiting, *bins.classes.values(), bins.rests]
        assert len(bins.waiting) <= packing.WAITING and len(bins.rests) <= packing.WAITING + 1
        assert len(held) <= packing.WAITING + 65
        assert all(len(own) < count for count, own in bins.classes.items())
    out += bins.finish()
    placed, sequences = defaultdict(list), Counter()
    for i, start, size, tokens, total, sequence, offset in out:
        assert len(tokens) == 4 * size and total == lengths[i] and sequence >> 40 == 3 and offset == sequences[sequence]
        placed[i].append((start, size))
        sequences[sequence] += size
    for i, size in enumerate(lengths):
        at = 0
        for start, length in sorted(placed[i]):
            assert start == at
            at += length
        assert at == size
    assert all(n <= 1024 and (n >= 1016 or n & (n - 1) == 0) for n in sequences.values())
