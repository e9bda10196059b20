"""Harmonic packing of token ids into sequences of fixed capacity."""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from threadmood.llm.blocks import UnitIds, blocks

CAPACITY = 1024
#: The id that ends every document.
END = 0
#: Bytes of text that a task encodes at a time (one text may be longer).
BLOCK_BYTES = 1_500_000
#: Sequences that wait to be filled, and rests kept to fill them, per worker.
WAITING = 64
#: A sequence is closed with at most this part of the capacity empty.
SLACK = 128
ID_BYTES = 4

_PIECE = [
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("tokens", T.BinaryType()),
    ("doc_tokens", T.LongType()),
    ("sequence_id", T.LongType()),
    ("offset", T.LongType()),
]


class TokenizerIds(UnitIds):
    """Ids of texts by a tokenizer file, whose pattern cuts ahead of a space as the units do."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one thread
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        sizes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), "int64")
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            sizes[i] = len(token)  # one character stands for one byte
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            sizes[i] = len(token.content.encode())
        super().__init__(sizes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = []
        for i in range(0, len(texts), 8):  # what the library holds per token is many times the id
            encoded = self.tokenizer.encode_batch_fast(texts[i : i + 8], add_special_tokens=False)
            lists += [np.array(x.ids, "int32") for x in encoded]
        return np.concatenate(lists), np.array([len(ids) for ids in lists], "int64")


class Bins:
    """The open sequences of one worker; workers never wait for each other.

    A document of at most ``capacity`` ids belongs to the class of its length, capacity // length,
    and a class's sequences take that many documents each, whole. Longer documents fill sequences
    of their own, and what is left of them, under one sequence, is kept to fill the room beside
    whole documents. Sequences that wait for that are few: beyond WAITING of them the next
    document is cut up instead, and beyond as many rests kept a rest is placed as a document is.
    Up to SLACK-th parts of a sequence may stay empty at its end.
    """

    def __init__(self, worker: int, capacity: int):
        self.next_id, self.capacity, self.slack = worker << 40, capacity, capacity // SLACK
        self.classes: dict[int, list[tuple]] = {}
        self.waiting: deque[list[tuple]] = deque()
        self.rests: deque[tuple] = deque()

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield (*piece, self.next_id, offset)
            offset += piece[2]
        self.next_id += 1

    def _room(self, pieces: list[tuple]) -> int:
        return self.capacity - sum(piece[2] for piece in pieces)

    def _fill(self) -> Iterator[tuple]:
        """Closes waiting sequences with ids from the rests, as far as these go."""
        while self.waiting and self.rests:
            held, rest = self.waiting[0], self.rests.popleft()
            room = self._room(held)
            head, tail = _split(rest, min(room, rest[2]))
            held.append(head)
            if tail:
                self.rests.appendleft(tail)
            if room - head[2] <= self.slack:
                yield from self._close(self.waiting.popleft())

    def _place(self, piece: tuple) -> Iterator[tuple]:
        count = self.capacity // piece[2]
        held = self.classes.setdefault(count, [])
        held.append(piece)
        if len(held) == count:
            del self.classes[count]
            if self._room(held) <= self.slack:
                yield from self._close(held)
            else:
                self.waiting.append(held)
                yield from self._fill()

    def add(self, document: tuple) -> Iterator[tuple]:
        """document: id, start, length, tokens, tokens of its document. Yields the pieces of sequences that are full."""
        long = document[2] > self.capacity
        rest = document
        while rest and rest[2] >= self.capacity:
            head, rest = _split(rest, self.capacity)
            yield from self._close([head])
        if not rest:
            return
        if len(self.waiting) >= WAITING or (long and len(self.rests) < WAITING):
            self.rests.append(rest)
            yield from self._fill()
        else:
            yield from self._place(rest)

    def finish(self) -> Iterator[tuple]:
        """What is left is laid end to end, cut where a sequence is full; the last one ends in powers of two."""
        left = [piece for held in [*self.waiting, *self.classes.values(), self.rests] for piece in held]
        self.waiting, self.classes, self.rests = deque(), {}, deque()
        total = sum(piece[2] for piece in left)
        pieces, at = deque(left), 0
        while at < total:
            size = min(self.capacity, 1 << ((total - at).bit_length() - 1))
            held, room = [], size
            while room:
                head, tail = _split(pieces[0], min(room, pieces[0][2]))
                pieces.popleft()
                if tail:
                    pieces.appendleft(tail)
                held.append(head)
                room -= head[2]
            yield from self._close(held)
            at += size


def _split(piece: tuple, length: int) -> tuple[tuple, tuple | None]:
    """The first ids of a piece, and the piece of all others, if any."""
    key, start, whole, tokens, total = piece
    if length == whole:
        return piece, None
    at = length * ID_BYTES
    return (key, start, length, tokens[:at], total), (key, start + length, whole - length, tokens[at:], total)


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: id, start, length, tokens (32-bit little-endian ids), doc_tokens, sequence_id, offset.

    A document is its ids by the tokenizer file at ``path`` (readable on every executor, no
    special tokens added), then id 0. ``capacity`` is a power of two. Each worker packs its own
    partition while reading: no shuffle, and it holds less than one sequence per class, WAITING
    that want filling and as many rests. At most one id in SLACK of a sequence is padding, and
    none in a worker's last sequences, whose lengths are powers of two. Sequence
    ids carry the partition, so a repeated task gives the same. A NULL or empty text is the one
    id 0; a long text becomes many full sequences and a rest, which may be cut on; a document of
    at most ``capacity`` ids is cut only to fill a sequence that no rest is there for, or at the
    worker's end; repeated rows are packed each; other columns are ignored; an empty table gives no rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenizerIds(path)
        bins = Bins(TaskContext.get().partitionId(), capacity)

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            ids, starts, lengths, tokens, totals, sequences, offsets = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, id_type),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(tokens, pa.binary()),
                    pa.array(totals, pa.int64()),
                    pa.array(sequences, pa.int64()),
                    pa.array(offsets, pa.int64()),
                ],
                names=[id_col, *(name for name, _ in _PIECE)],
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for own, data, bounds in blocks(batch, 1, BLOCK_BYTES):
                ids, starts = ids_of(data, bounds)
                ids = np.insert(ids, starts[1:], END).astype("<u4")
                starts = starts + np.arange(len(starts))
                whole, rows = ids.tobytes(), []
                for i, key in enumerate(own.column(0).to_pylist()):
                    blob = whole[ID_BYTES * starts[i] : ID_BYTES * starts[i + 1]]
                    total = len(blob) // ID_BYTES
                    rows += bins.add((key, 0, total, blob, total))
                if rows:
                    yield packed(rows)
        if rows := list(bins.finish()):
            yield packed(rows)

    schema = T.StructType([df.schema[id_col], *(T.StructField(name, kind) for name, kind in _PIECE)])
    return df.select(id_col, text_col).mapInArrow(run, schema)
