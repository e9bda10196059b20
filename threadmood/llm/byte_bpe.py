"""Byte-level BPE: encoding by replaying merges over all distinct units of a block, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from threadmood.llm.blocks import UnitIds, blocks, gathered

#: Lists decoded at a time by one task.
BLOCK_ROWS = 500

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """The rank file: on each line a token in base64 and its rank, which is also its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Which pairs of ids merge, in what order, into which id."""

    def __init__(self, byte_ids: list[int], pairs: dict[tuple[int, int], tuple[int, int]]):
        """byte_ids: the id of each byte. pairs: (left, right) to (rank, id)."""
        self.byte_ids = np.array(byte_ids, "int64")
        keys = np.array([left << 32 | right for left, right in pairs] or [-1], "int64")
        order = np.argsort(keys)
        self.keys = keys[order]
        ranks = np.array([rank for rank, _ in pairs.values()] or [NONE], "int64")
        self.ranks = ranks[order]
        self.made = dict(pairs.values())

    @classmethod
    def of_ranks(cls, ranks: Ranks) -> Merges:
        """Any two tokens whose bytes together are a token merge into it, at its rank."""
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left, right] = (rank, rank)
        return cls([ranks[bytes([b])] for b in range(256)], pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where the two ids do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


#: No merge; an end of a word; a symbol swallowed by its left neighbour.
NONE, WORD_END, GONE = 1 << 40, -1, -2


def replay_merges(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and where each word's ids begin (and the last end).

    All words lie in one row of symbols. An inverted index leads from the rank of a merge to
    the places of its pairs; the ranks are replayed from the lowest over all words at once, and
    a merge looks only at its two neighbours. In each word the leftmost place comes first, and
    the others wait: if the merge has made a pair of lower rank, that one goes ahead of them.
    """
    sizes = np.fromiter(map(len, words), "int64", len(words))
    ends = np.cumsum(sizes + 1) - 1
    row = np.full(int(sizes.sum()) + len(words) + 1, WORD_END, "int64")
    inside = np.ones(len(row), bool)
    inside[ends] = inside[-1] = False
    row[inside] = merges.byte_ids[np.frombuffer(b"".join(words), "uint8")]
    word = np.repeat(np.arange(len(words) + 1), np.append(sizes + 1, 1))
    after, before = np.arange(1, len(row) + 1), np.arange(-1, len(row) - 1)

    first = merges.rank(row[:-1], row[1:])
    places: dict[int, list[int]] = {}
    found = np.flatnonzero(first < NONE)
    found = found[np.argsort(first[found], kind="stable")]
    ranks, starts = np.unique(first[found], return_index=True)
    for rank, own in zip(ranks.tolist(), np.split(found, starts[1:]), strict=False):
        places[rank] = [own]
    queue = ranks.tolist()  # sorted, so a heap
    while queue:
        rank = heapq.heappop(queue)
        own = np.sort(np.concatenate(places.pop(rank)))
        own = own[row[own] >= 0]
        own = own[merges.rank(row[own], row[after[own]]) == rank]
        leftmost = np.ones(len(own), bool)
        in_word = word[own]
        leftmost[1:] = in_word[1:] != in_word[:-1]
        rest, own = own[~leftmost], own[leftmost]
        swallowed = after[own]
        right = after[swallowed]
        row[own], row[swallowed] = merges.made[rank], GONE
        after[own], before[right] = right, own
        left = before[own]
        left = left[(left >= 0) & (row[left] >= 0)]
        touched = np.concatenate([left, own, rest])
        new = merges.rank(row[touched], row[after[touched]])
        new[len(touched) - len(rest) :] = rank
        touched, new = touched[new < NONE], new[new < NONE]
        if len(touched):
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
            heads = new[np.append(0, cuts)].tolist()
            bounds = [0, *cuts.tolist(), len(new)]
            for i, at in enumerate(heads):
                if at not in places:
                    places[at] = []
                    heapq.heappush(queue, at)
                places[at].append(touched[bounds[i] : bounds[i + 1]])
    kept = row >= 0
    return row[kept], np.append(0, np.cumsum(kept)[ends])


class Encoder(UnitIds):
    """Ids of texts by replaying merges over the distinct words of their fresh units."""

    def __init__(self, ranks: Ranks, pattern: str):
        sizes = np.zeros(max(ranks.values()) + 1, "int64")
        sizes[list(ranks.values())] = [len(token) for token in ranks]
        super().__init__(sizes)
        self.merges, self.matches = Merges.of_ranks(ranks), regex.compile(pattern).findall

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], []
        for text in texts:
            words += (own := self.matches(text))
            counts.append(len(own))
        index: dict[str, int] = {}
        which = np.array([index.setdefault(word, len(index)) for word in words], "int64")
        ids, starts = replay_merges([word.encode() for word in index], self.merges)
        sizes = np.diff(starts)[which]
        before = np.append(0, np.cumsum(sizes))
        return gathered(ids, starts[which], sizes), np.diff(before[np.append(0, np.cumsum(counts, dtype="int64"))])


class Decoder:
    """Bytes of id lists, gathered from the tokens laid end to end."""

    def __init__(self, ranks: Ranks):
        token = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            token[rank] = word
        self.sizes = np.array([len(word) for word in token], "int64")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(token), "uint8")

    def __call__(self, lists: pa.ListArray) -> pa.Array:
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = self.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        out = gathered(self.bytes, self.starts[ids], sizes)
        counts = np.append(0, np.cumsum([0 if n is None else n for n in lists.value_lengths().to_pylist()])).astype("int64")
        bounds = pa.py_buffer(ends[counts].astype("int64").tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, bounds, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def encode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) per row: the ids that the rank file at ``path`` gives the whole text.

    ``path`` must be readable on every executor. ``pattern`` cuts a text into words, each
    merged separately; there are no special tokens. Rows stay where they are: no shuffle. A
    NULL or empty text gives an empty list; repeated rows and NULL ids are kept; other columns
    are ignored; an empty table gives an empty result. A text of any length takes time in
    proportion to its length times the logarithm of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(path), pattern)
        for batch in batches:
            for own, data, bounds in blocks(batch, 1):
                ids, starts = encoder(data, bounds)
                lists = pa.ListArray.from_arrays(starts.astype("int32"), pa.array(ids))
                yield pa.RecordBatch.from_arrays([own.column(0), lists], names=[id_col, "ids"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, bytes binary) per row: the bytes that the ids stand for; a NULL list gives no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(path))
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(start, BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), decoder(own.column(1))], names=[id_col, ids_col, "bytes"]
                )

    schema = T.StructType([df.schema[id_col], df.schema[ids_col], T.StructField("bytes", T.BinaryType())])
    return df.select(id_col, ids_col).mapInArrow(run, schema)
