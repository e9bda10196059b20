"""Repeated passages by a distributed difference cover: sort sampled tuples, then the suffixes they leave, and compare neighbours.

Suffixes are ordered by fingerprints of their next bytes, which is enough to bring equal ones
together; ranks beyond the length of a passage are never needed, so the recursion on names ends
after one level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmood.llm import blocks as B
from threadmood.llm.shared import parts_of

PASSAGE = 200
#: A perfect difference cover: every number below PERIOD is the difference of two residues, modulo PERIOD.
PERIOD = 91
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
#: Bytes of a sampled tuple. Two equal passages at any places have a sampled place in common less
#: than PERIOD bytes after their beginnings, and that many equal bytes from there on.
TUPLE = PASSAGE - PERIOD + 1
#: Bytes of text gathered before equal texts of an input partition are joined.
GATHER_BYTES = 32_000_000

_SAMPLED = np.zeros(PERIOD, bool)
_SAMPLED[list(COVER)] = True
_ASK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("names", pa.binary())])
ASK = "part int, block int, names binary"
_ANSWER = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("again", pa.binary())])
ANSWER = "block int, part int, again binary"


class Texts:
    """The distinct texts of a block and how many rows have each."""

    def __init__(self, table: pa.Table):
        encoded = pc.dictionary_encode(pc.fill_null(table["text"].combine_chunks(), ""))
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.combine_chunks()
        self.texts = encoded.dictionary
        rows = encoded.indices.to_numpy(zero_copy_only=False)
        self.copies = np.bincount(rows, table["n"].to_numpy(), len(self.texts)).astype("int64")

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Bytes, bounds of texts and copies, a few texts at a time."""
        done = 0
        for own, data, bounds in B.blocks(pa.RecordBatch.from_arrays([self.texts], names=["t"]), 0):
            yield data, bounds, self.copies[done : done + own.num_rows]
            done += own.num_rows


def _samples(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sampled places with a whole tuple ahead of them in their text."""
    sizes = np.diff(bounds)
    inside = np.arange(len(data)) - np.repeat(bounds[:-1], sizes)
    fits = inside <= np.repeat(sizes - TUPLE, sizes)
    return np.flatnonzero(_SAMPLED[inside % PERIOD] & fits)


class Names:
    """Fingerprints of one kind over a block: distinct ones, sorted by part, and how each is answered."""

    def __init__(self, hashes: list[np.ndarray], weights: list[np.ndarray], parts: int, width: int):
        whole = np.concatenate(hashes) if hashes else np.zeros(0, "uint64")
        weight = np.concatenate(weights) if weights else np.zeros(0, "int64")
        # The part is the upper half, scaled, so names in order are in order of parts too. It is known
        # where a name is counted, so four bytes of the lower half may do to tell names apart.
        part = (whole >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        name = whole if width == 8 else whole & np.uint64(0xFFFFFFFF)
        key = whole if width == 8 else part << np.uint64(32) | name
        order = np.argsort(key)
        part, name, key = part[order], name[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        self.which = np.empty(len(whole), "int64")
        self.which[order] = np.cumsum(new) - 1
        self.part, self.name = part[new].astype("int64"), name[new]
        self.here = np.bincount(self.which, weight, len(self.part))
        self.width = width

    def _bounds(self) -> Iterator[tuple[int, int, int]]:
        if not len(self.part):
            return
        starts = np.flatnonzero(np.append(True, self.part[1:] != self.part[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(self.part)), strict=True):
            yield int(self.part[a]), int(a), int(b)

    def asked(self, block: int) -> pa.Table:
        rows = [(part, block, B.planes(np.diff(self.name[a:b], prepend=np.uint64(0)), self.width)) for part, a, b in self._bounds()]
        return pa.Table.from_pylist([dict(zip(_ASK.names, row, strict=True)) for row in rows], _ASK)

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """For each fingerprint given: whether it occurs twice or more, in this block or another."""
        again = self.here > 1
        for part, a, b in self._bounds():
            again[a:b] |= np.unpackbits(np.frombuffer(answers[part], "uint8"), count=b - a).astype(bool)
        return again[self.which]


def answer(asked: pa.Table, width: int) -> pa.Table:
    """To each block, for each name it asked: whether another block has it too."""
    names = [np.cumsum(B.from_planes(blob, width), dtype="uint64") for blob in asked["names"].to_pylist()]
    _, which, counts = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    shared = np.split(counts[which] > 1, np.cumsum([len(own) for own in names])[:-1])
    return pa.Table.from_pydict(
        {"block": asked["block"], "part": asked["part"], "again": [np.packbits(own).tobytes() for own in shared]}, _ANSWER
    )


def tuple_names(texts: Texts, parts: int) -> Names:
    hashes, weights = [], []
    for data, bounds, copies in texts.chunks():
        at = _samples(data, bounds)
        hashes.append(B.mixed(B.stretch_hashes(B.prefix_hashes(data), at, at + TUPLE)))
        weights.append(copies[np.searchsorted(bounds, at, "right") - 1])
    return Names(hashes, weights, parts, 4)


def passage_names(texts: Texts, tuples: np.ndarray, parts: int) -> tuple[Names, list[np.ndarray]]:
    """Passages that a repeated tuple could be part of, and where they begin in each chunk."""
    hashes, weights, places, done = [], [], [], 0
    for data, bounds, copies in texts.chunks():
        at = _samples(data, bounds)
        at, done = at[tuples[done : done + len(at)]], done + len(at)
        text = np.searchsorted(bounds, at, "right") - 1
        opens = np.bincount(np.maximum(at - PERIOD + 1, bounds[text]), minlength=len(data) + 1)
        closes = np.bincount(at + 1, minlength=len(data) + 1)
        begin = np.flatnonzero(np.cumsum((opens - closes)[:-1]) > 0)
        text = np.searchsorted(bounds, begin, "right") - 1
        fits = begin + PASSAGE <= bounds[text + 1]
        begin, text = begin[fits], text[fits]
        hashes.append(B.mixed(B.stretch_hashes(B.prefix_hashes(data), begin, begin + PASSAGE)))
        weights.append(copies[text])
        places.append(begin)
    return Names(hashes, weights, parts, 8), places


def removed_spans(texts: Texts, places: list[np.ndarray], repeated: np.ndarray) -> Iterator[dict]:
    """Per distinct text: its digest, bytes, the spans to remove, and what is kept."""
    done = 0
    for (data, bounds, _), begin in zip(texts.chunks(), places, strict=True):
        own, done = begin[repeated[done : done + len(begin)]], done + len(begin)
        marks = np.zeros(len(data) + 1, "int32")
        marks[own] += 1
        marks[own + PASSAGE] -= 1
        gone = np.cumsum(marks[:-1]) > 0
        opens, closes = gone.copy(), gone.copy()
        opens[1:] &= ~gone[:-1]
        closes[:-1] &= ~gone[1:]
        firsts, lasts = bounds[:-1][bounds[:-1] < len(data)], bounds[1:][bounds[1:] > 0] - 1
        opens[firsts] |= gone[firsts]
        closes[lasts] |= gone[lasts]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        first = np.searchsorted(starts, bounds)
        kept, raw = data[~gone].tobytes(), data.tobytes()
        kept_ends = np.append(0, np.cumsum(~gone))[bounds]
        for i in range(len(bounds) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            spans = [{"start": int(s) - a, "end": int(e) - a} for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
            yield {"key": hashlib.sha256(raw[a:b]).digest(), "n_bytes": b - a, "spans": spans, "kept": kept[kept_ends[i] : kept_ends[i + 1]]}


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema([("key", pa.binary()), ("n_bytes", pa.int64()), ("spans", _SPANS), ("kept", pa.binary())])
RESULT = "key binary, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def text_key(text_col: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def distinct_results(df: DataFrame, text_col: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_bytes, spans, kept) per distinct text; ``kept`` is the SHA-256 of the kept bytes if ``digest``.

    Equal texts of an input partition are joined while reading, then texts are dealt once by
    their hash, so copies meet in one block. Of every text the tuples at sampled places are
    named and sorted over the cluster; only passages around a tuple that occurs again are
    named and sorted themselves, and neighbours compared. A block tells the sorting parts its
    distinct names and learns by one bit each whether another block has them.
    """
    parts = 4 * parts_of(df)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            counts = pc.value_counts(pa.concat_arrays(held))
            return pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], names=["text", "n"])

        for batch in batches:
            held.append(pc.fill_null(batch.column(0), ""))
            size += held[-1].nbytes
            if size > GATHER_BYTES:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    texts = df.select(F.col(text_col).alias("text")).mapInArrow(joined, "text string, n long")
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")).repartition(parts, "block")

    def answers(told: pa.Table, level: int) -> dict[int, bytes]:
        return {row["part"]: row["again"] for row in told.to_pylist() if row["level"] == level}

    def ask_tuples(own: pa.Table) -> pa.Table:
        return tuple_names(Texts(own), parts).asked(own["block"][0].as_py())

    def ask_passages(own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _ASK.empty_table()
        texts = Texts(own)
        tuples = tuple_names(texts, parts).repeated(answers(told, 0))
        return passage_names(texts, tuples, parts)[0].asked(own["block"][0].as_py())

    def results(own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _RESULT.empty_table()
        texts = Texts(own)
        tuples = tuple_names(texts, parts).repeated(answers(told, 0))
        names, places = passage_names(texts, tuples, parts)
        rows = list(removed_spans(texts, places, names.repeated(answers(told, 1))))
        if digest:
            rows = [row | {"kept": hashlib.sha256(row["kept"]).digest()} for row in rows]
        return pa.Table.from_pylist(rows, _RESULT)

    def told(asks: DataFrame, width: int, level: int) -> DataFrame:
        answers = asks.groupBy("part").applyInArrow(lambda asked: answer(asked, width), ANSWER)
        return answers.withColumn("level", F.lit(level))

    # A block without a single tuple asks nothing, and cogroup gives it an empty answer.
    first = told(dealt.groupBy("block").applyInArrow(ask_tuples, ASK), 4, 0)
    second = told(dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(ask_passages, ASK), 8, 1)
    return dealt.groupBy("block").cogroup(first.unionByName(second).groupBy("block")).applyInArrow(results, RESULT)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, n_bytes, spans, kept) per row: ``spans`` are the removed [start, end) bytes of its text.

    A byte goes if a string of PASSAGE bytes that covers it also starts anywhere else, in the
    same text or another; all that is judged on the texts as given. NULL counts as an empty
    text; equal texts are repeats of each other, also in rows that are equal; NULL ids are
    kept; other columns are ignored; an empty table gives no rows. Names are 64-bit
    fingerprints; nothing is collected, and no group is larger than a block.
    """
    rows = df.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    found = distinct_results(df, text_col, digest)
    return rows.join(found, "key").select(F.col("id").alias(id_col), "n_bytes", "spans", "kept")


def without_repeats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with what is kept of the text; a character that is cut in part goes whole.

    A NULL text stays NULL.
    """
    found = distinct_results(df, text_col).select(F.col("key").alias("key_"), "kept")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [blob.decode("utf-8", "ignore") for blob in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key_", "kept_"])

    schema = T.StructType([T.StructField("key_", T.BinaryType()), T.StructField("kept_", T.StringType())])
    texts = found.mapInArrow(decoded, schema)
    columns = [
        F.when(F.col(c).isNotNull(), F.col("kept_")).alias(c) if c == text_col else F.col(c) for c in df.columns
    ]
    present = F.when(F.col(text_col).isNotNull(), F.lit(""))
    rows = df.withColumn("key_", text_key(text_col)).withColumn(text_col, present)
    return rows.join(texts, "key_").select(*columns)
