"""Links inside groups of rows of any size: groups are compared in parts, what is joined already is not compared again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmood.llm.components import components
from threadmood.llm.shared import stored

#: Pairs that a task gathers before it gives out links that connect the same.
HELD_PAIRS = 500_000

LINKS = "u long, v long"
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])

#: (rows of whole groups, where each group begins and the last ends, which rows are open, a label
#: of what is joined already) to pairs of row numbers. Every two similar rows of a group, one of
#: them open, must be connected by the pairs and the labels.
Compare = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...] = ("group", "part")) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by the keys, in pieces that hold whole groups, and where these begin (and the last ends)."""
    held: list[pa.RecordBatch] = []

    def cut(rows: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
        batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        return batch, np.append(_begins(batch, keys), batch.num_rows)

    def key(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(name)[row].as_py() for name in keys]

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            yield cut(held)
            held = []
        last = int(_begins(batch, keys)[-1])
        if last:
            yield cut([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield cut(held)


def _begins(batch: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for name in keys:
        own = batch.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= own[1:] != own[:-1]
    return np.flatnonzero(new)


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links (u, v) connect, fewer than there are ids: each id with the smallest it is joined to."""
    ids, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root, before = np.arange(len(ids)), None
    while before is None or (root != before).any():
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
    joined = root != np.arange(len(ids))
    return ids[joined], ids[root[joined]]


def _links(rows: DataFrame, compare: Compare) -> DataFrame:
    def joined(pairs: list[np.ndarray]) -> pa.RecordBatch:
        u, v = spanning(*np.concatenate(pairs, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=_LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[np.ndarray] = []
        for batch, bounds in whole_groups(batches):
            if (np.diff(bounds) > 1).any():
                ids = batch.column("id").to_numpy()
                is_open = batch.column("open").to_numpy(zero_copy_only=False).astype(bool)
                a, b = compare(batch, bounds, is_open, batch.column("label").to_numpy())
                pairs.append(np.stack([ids[a], ids[b]]))
                if sum(own.shape[1] for own in pairs) > HELD_PAIRS:
                    yield joined(pairs)
                    pairs = []
        if pairs:
            yield joined(pairs)

    keys = ["group", "part"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "rank").mapInArrow(run, LINKS)


def _deal(parts: Column, salt: str) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt)), parts).cast("int")


def linked(rows: DataFrame, compare: Compare, part_rows: int, any_large: bool) -> DataFrame:
    """Links (u, v) that connect all similar rows of each group.

    rows: ``group`` (long), ``parts`` (into how many the group is dealt; the same on its rows),
    ``id`` (long), ``rank`` (low for what resembles many), and what ``compare`` reads.
    ``any_large`` says whether any group has more parts than one; rows are stored then.

    A group of one part is compared as a whole. Of a larger one each part is compared by itself
    and with the group's leader, its row of lowest rank. In a family that joins nearly all rows;
    the rest, all but the largest connected set of the group, is open, and is then compared with
    the others and with itself, in parts of ``part_rows`` again. So n rows of which o are open make
    n + o * n / part_rows rows, not n * n.
    """
    rows = rows.withColumn("open", F.lit(True)).withColumn("label", F.col("id"))
    if not any_large:
        return stored(_links(rows.withColumn("part", F.lit(0)), compare), "links")
    rows = stored(rows, "grouped")
    large = rows.where("parts > 1")
    leaders = large.groupBy("group").agg(F.max("parts").alias("parts"), F.min_by(F.struct(*large.columns), F.struct("rank", "id")).alias("row"))
    fields = [F.col(f"row.{name}").alias(name) for name in rows.columns]
    leaders = leaders.select("parts", "row", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(*fields, "part")
    dealt = rows.withColumn("part", _deal(F.col("parts"), "first"))
    first = stored(_links(dealt.unionByName(leaders), compare), "links")
    joined = components(first, "joined").withColumnsRenamed({"component": "label"})
    large = large.drop("label").join(joined, "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = large.groupBy("group", "label").agg(F.count("*").alias("n"))
    biggest = sizes.groupBy("group").agg(F.max(F.struct("n", "label")).alias("biggest"), F.sum("n").alias("n"))
    open_rows = F.col("n") - F.col("biggest.n")
    closed_parts, open_parts = (F.ceil(n / part_rows).cast("int") for n in (F.col("biggest.n"), open_rows))
    dealings = biggest.where(open_rows > 0).select("group", F.col("biggest.label").alias("big"), closed_parts.alias("closed"), open_parts.alias("opened"))
    large = large.join(dealings, "group").withColumn("open", F.col("label") != F.col("big"))
    pair = lambda one, other: F.concat_ws("-", one.cast("string"), other.cast("string"))
    own = _deal(F.when(F.col("open"), F.col("opened")).otherwise(F.col("closed")), "second")
    with_closed = F.transform(F.sequence(F.lit(0), F.col("closed") - 1), lambda other: pair(own, -1 - other))
    with_open = F.transform(F.sequence(F.lit(0), F.col("opened") - 1), lambda other: pair(F.least(own, other), F.greatest(own, other)))
    as_closed = F.transform(F.sequence(F.lit(0), F.col("opened") - 1), lambda other: pair(other, -1 - own))
    parts = F.when(F.col("open"), F.concat(with_closed, with_open)).otherwise(as_closed)
    again = large.withColumn("part", F.explode(parts)).drop("big", "closed", "opened")
    return first.unionByName(stored(_links(again, compare), "links"))
