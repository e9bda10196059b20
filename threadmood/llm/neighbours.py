"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances at the end."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from threadmood.llm.shared import stored

NEAREST = 5
#: Rows that the distance to a neighbour is estimated on, those with the smallest hash of their id.
SAMPLE_ROWS = 2000
TABLES = 2
#: A table's buckets are visited until the estimated chance to have met a neighbour reaches this.
SUCCESS = 0.82
WIDTH = 1.0
#: Distances below this count as this.
LEAST_DISTANCE = 0.1
#: Rows meant for a bucket at most. More functions make more and smaller buckets, and as many more to visit.
BUCKET_ROWS = 5000
#: Rows and queries of a bucket that one group compares, on average, and numbers in the rows' vectors; then
#: rows and queries that are compared at a time.
PART_ROWS, PART_QUERIES, PART_NUMBERS = 50_000, 20_000, 6_400_000
SLICE_ROWS, SLICE_QUERIES = 10_000, 200
LEAST_FUNCTIONS, MOST_FUNCTIONS = 3, 5


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """As double precision; None for what takes no part: NULL, empty, zero, NULL or non-finite components."""
    out = []
    for value in column:
        own = None
        if value.is_valid and not value.values.null_count:
            own = np.asarray(value.values.to_numpy(zero_copy_only=False), float)
            if not len(own) or not np.isfinite(own).all() or not own.any():
                own = None
        out.append(own)
    return out


def _unit(vector: np.ndarray) -> np.ndarray:
    vector = vector / np.abs(vector).max()
    return vector / np.sqrt((vector * vector).sum())


def _functions(dim: int, table: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([dim, table])
    return random.normal(size=(dim, count)), random.uniform(0, WIDTH, count)


def probes(fraction: np.ndarray, distance: float) -> np.ndarray:
    """Offsets of buckets in the order of their estimated chance, until that adds up to SUCCESS.

    ``fraction`` is where the query lies inside its own bucket. A neighbour's projection
    differs by a normal number with ``distance`` as deviation, in each function on its own.
    """
    reach = math.ceil(3 * distance / WIDTH)
    steps = np.arange(-reach, reach + 2)
    normal = np.vectorize(lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2))))
    below = normal((steps[None, :] - fraction[:, None]) * WIDTH / distance)
    chances = np.diff(below, axis=1)
    whole = chances[0]
    for own in chances[1:]:
        whole = np.multiply.outer(whole, own)
    flat = whole.ravel()
    order = np.argsort(-flat, kind="stable")
    enough = int(np.searchsorted(np.cumsum(flat[order]), SUCCESS)) + 1
    return np.stack(np.unravel_index(order[:enough], whole.shape), axis=1) - reach


def _key(dim: int, table: int, cells: np.ndarray) -> list[str]:
    return [f"{dim}:{table}:" + ",".join(map(str, cell)) for cell in cells.tolist()]


def _typical_distance(rows: DataFrame) -> float:
    """Median distance, between unit vectors, to the fifth neighbour within a bounded sample.

    The sample is thinner than the table, so its distances are larger and the search goes rather too far.
    """
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    found = []
    for dim in {len(row["vector"]) for row in sample}:
        own = np.array([_unit(np.array(row["vector"])) for row in sample if len(row["vector"]) == dim])
        if len(own) > NEAREST:
            near = np.sort(own @ own.T, axis=1)[:, -1 - NEAREST]
            found += np.sqrt(np.maximum(2 - 2 * near, LEAST_DISTANCE**2)).tolist()
    return float(np.median(found)) if found else 1.0


def _matrix(column: pa.ChunkedArray, start: int, stop: int) -> np.ndarray:
    """Some vectors of a column, all of one length, from the column's own buffers."""
    own = column.slice(start, stop - start).combine_chunks()
    return own.flatten().to_numpy(zero_copy_only=False).reshape(stop - start, -1)


def _compare(queries: pa.Table, rows: pa.Table, schema: pa.Schema) -> pa.Table:
    """Per query of the bucket the nearest rows: (query_id, vec_id, score)."""
    if not queries.num_rows or not rows.num_rows:
        return schema.empty_table()
    asked = queries["query_id"].to_numpy()
    best: list[list[tuple[float, int]]] = [[] for _ in asked]
    for low in range(0, rows.num_rows, SLICE_ROWS):
        high = min(low + SLICE_ROWS, rows.num_rows)
        vectors = _matrix(rows["vector"], low, high)
        ids = rows["ids"].slice(low, high - low).combine_chunks()
        ends = np.cumsum(ids.value_lengths().to_numpy())
        ids = ids.flatten().to_numpy()
        firsts = np.append(0, ends[:-1])
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        units = vectors / lengths[:, None]
        # One of the classes may be the query's own; rounding may change the order of near ties.
        keep = min(len(ends), 2 * NEAREST + 2)
        for begin in range(0, len(asked), SLICE_QUERIES):
            own = _matrix(queries["vector"], begin, min(begin + SLICE_QUERIES, len(asked)))
            for k, (vector, rough) in enumerate(zip(own, own @ units.T, strict=True), begin):
                near = np.flatnonzero(rough >= np.partition(rough, -keep)[-keep])
                exact = (vectors[near] * vector).sum(axis=1) / (lengths[near] * np.sqrt((vector * vector).sum()))
                # A class' first id is its smallest, so the first six classes hold the first six ids.
                first = np.lexsort((ids[firsts[near]], -exact))[: NEAREST + 1]
                found = [(-exact[j], i) for j in first for i in ids[firsts[near[j]] : ends[near[j]]].tolist() if i != asked[k]]
                best[k] = sorted(best[k] + found)[:NEAREST]
    flat = [(query, i, -score) for query, own in zip(asked.tolist(), best, strict=True) for score, i in own]
    return pa.Table.from_pydict(dict(zip(schema.names, zip(*flat, strict=True), strict=True)), schema) if flat else schema.empty_table()


def nearest(df: DataFrame, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row whose id is divisible by ``every``.

    Every row is indexed: it goes into one bucket of each table, whole numbers of projections on
    random directions. A query visits buckets in the order of their estimated chance to hold a
    neighbour at a typical distance; there all rows are compared exactly. One whose fifth neighbour
    found lies further off than that visits further buckets, until the chance is as high for its own distance. Equal vectors are one class with its six
    smallest ids, which is all that five neighbours with ties to the smaller id can take, so a
    very common vector costs what any other does. Queries that found fewer than five go on to
    all buckets of one table, in blocks. Buckets are counted, and a large one is compared in parts,
    however the vectors lie. Vectors of another length are never neighbours.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor
    do NULL ids; a repeated id counts once per different vector; other columns are ignored; an
    empty table gives an empty result. Only the sample and a count reach the driver.
    """
    kind = df.schema[id_col].dataType
    class_schema = T.StructType([T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("ids", T.ArrayType(T.LongType()))])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def out() -> pa.RecordBatch:
            vectors = [np.frombuffer(key) for key in held]
            return pa.RecordBatch.from_arrays(
                [pa.array(vectors, pa.list_(pa.float64())), pa.array(list(held.values()), pa.list_(pa.int64()))], names=["vector", "ids"]
            )

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), _vectors(batch.column(1)), strict=True):
                if i is not None and vector is not None:
                    ids = held.setdefault((vector + 0.0).tobytes(), [])
                    ids.append(i)
                    if len(ids) > 50:
                        held[(vector + 0.0).tobytes()] = sorted(set(ids))[: NEAREST + 1]
            if len(held) >= 20_000:
                yield out()
                held = {}
        if held:
            yield out()

    valid = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    index = stored(
        valid.mapInArrow(classes, class_schema)
        .groupBy("vector")
        .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.slice(F.array_sort("ids"), 1, NEAREST + 1))))), 1, NEAREST + 1).alias("ids")),
        "vectors",
    )
    single = index.select(F.element_at("ids", 1).alias("vec_id"), "vector")
    total = index.count()
    functions = max(LEAST_FUNCTIONS, min(MOST_FUNCTIONS, math.ceil(math.log(max(total, 1) / BUCKET_ROWS, 4))))
    distance = _typical_distance(single)

    def posted(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
        """Each row's bucket of each table, with the row or alone."""
        for batch in batches:
            vectors = [np.array(v) for v in batch.column(0).to_pylist()]
            for table in range(TABLES):
                keys = []
                for vector in vectors:
                    directions, shift = _functions(len(vector), table, functions)
                    keys += _key(len(vector), table, np.floor((_unit(vector) @ directions + shift) / WIDTH).astype(int)[None, :])
                columns = [pa.array(keys, pa.string()), *(batch.columns if whole else [])]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "vector", "ids"][: len(columns)])

    def visited(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
        """The buckets that each query visits, with the query or alone: those for the typical distance or, where
        the query brings its own, those for that which the first visit left out."""
        for batch in batches:
            reached = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            for i, own, far in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), reached, strict=True):
                vector = np.array(own)
                keys = []
                for table in range(TABLES):
                    directions, shift = _functions(len(vector), table, functions)
                    place = (_unit(vector) @ directions + shift) / WIDTH
                    cell = np.floor(place).astype(int)
                    offsets = probes(place - cell, distance)
                    if far is not None:
                        before = set(map(tuple, offsets.tolist()))
                        further = [x for x in probes(place - cell, far).tolist() if tuple(x) not in before]
                        offsets = np.array(further, int).reshape(-1, functions)
                    keys += _key(len(vector), table, cell + offsets)
                n = len(keys)
                if not whole:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["bucket"])
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([i] * n, pa.int64()), pa.array([own] * n, pa.list_(pa.float64()))],
                    names=["bucket", "query_id", "vector"],
                )

    queries = valid.where(F.col("vec_id") % every == 0).mapInArrow(_only_valid, "query_id long, vector array<double>")
    queries = stored(queries.distinct(), "queries")
    rows = index.select("vector", "ids").mapInArrow(posted, "bucket string, vector array<double>, ids array<long>")
    sizes = index.select("vector").mapInArrow(lambda batches: posted(batches, False), "bucket string").groupBy("bucket")
    sizes = stored(sizes.agg(F.count("*").alias("rows")), "bucket-sizes")
    found_schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def compared(asked: DataFrame, visits: DataFrame, held: DataFrame) -> DataFrame:
        """``visits``: the buckets of ``asked``. Rows of a large bucket lie in parts, which all its queries go to;
        where it has many of those they are dealt out, and each deal meets all parts."""
        numbers = F.element_at(F.split("bucket", ":"), 1).cast("int")
        most = F.greatest(F.lit(1), F.least(F.lit(PART_ROWS), F.floor(F.lit(PART_NUMBERS) / numbers)))
        queries_ = F.coalesce("queries", F.lit(1))  # a bucket that nobody visits is read all the same
        parts, deals = F.ceil(F.col("rows") / most).cast("int"), F.ceil(queries_ / PART_QUERIES).cast("int")
        layout = sizes.join(visits.groupBy("bucket").agg(F.count("*").alias("queries")), "bucket", "left")
        layout = layout.select("bucket", parts.alias("parts"), deals.alias("deals")).where("parts > 1 OR deals > 1")
        layout = stored(layout, "bucket-parts")

        def dealt(df: DataFrame, own: str, count: str, other: str, others: str, by: str) -> DataFrame:
            one, all_ = F.coalesce(F.col(count), F.lit(1)), F.coalesce(F.col(others), F.lit(1))
            df = df.join(layout, "bucket", "left").withColumn(own, F.pmod(F.xxhash64(by), one).cast("int"))
            return df.withColumn(other, F.explode(F.sequence(F.lit(0), all_ - 1))).drop("parts", "deals")

        asked = dealt(asked, "deal", "deals", "part", "parts", "query_id")
        held = dealt(held, "part", "parts", "deal", "deals", "vector")
        left, right = asked.groupBy("bucket", "part", "deal"), held.groupBy("bucket", "part", "deal")
        return left.cogroup(right).applyInArrow(lambda q, r: _compare(q, r, arrow), found_schema)

    def ranked(found: DataFrame) -> DataFrame:
        best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return (
            found.groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= NEAREST)
        )

    asked = queries.mapInArrow(visited, "bucket string, query_id long, vector array<double>")
    visits = queries.mapInArrow(lambda batches: visited(batches, False), "bucket string")
    first = stored(ranked(compared(asked, visits, rows)), "neighbours")
    # The fifth score bounds how far the query's own neighbours lie; what lies within that is looked for in turn.
    fifth = F.sqrt(F.greatest(2 - 2 * F.min("score"), F.lit(LEAST_DISTANCE**2)))
    enough = first.groupBy("query_id").agg(F.count("*").alias("n"), fifth.alias("far")).where(F.col("n") >= NEAREST)
    short = queries.join(enough, "query_id", "left_anti")
    wide = queries.join(enough.where(F.col("far") > distance), "query_id").select("query_id", "vector", "far")
    wide = stored(wide, "wide-queries")
    asked = wide.mapInArrow(visited, "bucket string, query_id long, vector array<double>")
    visits = wide.mapInArrow(lambda batches: visited(batches, False), "bucket string")
    again = stored(compared(asked, visits, rows), "further-neighbours")
    first = ranked(first.select("query_id", "vec_id", "score").unionByName(again))
    own_table = rows.where(F.element_at(F.split("bucket", ":"), 2) == "0")
    dims = F.element_at(F.split("bucket", ":"), 1).cast("int")
    cells = own_table.select("bucket", dims.alias("dim")).distinct()
    rest = stored(short.join(cells, F.size("vector") == F.col("dim")).select("bucket", "query_id", "vector"), "short-queries")
    both = first.join(short.select("query_id"), "query_id", "left_anti").unionByName(ranked(compared(rest, rest.select("bucket"), own_table)))
    return both.select(
        F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec_id").cast(kind).alias(id_col), "score"
    )


def _only_valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            (i, vector.tolist())
            for i, vector in zip(batch.column(0).to_pylist(), _vectors(batch.column(1)), strict=True)
            if vector is not None
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in kept], pa.int64()), pa.array([v for _, v in kept], pa.list_(pa.float64()))],
            names=["query_id", "vector"],
        )
