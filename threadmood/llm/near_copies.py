"""Near copies by MinHash: an inverted join over signature coordinates, confirmed on the full sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmood.llm import blocks as B
from threadmood.llm.components import components
from threadmood.llm.shared import shuffled, stored

COORDINATES = 32
#: Pairs that agree in fewer coordinates are not looked at. A pair at a similarity of 0.8 agrees
#: in fewer with a probability of 2e-7, and a more similar one more rarely still.
MATCHES = 13
SIMILAR = 80
#: Members of a list, and of a cluster, that are compared with each other by one group of rows.
LIST_PART, CLUSTER_PART = 2048, 256

_STEP = 0x9E3779B97F4A7C15


def _seed(i: int) -> np.uint64:
    return np.uint64(_STEP * i % (1 << 64))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each text, ascending, one text after the other, and where each begins (and the last ends)."""
    data = B.lowered(data)
    starts, ends, first = B.words(data, bounds)
    hashes = B.mixed(B.stretch_hashes(B.prefix_hashes(data), starts, ends) + (ends - starts).astype("uint64"))
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    rolled = hashes.copy()
    whole = np.zeros(len(hashes), bool)
    left = np.repeat(first[1:], counts) - np.arange(len(hashes))  # words from here to the text's end
    for k in range(1, words):
        more = left > k
        ahead = np.append(hashes[k:], np.zeros(min(k, len(hashes)), "uint64"))[: len(hashes)]
        rolled = np.where(more, B.mixed(rolled * _seed(1) + ahead), rolled)
    whole = left >= words
    # A text of fewer words is one shingle: the whole of it, which begins at its first word.
    short = np.repeat(counts < words, counts)
    begins = np.zeros(len(hashes), bool)
    begins[first[:-1][counts > 0]] = True
    kept = whole | (short & begins)
    rolled, text = B.mixed(rolled[kept] + np.minimum(left[kept], words).astype("uint64")), text[kept]
    order = np.lexsort((rolled, text))
    rolled, text = rolled[order], text[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (text[1:] != text[:-1])
    return rolled[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def _set_keys(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits for each set: two sums over its shingles."""
    sums = [np.append(np.uint64(0), np.cumsum(B.mixed(shingles ^ _seed(i)))) for i in (3, 5)]
    return np.stack([own[bounds[1:]] - own[bounds[:-1]] for own in sums], axis=1)


def _signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest of COORDINATES hashes over each set; 0 for empty sets."""
    out = np.zeros((len(bounds) - 1, COORDINATES), "uint64")
    full = bounds[1:] > bounds[:-1]
    if full.any():
        for i in range(COORDINATES):
            own = B.mixed(shingles ^ _seed(i + 101))
            out[full, i] = np.minimum.reduceat(own, bounds[:-1][full])
    return out


def signatures(df: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n_shingles, signature) per row; no key where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, bounds in B.blocks(batch, 1):
                shingles, at = shingle_sets(data, bounds, words)
                sizes = np.diff(at)
                keys = [key.tobytes() if size else None for key, size in zip(_set_keys(shingles, at), sizes, strict=True)]
                rows = pa.ListArray.from_arrays(
                    np.arange(0, len(sizes) * COORDINATES + 1, COORDINATES, dtype="int32"),
                    pa.array(_signatures(shingles, at).view("int64").ravel()),
                )
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(keys, pa.binary()), pa.array(sizes.astype("int64")), rows],
                    names=["id", "key", "n_shingles", "signature"],
                )

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, key binary, n_shingles long, signature array<long>"
    )


def _posted(classes: DataFrame) -> DataFrame:
    """(token, n, id): each class under those of its coordinate values that a partner must share one of.

    The values are ordered by how many classes have them, rarest first. Two classes that agree
    in MATCHES coordinates agree in one of the first COORDINATES - MATCHES + 1 of either, so
    the rest is not posted; nor are values that only one class has. Very common values thus
    hold hardly any postings.
    """
    tokens = F.transform("signature", lambda v, i: F.xxhash64(v, i))
    posted = classes.select("id", F.explode(tokens).alias("token"))
    counts = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    found = posted.join(shuffled(counts), "token", "left").groupBy("id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "token"))), 1, COORDINATES - MATCHES + 1).alias("own")
    )
    return found.select("id", F.explode(F.filter("own", lambda x: x["n"] > 1)).alias("x")).select("x.token", "x.n", "id")


def _in_parts(rows: DataFrame, group: str, size: int) -> DataFrame:
    """rows with ``part``: those of a large group go to all pairs of its parts that hold them, so each two meet once or more."""
    parts = F.ceil(F.col("n") / size).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1), lambda other: F.concat_ws("-", F.least(own, other).cast("string"), F.greatest(own, other).cast("string"))
    )
    return rows.withColumn("part", F.explode(pairs))


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows cut where the first ``columns`` columns change, whole groups each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(i)[batch.num_rows - 1] for i in range(columns)]
        same = np.ones(batch.num_rows, bool)
        for i, value in enumerate(last):
            same &= np.array(pc.equal(batch.column(i), value).to_numpy(zero_copy_only=False), bool)
        first = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if first:
            yield pa.Table.from_batches([*held, batch.slice(0, first)]).combine_chunks().to_batches()[0]
            held = []
        elif held and any(held[-1].column(i)[held[-1].num_rows - 1] != last[i] for i in range(columns)):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _spans(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for own in columns:
        new[1:] |= own[1:] != own[:-1]
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(new))


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _linked(us: list, vs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=_LINKS)


def _forest(n: int, similar: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect what ``similar`` connects: a member is compared with those it is not yet joined to.

    Members that are joined skip each other, so a group of like members costs one pass, and
    there are fewer links than members.
    """
    group = np.arange(n)
    for i in range(n):
        others = np.flatnonzero(group != group[i])
        others = others[(others > i)] if len(others) else others
        if len(others):
            for j in others[similar(i, others)].tolist():
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    yield i, j


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list: token, part, id, digest (a byte of each coordinate). Links within lists at MATCHES or more."""
    for batch in _groups(batches, 2):
        tokens = batch.column(0).to_numpy()
        parts = pc.rank(batch.column(1), sort_keys="ascending", tiebreaker="dense").to_numpy()
        ids = batch.column(2).to_numpy()
        digests = np.frombuffer(b"".join(batch.column(3).to_pylist()), "uint8").reshape(-1, COORDINATES)
        us, vs = [], []
        for a, b in zip(*_spans(tokens, parts), strict=True):
            if b - a == 1:
                continue
            own = digests[a:b]
            if b - a == 2:
                if (own[0] == own[1]).sum() >= MATCHES:
                    us.append(ids[a])
                    vs.append(ids[a + 1])
                continue
            for i, j in _forest(b - a, lambda i, others, own=own: (own[others] == own[i]).sum(axis=1) >= MATCHES):
                us.append(ids[a + i])
                vs.append(ids[a + j])
        if us:
            yield _linked(us, vs)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cluster: cluster, part, id, shingles. Links of sets that are similar enough."""
    for batch in _groups(batches, 2):
        clusters = batch.column(0).to_numpy()
        parts = pc.rank(batch.column(1), sort_keys="ascending", tiebreaker="dense").to_numpy()
        ids, sets = batch.column(2).to_numpy(), batch.column(3)
        us, vs = [], []
        for a, b in zip(*_spans(clusters, parts), strict=True):
            if b - a == 1:
                continue
            own = [np.frombuffer(sets[i].as_buffer(), "uint64") for i in range(a, b)]
            sizes = np.array([len(x) for x in own])
            values, local = np.unique(np.concatenate(own), return_inverse=True)
            begins = np.cumsum(sizes) - sizes
            # Who has most of what is common comes first: it joins most of the others at once.
            often = np.bincount(local)
            order = np.argsort(-np.add.reduceat(np.log(often[local]), begins) / sizes, kind="stable")

            def similar(i, others, order=order, sizes=sizes, begins=begins, local=local, n=len(values)):
                has = np.zeros(n, bool)
                me = order[i]
                has[local[begins[me] : begins[me] + sizes[me]]] = True
                them = order[others]
                fits = (100 * sizes[them] >= SIMILAR * sizes[me]) & (100 * sizes[me] >= SIMILAR * sizes[them])
                out = np.zeros(len(others), bool)
                them = them[fits]
                if len(them):
                    flat = has[B.gathered(local, begins[them], sizes[them])]
                    shared = np.add.reduceat(flat.astype("int64"), np.cumsum(sizes[them]) - sizes[them])
                    out[fits] = 100 * shared >= SIMILAR * (sizes[them] + sizes[me] - shared)
                return out

            for i, j in _forest(b - a, similar):
                us.append(ids[a + order[i]])
                vs.append(ids[a + order[j]])
        if us:
            yield _linked(us, vs)


def near_copies(df: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) per row.

    Sets of ``words``-word shingles whose intersection is at least SIMILAR per cent of their
    union are linked; ``component_id`` is the smallest id reachable over links, ``kept`` says
    that it is the row's own. Equal sets are one class. Classes that agree in MATCHES of
    COORDINATES MinHash values are brought together by an inverted join over coordinate values;
    each list and each cluster gives out fewer links than it has members, because members that
    are joined skip each other, and lists beyond a size are compared in parts. Every link is
    confirmed on the full sets, read from the texts again. No pair of similar sets is left out
    but for the probability stated at MATCHES, and hashes are 64 bits.

    Without words there is no set, and the row is linked with nothing; with fewer than ``words``
    words the whole text is one shingle. Ids are whole numbers; repeated rows are copies of
    each other and share the smallest id, so all of them are kept or none; a NULL id takes no
    part in links and stays NULL. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(signatures(df, words, id_col, text_col), "signatures")
    classes = stored(
        rows.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.min_by("signature", "id").alias("signature")),
        "classes",
    )
    # A class is named by its smallest id; an id that names several classes (rows that share an id) joins them.
    digest = F.unhex(F.array_join(F.transform("signature", lambda v: F.lpad(F.hex(F.pmod(v, F.lit(256))), 2, "0")), ""))
    lists = _in_parts(_posted(classes), "token", LIST_PART)
    lists = lists.join(shuffled(classes.select("id", digest.alias("digest"))), "id").select("token", "part", "id", "digest")
    links = lists.repartition("token", "part").sortWithinPartitions("token", "part").mapInArrow(_candidates, "u long, v long")
    clusters = stored(components(links, "clusters"), "clusters")

    sizes = clusters.groupBy("component").agg(F.count("*").alias("n"))
    members = _in_parts(clusters.join(shuffled(sizes), "component"), "component", CLUSTER_PART)
    wanted = clusters.select("id").hint("shuffle_hash")
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, bounds in B.blocks(batch, 1):
                shingles, at = shingle_sets(data, bounds, words)
                keys = [key.tobytes() for key in _set_keys(shingles, at)]
                blobs = [shingles[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], names=["id", "key", "shingles"])

    full = texts.mapInArrow(sets, "id long, key binary, shingles binary").join(shuffled(classes.select("id", "key")), ["id", "key"], "left_semi")
    compared = (
        members.join(shuffled(full.select("id", "shingles")), "id")
        .select("component", "part", "id", "shingles")
        .repartition("component", "part")
        .sortWithinPartitions("component", "part")
        .mapInArrow(_confirmed, "u long, v long")
    )
    found = components(compared, "near-copies").select(F.col("id").alias("class"), "component")
    named = rows.select("id", "key", "n_shingles").join(shuffled(classes.select("key", F.col("id").alias("class"))), "key", "left")
    component = F.coalesce("component", "class", "id")
    return named.join(shuffled(found), "class", "left").select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
