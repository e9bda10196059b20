"""Join of sets of word shingles by Jaccard similarity: inverted lists with skipping, answers derived from similar sets' answers.

Shingles are put into one order, common ones last. Two similar sets share one of the first few
shingles of either, so a set is posted under those alone, each with its position. In a list, by
position, a set skips the whole block of postings whose positions say that too many shingles
before the common one differ. What passes is told apart by a digest that never rejects a similar
pair. Sets that this connects are compared in full: the overlaps of one set with all others come
from the inverted lists; those of a similar set are derived from them by walking only the lists of
the shingles in which the two sets differ.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadmood.llm import blocks as B
from threadmood.llm.components import components
from threadmood.llm.groups import Compare, linked, whole_groups
from threadmood.llm.near_copies import _set_keys as set_keys
from threadmood.llm.near_copies import shingle_sets
from threadmood.llm.shared import stored

#: Counters that shingles are counted in, whatever the input's size; they only order shingles.
COUNTERS = 1 << 20
#: Counters that travel together when they are summed.
SLICE = 1 << 15
#: Members of a list, and of a cluster, that are compared by one group of rows, and shingles of a cluster's part.
LIST_PART, CLUSTER_PART, PART_SHINGLES = 2048, 512, 4_000_000
#: Lists up to this size are compared pair by pair at once.
SHORT_LIST = 64
#: Bits of a digest, for larger sets half their size or more; bits of the bitmap that says which texts are wanted again.
DIGEST, FILTER_BITS = 512, 1 << 23


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection of two sets of these sizes together whose similarity is ``percent`` or more."""
    return -(-percent * sizes // (100 + percent))


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype("int64")


def _commonness(df: DataFrame, words: int) -> tuple[np.ndarray, float]:
    """For each counter how common its shingles are: 0, or the steps of a quarter power of two over a limit; and that limit.

    All shingles of all rows are counted, in a fixed number of counters; the sums are the only
    thing that reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, "int64")
        for batch in batches:
            for _, data, bounds in B.blocks(batch, 0):
                total += np.bincount(_counter(shingle_sets(data, bounds, words)[0]), minlength=COUNTERS)
        for i in range(0, COUNTERS, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([zlib.compress(total[i : i + SLICE].tobytes(), 1)])], names=["first", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(min(SLICE, COUNTERS), "int64")
        for batch in batches:
            for blob in batch.column(1):
                total += np.frombuffer(zlib.decompress(blob.as_py()), "int64")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([zlib.compress(total.tobytes(), 1)])], names=["first", "counts"])

    slices = df.select("text").mapInArrow(count, "first long, counts binary").groupBy("first").applyInArrow(add, "first long, counts binary")
    counts = np.zeros(COUNTERS, "int64")
    for row in slices.collect():
        counts[row["first"] : row["first"] + SLICE] = np.frombuffer(zlib.decompress(row["counts"]), "int64")
    least = max(8.0, 4 * counts.mean())
    steps = 1 + np.floor(4 * np.log2(np.maximum(counts, 1) / least))
    return np.where(counts > least, np.minimum(steps, 255), 0).astype("uint8"), least


def _digests(shingles: np.ndarray, bounds: np.ndarray, widths: np.ndarray) -> list[bytes]:
    """Parities of the number of shingles that fall on each of a width of bits (a power of two per set).

    A shingle that only one of two sets has turns one bit, so two digests differ in no more bits
    than their sets do in shingles. One half of a digest over the other is that of half the width.
    """
    begins = np.append(0, np.cumsum(widths))
    text = np.repeat(np.arange(len(widths)), np.diff(bounds))
    bit = (B.mixed(shingles) & (widths[text] - 1).astype("uint64")).astype("int64")
    parity = np.zeros(begins[-1], bool)
    places, counts = np.unique(begins[text] + bit, return_counts=True)
    parity[places] = counts & 1
    packed = np.packbits(parity).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]


SETS = "id long, key binary, n long, rare long, digest binary, prefix array<struct<token: long, common: int>>"


def _posted_sets(df: DataFrame, words: int, percent: int, common: np.ndarray) -> DataFrame:
    """(id, key, n, rare, digest, prefix) per row: 128 bits for the set, its size, how many shingles are not common, a digest, and the first few in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, bounds in B.blocks(batch, 1):
                shingles, at = shingle_sets(data, bounds, words)
                sizes = np.diff(at)
                text = np.repeat(np.arange(len(sizes)), sizes)
                step = common[_counter(shingles)]
                order = np.argsort(text * 256 + step, kind="stable")
                place = np.arange(len(shingles)) - np.repeat(at[:-1], sizes)
                posted = np.maximum(0, sizes + 1 - -(-percent * sizes // 100)) * (sizes > 0)
                taken = order[place < np.repeat(posted, sizes)]
                prefix = pa.StructArray.from_arrays([pa.array(shingles[taken].view("int64")), pa.array(step[taken].astype("int32"))], ["token", "common"])
                keys = [key.tobytes() if size else None for key, size in zip(set_keys(shingles, at), sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0),
                        pa.array(keys, pa.binary()),
                        pa.array(sizes.astype("int64")),
                        pa.array(np.bincount(text[step == 0], minlength=len(sizes)).astype("int64")),
                        pa.array(_digests(shingles, at, 1 << np.ceil(np.log2(np.maximum(sizes / 2, DIGEST))).astype("int64")), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(posted)).astype("int32")), prefix),
                    ],
                    names=["id", "key", "n", "rare", "digest", "prefix"],
                )

    return df.mapInArrow(run, SETS)


def _pairs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (a, b) with begin[a] <= b < end[a]."""
    counts = np.maximum(0, end - begin)
    a = np.repeat(np.arange(len(begin)), counts)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[a]


class Digests:
    """How many bits the digests of two rows differ in, each folded to the other's width."""

    def __init__(self, blobs: pa.Array):
        own = [np.frombuffer(blob, "uint64") for blob in blobs.to_pylist()]
        self.widths = np.array([len(x) for x in own])
        self.tables = {}
        for width in np.unique([self.widths, self.widths // 2]).tolist():
            rows = np.flatnonzero((self.widths == width) | (self.widths == 2 * width))
            slot = np.zeros(len(own), "int64")
            slot[rows] = np.arange(len(rows))
            table = [own[i] if len(own[i]) == width else own[i][:width] ^ own[i][width:] for i in rows.tolist()]
            self.tables[width] = slot, np.array(table).reshape(-1, width)

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Widths are at most one power of two apart, as those of sets of similar sizes are."""
        out = np.zeros(len(a), "int64")
        widths = np.minimum(self.widths[a], self.widths[b])
        for width in np.unique(widths).tolist():
            slot, table = self.tables[width]
            own = np.flatnonzero(widths == width)
            for part in np.array_split(own, 1 + len(own) * width // 4_000_000):
                out[part] = np.bitwise_count(table[slot[a[part]]] ^ table[slot[b[part]]]).sum(axis=1)
        return out


class Postings:
    """Lists of postings by position: which of two sets' sizes and positions allow them to be similar."""

    def __init__(self, batch: pa.RecordBatch, bounds: np.ndarray, percent: int):
        self.position, self.n, self.percent = batch.column("rank").to_numpy(), batch.column("n").to_numpy(), percent
        self.sizes = np.diff(bounds)
        self.which = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # Shingles before the first common one differ, those of either set: beyond this position no partner is left.
        last = np.maximum(self.most(self.n + 100 * self.n // percent) - self.position, -1)
        step = np.int64(1) << np.int64(32)
        self.end = np.searchsorted(self.which * step + self.position, self.which * step + np.minimum(last, step - 1), "right")
        self.is_short = self.sizes[self.which] <= SHORT_LIST

    def most(self, both: np.ndarray) -> np.ndarray:
        """Shingles that similar sets of these sizes together may differ in."""
        return both - 2 * needed(both, self.percent)

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, position = self.n, self.position
        sizes = 100 * np.minimum(n[a], n[b]) >= self.percent * np.maximum(n[a], n[b])
        return sizes & (position[a] + position[b] <= self.most(n[a] + n[b]))

    def short_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that fit in the lists up to SHORT_LIST; blocks of later positions are skipped."""
        a, b = _pairs(np.arange(len(self.n)) + 1, np.where(self.is_short, self.end, 0))
        keep = self.fit(a, b)
        return a[keep], b[keep]


def _compare_postings(percent: int) -> Compare:
    """Pairs of sets in one list that may be similar, as far as sizes, positions and digests say."""

    def compare(batch: pa.RecordBatch, bounds: np.ndarray, is_open: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists, digests = Postings(batch, bounds, percent), Digests(batch.column("digest"))
        group = np.unique(label, return_inverse=True)[1]

        def similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            fits = (is_open[a] | is_open[b]) & (group[a] != group[b]) & lists.fit(a, b)
            fits[fits] = digests.differing(a[fits], b[fits]) <= lists.most(lists.n[a[fits]] + lists.n[b[fits]])
            return fits

        a, b = lists.short_pairs()
        keep = similar(a, b)
        found = [np.stack([a[keep], b[keep]])]
        for k in np.flatnonzero(lists.sizes > SHORT_LIST):
            own = slice(bounds[k], bounds[k + 1])
            for i in range(bounds[k], bounds[k + 1]):
                others = np.arange(i + 1, lists.end[i])
                others = others[group[others] != group[i]]
                others = others[similar(np.full(len(others), i), others)]
                found.append(np.stack([np.full(len(others), i), others]))
                group[own][np.isin(group[own], group[others])] = group[i]
        a, b = np.concatenate(found, axis=1)
        return a, b

    return compare


def _with_partners(percent: int):
    """Rows sorted by list and position without those that no other of a short list fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_groups(batches, ("group",)):
            lists = Postings(batch, bounds, percent)
            kept = ~lists.is_short
            for own in lists.short_pairs():
                kept[own] = True
            yield batch.filter(pa.array(kept))

    return run


def _lists(rows: DataFrame, least: float, percent: int) -> DataFrame:
    """(group, parts, id, rank, n): the rows' postings that have a partner in their list.

    Postings of a shingle that may fill several parts, as far as its counter tells, are not brought
    together here: they are dealt later. All others are counted where they meet.
    """
    posted = rows.select("id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("rank", "x"))
    most = F.when(F.col("x.common") > 0, F.ceil(F.lit(float(least)) * F.pow(F.lit(2.0), F.col("x.common") / 4) / LIST_PART)).otherwise(1)
    posted = posted.select(F.col("x.token").alias("group"), most.cast("int").alias("parts"), "id", "rank", "n")
    packed = (F.shiftleft(F.col("rank").cast("long"), 32) + F.col("n")).alias("packed")
    light = posted.where("parts = 1").select("group", "id", packed)
    light = light.withColumn("members", F.count("*").over(Window.partitionBy("group"))).where("members > 1")
    light = light.select(
        "group",
        F.ceil(F.col("members") / LIST_PART).cast("int").alias("parts"),
        "id",
        F.shiftright("packed", 32).cast("int").alias("rank"),
        (F.col("packed") % (1 << 32)).cast("int").alias("n"),
    )
    light = light.sortWithinPartitions("group", "rank").mapInArrow(_with_partners(percent), light.schema)
    return light.unionByName(posted.where("parts > 1"))


class Overlaps:
    """Sizes of the intersections of sets with all others of a cluster."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(x) for x in sets])
        self.begins = np.append(0, np.cumsum(sizes))
        values, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        self.holders = owner[np.argsort(self.tokens, kind="stable")]
        self.often = np.bincount(self.tokens, minlength=len(values))
        self.first = np.cumsum(self.often) - self.often
        self.inside = np.zeros(len(values), bool)
        self.known: tuple[int, np.ndarray] | None = None

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.begins[i] : self.begins[i + 1]]

    def _walk(self, tokens: np.ndarray) -> np.ndarray:
        return np.bincount(B.gathered(self.holders, self.first[tokens], self.often[tokens]), minlength=len(self.begins) - 1)

    def _without(self, tokens: np.ndarray, others: np.ndarray) -> np.ndarray:
        self.inside[others] = True
        out = tokens[~self.inside[tokens]]
        self.inside[others] = False
        return out

    def __call__(self, i: int) -> np.ndarray:
        """Derived from the answers that are known if fewer postings have to be walked for that."""
        own = self.of(i)
        if self.known:
            other = self.of(self.known[0])
            more, less = self._without(own, other), self._without(other, own)
            if self.often[more].sum() + self.often[less].sum() < self.often[own].sum():
                return self.known[1] + self._walk(more) - self._walk(less)
        self.known = i, self._walk(own)
        return self.known[1]


def _forest(order: np.ndarray, sizes: np.ndarray, percent: int, is_open: np.ndarray, group: np.ndarray, similar: Callable) -> Iterator[tuple[int, int]]:
    """Pairs that connect all similar members: each is compared with those that it is not joined to and that come later.

    The first of the order resembles many and joins them at once. What is left outside goes first
    then, so the large group finds nobody to compare with.
    """
    left = np.ones(len(sizes), bool)

    def visit(i: int) -> Iterator[tuple[int, int]]:
        left[i] = False
        fits = left & (group != group[i]) & (is_open | is_open[i])
        fits &= (100 * sizes >= percent * sizes[i]) & (percent * sizes <= 100 * sizes[i])
        others = np.flatnonzero(fits)
        if len(others):
            for j in others[similar(i, others)].tolist():
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    yield i, j

    yield from visit(int(order[0]))
    inside = group[order] == np.bincount(group).argmax()
    for i in [*order[~inside].tolist(), *order[inside].tolist()]:
        if left[i]:
            yield from visit(i)


def compare_sets(percent: int) -> Compare:
    """Pairs of sets in one cluster that connect all similar ones."""

    def links(sets: list[np.ndarray], n: np.ndarray, is_open: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int]]:
        overlaps = Overlaps(sets)
        # Who has most of what is common comes first.
        central = np.add.reduceat(np.log(overlaps.often[overlaps.tokens]), overlaps.begins[:-1]) / n
        similar = lambda i, others: overlaps(i)[others] >= needed(n[others] + n[i], percent)
        return _forest(np.argsort(-central, kind="stable"), n, percent, is_open, group, similar)

    def compare(batch: pa.RecordBatch, bounds: np.ndarray, is_open: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = []
        blobs, n = batch.column("shingles"), batch.column("n").to_numpy()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a > 1:
                own = [np.frombuffer(blobs[i].as_buffer(), "uint64") for i in range(a, b)]
                group = np.unique(label[a:b], return_inverse=True)[1]
                found += [(a + i, a + j) for i, j in links(own, n[a:b], is_open[a:b], group)]
        pairs = np.array(found, "int64").reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    return compare


def _members(clusters: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    """(group, parts, id, rank, n) and columns of the classes in each cluster (id, component)."""
    members = clusters.join(classes, "id")
    weights = members.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("members") / CLUSTER_PART, F.col("shingles") / PART_SHINGLES)).cast("int")
    met = members.join(weights.select("component", parts.alias("parts")), "component")
    return met.select(F.col("component").alias("group"), "parts", "id", (F.col("rare") / F.col("n")).alias("rank"), "n", *columns)


def only_some(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows without most of those whose id is not among ids: fewer travel to the join that leaves out the rest.

    The ids' hashes are set in a bitmap of FILTER_BITS, whatever their number. Were all bits set, all rows would stay.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bitmaps = ids.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    placed = rows.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn("place", F.bitmap_bit_position(slot).cast("int"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.col("place") % 8).bitwiseAND(1) == 1
    return placed.join(F.broadcast(bitmaps), "bucket").where(is_set).select(*rows.columns)


def confirmed(texts: DataFrame, classes: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of similar sets among the classes (id, key, n, rare) of each cluster (id, component), from the texts (id, text).

    The clusters' rows meet the texts before these are made sets, so sets travel once.
    """
    wanted = stored(_members(clusters, classes, "key"), "cluster-members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()  # one of repeated rows goes on from a task
        for batch in batches:
            for own, data, bounds in B.blocks(batch, 6):
                shingles, at = shingle_sets(data, bounds, words)
                same = np.zeros(own.num_rows, bool)
                for i, (key, row) in enumerate(zip(set_keys(shingles, at), own.select(["id", "key"]).to_pylist(), strict=True)):
                    if key.tobytes() == row["key"] and (row["id"], row["key"]) not in seen:
                        same[i] = True
                        seen.add((row["id"], row["key"]))
                blobs = [shingles[a:b].tobytes() for a, b in zip(at[:-1][same], at[1:][same], strict=True)]
                columns = [own.column(i).filter(pa.array(same)) for i in range(5)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary())], names=["group", "parts", "id", "rank", "n", "shingles"])

    met = only_some(texts, wanted).join(wanted.hint("shuffle_hash"), "id").select("group", "parts", "id", "rank", "n", "key", "text")
    rows = met.mapInArrow(run, "group long, parts int, id long, rank double, n long, shingles binary")
    return linked(rows, compare_sets(percent), CLUSTER_PART, not wanted.where("parts > 1").isEmpty())


def set_join(df: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per row.

    A row's set holds the distinct ``words``-word shingles of its text in lower case (A-Z). Two sets
    are linked when their intersection is ``percent`` per cent of their union or more;
    ``component_id`` is the smallest id reachable over links. No link between different sets is
    lost; equal sets are one class, and inside a class or a family fewer links are followed
    than there are members. Shingles are told apart by 64-bit hashes.

    Without words there is no set, and the row is linked with nothing; with fewer than ``words``
    words the whole text is one shingle. Ids are whole numbers; rows that share an id share its
    component; a NULL id takes no part in links and stays NULL. Other columns are ignored;
    an empty table gives no rows.
    """
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    common, least = _commonness(texts, words)
    rows = stored(_posted_sets(texts, words, percent, common).withColumn("row", F.monotonically_increasing_id()), "sets")
    named_by = rows.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min(F.struct("id", "row")).alias("least"))
    chosen = stored(named_by.select("least.row"), "set-rows")
    classes = stored(rows.drop("prefix").join(chosen.hint("shuffle_hash"), "row", "left_semi"), "set-classes")
    # The same plan at every size: a side that is broadcast while it is small would hide what a shuffle costs later.
    lists = stored(_lists(rows.join(chosen.hint("shuffle_hash"), "row", "left_semi"), least, percent), "set-lists")
    links = linked(lists.join(classes.select("id", "digest"), "id"), _compare_postings(percent), LIST_PART, not lists.where("parts > 1").isEmpty())
    clusters = stored(components(links, "set-clusters"), "set-clusters")

    found = components(confirmed(texts, classes, clusters, words, percent), "set-join").select(F.col("id").alias("class"), "component")
    named = rows.select("id", "key", "n").join(classes.select("key", F.col("id").alias("class")), "key", "left")
    return named.join(found, "class", "left").select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "class", "id").alias("component_id"),
    )
