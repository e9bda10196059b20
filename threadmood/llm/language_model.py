"""Scoring by a weighted backoff automaton over smoothed bigrams, built anew for each block of documents.

The counts of the corpus stay distributed. A block asks for the counts of the n-grams that its own
texts hold and gets an automaton of just these states and arcs, so the model never lies in one place.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmood.llm import blocks as B
from threadmood.llm.shared import parts_of, stored

#: Documents whose crc32 of the id, as text, has this remainder are held out.
FOLDS, HELD_OUT = 5, 1
#: Symbols that are no words: the end of a text, and what stands before its first word.
END, BEGIN = np.uint64(1), np.uint64(2)
#: A context with more than this share of all tokens is counted in SALTS parts.
HOT, SALTS = 1 / 64, 16
#: Bytes kept of a word's hash beside the hash of its context.
WORD_BYTES = 6


class Tokens:
    """The tokens of a block's texts: words in lower case, then an end each."""

    def __init__(self, texts: pa.ChunkedArray):
        batch = pa.RecordBatch.from_arrays([texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts], names=["t"])
        hashes, counts = [], []
        for _, data, bounds in B.blocks(batch, 0):
            data = B.lowered(data)
            starts, ends, first = B.words(data, bounds)
            own = B.mixed(B.stretch_hashes(B.prefix_hashes(data), starts, ends) + (ends - starts).astype("uint64"))
            hashes.append(np.insert(np.maximum(own, np.uint64(16)), first[1:], END))
            counts.append(np.diff(first) + 1)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, "int64")
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, "uint64")
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        #: Distinct tokens, and the place of each token among them; as a context, len(words) is the beginning.
        self.words, self.at = np.unique(self.hashes, return_inverse=True)
        self.context = np.empty_like(self.at)
        self.context[1:] = self.at[:-1]
        self.context[self.starts] = len(self.words)
        self.context_hashes = np.append(self.words, BEGIN)

    def training(self, train: np.ndarray) -> np.ndarray:
        return np.repeat(train, self.counts)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, word) as one number each, and the place of each token among them."""
        return np.unique(self.context * (len(self.words) + 1) + self.at, return_inverse=True)


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (B.mixed(hashes) % np.uint64(parts)).astype("int64")


class Routes:
    """Where the pairs of a block are counted: per part, contexts in ascending order and the words after each.

    A hot context is split by its words over SALTS parts, and a block that has it asks all of
    them, since each knows only its share of what follows the context.
    """

    def __init__(self, tokens: Tokens, pairs: np.ndarray, word_counts: np.ndarray, total: int, parts: int):
        width = len(tokens.words) + 1
        context, word = pairs // width, pairs % width
        is_hot = np.append(word_counts > total * HOT, True)
        salt = np.where(is_hot[context], 1 + tokens.words[word] % np.uint64(SALTS), 0).astype("uint64")

        def part_of(context: np.ndarray, salt: np.ndarray) -> np.ndarray:
            return _parts(tokens.context_hashes[context] + salt * np.uint64(0x9E3779B97F4A7C15), parts)

        part = part_of(context, salt)
        cut = tokens.words[word] & np.uint64((1 << 8 * WORD_BYTES) - 1)
        #: The pairs by part, context and word.
        self.order = np.lexsort((cut, tokens.context_hashes[context], part))
        self.words, self.pair_part = cut[self.order], part[self.order]
        hot = np.unique(context[is_hot[context]])
        salts = np.tile(np.arange(1, SALTS + 1, dtype="uint64"), len(hot))
        hot = np.repeat(hot, SALTS)
        whole = np.append(part, part_of(hot, salts)) * width + np.append(context, hot)
        keys, at = np.unique(whole, return_inverse=True)
        sizes = np.bincount(at[: len(pairs)], minlength=len(keys))
        order = np.lexsort((tokens.context_hashes[keys % width], keys // width))
        self.key_part, self.context, self.sizes = keys[order] // width, keys[order] % width, sizes[order]

    def parts(self):
        """(part, its contexts, its pairs) as slices."""
        for part in np.unique(self.key_part).tolist():
            yield (
                part,
                slice(*np.searchsorted(self.key_part, [part, part + 1])),
                slice(*np.searchsorted(self.pair_part, [part, part + 1])),
            )


_ASK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
ASK = "part int, block int, keys binary, sizes binary, words binary, counts binary"
_ANSWER = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()), ("sums", pa.binary()), ("kinds", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64())])
ANSWER = "block int, part int, counts binary, sums binary, kinds binary, tokens long, distinct long"


def _counted(tokens: Tokens, train: np.ndarray) -> np.ndarray:
    return np.bincount(tokens.at[tokens.training(train)], minlength=len(tokens.words))


def ask_words(block: int, texts: pa.ChunkedArray, train: np.ndarray, parts: int) -> pa.Table:
    """The block's distinct words with how often they are in its training texts, by part."""
    tokens = Tokens(texts)
    counts, part = _counted(tokens, train), _parts(tokens.words, parts)
    rows = {name: [] for name in _ASK.names}
    for own in range(parts):
        here = np.flatnonzero(part == own)
        if len(here):
            for name, value in zip(_ASK.names, (own, block, B.planes(tokens.words[here], 8), b"", b"", B.planes(counts[here], 4)), strict=True):
                rows[name].append(value)
    return pa.Table.from_pydict(rows, _ASK)


def answer_words(asked: pa.Table) -> pa.Table:
    """Counts over all blocks, to each block in the order it asked."""
    keys = [B.from_planes(blob, 8) for blob in asked["keys"].to_pylist()]
    counts = [B.from_planes(blob, 4) for blob in asked["counts"].to_pylist()]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, np.concatenate(counts).astype(float), len(distinct)).astype("int64")
    totals = np.split(sums[at], np.cumsum([len(own) for own in keys])[:-1])
    n = asked.num_rows
    tokens = [int(sums.sum())] + [0] * (n - 1)  # a part's totals are told once
    kinds = [int((sums > 0).sum())] + [0] * (n - 1)
    blobs = [B.planes(own, 6) for own in totals]
    return pa.Table.from_pydict(
        {"block": asked["block"], "part": asked["part"], "counts": blobs, "sums": [b""] * n, "kinds": [b""] * n, "tokens": tokens, "distinct": kinds}, _ANSWER
    )


def _word_counts(tokens: Tokens, answers: dict[int, dict], parts: int) -> np.ndarray:
    part = _parts(tokens.words, parts)
    out = np.zeros(len(tokens.words), "int64")
    for own, answer in answers.items():
        out[np.flatnonzero(part == own)] = B.from_planes(answer["counts"], 6)
    return out


def ask_pairs(block: int, texts: pa.ChunkedArray, train: np.ndarray, answers: dict, total: int, parts: int) -> pa.Table:
    """The block's distinct pairs, by part: contexts, how many words follow each, these words, and training counts."""
    tokens = Tokens(texts)
    pairs, at = tokens.pairs()
    counts = np.bincount(at[tokens.training(train)], minlength=len(pairs))
    routes = Routes(tokens, pairs, _word_counts(tokens, answers, parts), total, parts)
    counts = counts[routes.order]
    rows = {name: [] for name in _ASK.names}
    for part, keys, own in routes.parts():
        heads = tokens.context_hashes[routes.context[keys]]
        values = (part, block, B.planes(heads, 8), B.planes(routes.sizes[keys], 4), B.planes(routes.words[own], WORD_BYTES), B.planes(counts[own], 4))
        for name, value in zip(_ASK.names, values, strict=True):
            rows[name].append(value)
    return pa.Table.from_pydict(rows, _ASK)


def answer_pairs(asked: pa.Table) -> pa.Table:
    """Per pair its count over all blocks; per context the sum of counts and the kinds of words seen after it in this part."""
    keys = [B.from_planes(blob, 8) for blob in asked["keys"].to_pylist()]
    sizes = [B.from_planes(blob, 4).astype("int64") for blob in asked["sizes"].to_pylist()]
    words = np.concatenate([B.from_planes(blob, WORD_BYTES) for blob in asked["words"].to_pylist()])
    counts = np.concatenate([B.from_planes(blob, 4) for blob in asked["counts"].to_pylist()]).astype("int64")
    contexts, of_key = np.unique(np.concatenate(keys), return_inverse=True)
    context = np.repeat(of_key, np.concatenate(sizes))
    order = np.lexsort((words, context))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (context[order][1:] != context[order][:-1])
    group = np.cumsum(new) - 1
    sums = np.bincount(group, counts[order].astype(float)).astype("int64")
    first = context[order][new]
    context_sums = np.bincount(first, sums.astype(float), len(contexts)).astype("int64")
    context_kinds = np.bincount(first[sums > 0], minlength=len(contexts))
    totals = np.empty(len(words), "int64")
    totals[order] = sums[group]
    pair_ends = np.cumsum([int(own.sum()) for own in sizes])[:-1]
    key_ends = np.cumsum([len(own) for own in keys])[:-1]
    n = asked.num_rows
    return pa.Table.from_pydict(
        {
            "block": asked["block"],
            "part": asked["part"],
            "counts": [B.planes(own, 6) for own in np.split(totals, pair_ends)],
            "sums": [B.planes(own, 6) for own in np.split(context_sums[of_key], key_ends)],
            "kinds": [B.planes(own, 6) for own in np.split(context_kinds[of_key], key_ends)],
            "tokens": [0] * n,
            "distinct": [0] * n,
        },
        _ANSWER,
    )


class Automaton:
    """States are contexts that were seen; arcs are seen pairs; what has no arc fails to the root, at a weight.

    Weights are logarithms to base 10. After a word seen in training the state is that word,
    else the root, which has an arc for every word of the block.
    """

    def __init__(self, tokens: Tokens, word_counts, total: int, distinct: int, arcs, pair_counts, context_sums, context_kinds):
        self.root = len(tokens.words) + 1  # states: words, the beginning, the root
        self.width = len(tokens.words)
        chance = (word_counts + 0.5) / (total + 0.5 * (distinct + 1))
        self.root_weight = np.log10(chance)
        self.root_next = np.where(word_counts > 0, np.arange(self.width), self.root)
        sums, kinds = np.append(context_sums, 0), np.append(context_kinds, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.fail_weight = np.where(sums > 0, np.log10(kinds / (sums + kinds)), 0.0)
        seen = pair_counts > 0
        self.arcs = arcs[seen]  # context * width + word, ascending
        context, word = self.arcs // self.width, self.arcs % self.width
        own = (pair_counts[seen] + kinds[context] * chance[word]) / (sums[context] + kinds[context])
        self.weight, self.next = np.log10(own), self.root_next[word]

    def score(self, tokens: Tokens) -> np.ndarray:
        """Log-probability of each text: all texts step from left to right together, the longest stay longest."""
        total = np.zeros(len(tokens.counts))
        order = np.argsort(-tokens.counts, kind="stable")
        lengths = tokens.counts[order]
        state = np.full(len(order), self.width)  # the beginning
        here = np.zeros(len(order))
        starts = tokens.starts[order]
        running = len(order)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            while running and lengths[running - 1] <= step:
                running -= 1
            word, own = tokens.at[starts[:running] + step], state[:running]
            key = own * self.width + word
            at = np.searchsorted(self.arcs, key)
            at[at == len(self.arcs)] = 0
            has = self.arcs[at] == key if len(self.arcs) else np.zeros(running, bool)
            if len(self.arcs):
                here[:running] += np.where(has, self.weight[at], self.fail_weight[own] + self.root_weight[word])
                state[:running] = np.where(has, self.next[at], self.root_next[word])
            else:
                here[:running] += self.fail_weight[own] + self.root_weight[word]
                state[:running] = self.root_next[word]
        total[order] = here
        return total


def scored_block(texts: pa.ChunkedArray, train: np.ndarray, word_answers: dict, pair_answers: dict, total: int, distinct: int, parts: int) -> dict:
    """n_tokens, n_known, base_score and score of each text of a block."""
    tokens = Tokens(texts)
    word_counts = _word_counts(tokens, word_answers, parts)
    pairs, _ = tokens.pairs()
    routes = Routes(tokens, pairs, word_counts, total, parts)
    counts = np.zeros(len(pairs), "int64")
    sums, kinds = np.zeros(len(tokens.words) + 1, "int64"), np.zeros(len(tokens.words) + 1, "int64")
    for part, keys, own in routes.parts():
        answer = pair_answers[part]
        counts[routes.order[own]] = B.from_planes(answer["counts"], 6)
        sums[routes.context[keys]] += B.from_planes(answer["sums"], 6).astype("int64")
        kinds[routes.context[keys]] += B.from_planes(answer["kinds"], 6).astype("int64")
    width = len(tokens.words) + 1
    arcs = pairs // width * (width - 1) + pairs % width
    automaton = Automaton(tokens, word_counts, total, distinct, arcs, counts, sums, kinds)

    def per_text(values: np.ndarray) -> np.ndarray:
        ends = np.append(0, np.cumsum(values))
        return ends[tokens.ends] - ends[tokens.starts]

    base = np.add.reduceat(automaton.root_weight[tokens.at], tokens.starts) if len(tokens.starts) else np.zeros(0)
    return {
        "n_tokens": tokens.counts,
        "n_known": per_text((word_counts > 0)[tokens.at].astype("int64")),
        "base_score": base,
        "score": automaton.score(tokens),
    }


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    The model learns from the rows that are not held out and scores all. A pair of words seen c
    times after a context seen n times with k kinds of words has (c + k p) / (n + k) as its
    probability, p being the add-half probability of the word: an arc of the automaton; others
    fail to the root with weight k / (n + k). ``base_score`` is by p alone.

    Texts are dealt once, evenly, over blocks of about a quarter of an input partition. Each
    block sends its distinct words, then its distinct pairs with their counts, to the parts
    where they are summed; what comes back are the counts of what it asked, in its order. Words
    are told apart by 64-bit hashes, and after a context by 48 bits. Pairs of a very common
    context are counted in several parts. Only two totals reach the driver. Nothing is pruned.

    NULL and empty texts are one end; a NULL id counts as the text "" for its fold; repeated
    rows are learnt and scored each; other columns are ignored; an empty table gives no rows.
    """
    n_blocks = parts = 4 * parts_of(df)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS
    dealt = df.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)).cast("int").alias("block"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        (fold == HELD_OUT).alias("held_out"),
    ).repartition(n_blocks, "block")

    def train_of(own: pa.Table) -> np.ndarray:
        return ~own["held_out"].to_numpy().astype(bool)

    def answers_of(told: pa.Table, kind: int) -> dict[int, dict]:
        return {row["part"]: row for row in told.to_pylist() if row["kind"] == kind}

    def words_asked(own: pa.Table) -> pa.Table:
        return ask_words(own["block"][0].as_py(), own["text"], train_of(own), parts)

    words_told = stored(dealt.groupBy("block").applyInArrow(words_asked, ASK).groupBy("part").applyInArrow(answer_words, ANSWER), "word-counts")
    sums = words_told.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    total, distinct = sums["tokens"] or 0, sums["distinct"] or 0

    def pairs_asked(own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _ASK.empty_table()
        return ask_pairs(own["block"][0].as_py(), own["text"], train_of(own), answers_of(told, 0), total, parts)

    first = words_told.withColumn("kind", F.lit(0))
    pairs_told = dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(pairs_asked, ASK).groupBy("part").applyInArrow(answer_pairs, ANSWER)
    told = first.unionByName(pairs_told.withColumn("kind", F.lit(1)))
    id_type = df.schema[id_col].dataType.simpleString()
    out = f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def scores(own: pa.Table, told: pa.Table) -> pa.Table:
        columns = {"id": own["id"], "held_out": own["held_out"]}
        if own.num_rows:
            columns |= scored_block(own["text"], train_of(own), answers_of(told, 0), answers_of(told, 1), total, distinct, parts)
        else:
            columns |= {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        types = [own.schema.field("id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.Table.from_pydict(columns, pa.schema(list(zip(columns, types, strict=True))))

    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(scores, out)
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
