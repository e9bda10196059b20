"""Chat formatting: budgeted windows of turns with a loss mask, and reading them back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

#: A turn is HEAD role MIDDLE text TAIL; what could be taken for any of these is escaped.
HEAD, MIDDLE, TAIL = "### ", ":\n", "\n</turn>\n"
_TEXT_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
_ROLE_ESCAPES = (*_TEXT_ESCAPES, (":", "\\c"))
TARGET, SYSTEM = "assistant", "system"

BUDGET, HISTORY = 512, 128
#: Turn numbers that share a partial sum, so that a very long conversation is summed by many tasks.
BUCKET = 256


def escaped(text: Column, escapes=_TEXT_ESCAPES) -> Column:
    """Every backslash of the result opens an escape, and no mark of the template is in it."""
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=_TEXT_ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _summed(turns: DataFrame) -> DataFrame:
    """turns with ``before``, the tokens of the conversation ahead of each."""
    order = ["turn", "role", "text"]
    turns = turns.withColumn("bucket", F.floor(F.col("turn") / BUCKET))
    sums = turns.groupBy("conv", "bucket").agg(F.sum("tokens").alias("sum"))
    ahead = W.partitionBy("conv").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    begins = sums.select(
        F.col("conv").alias("conv_"), F.col("bucket").alias("bucket_"), F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("begin")
    )
    inside = W.partitionBy("conv", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = turns.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    both = F.col("conv").eqNullSafe(F.col("conv_")) & F.col("bucket").eqNullSafe(F.col("bucket_"))
    return own.join(begins, both).select("conv", *order, "tokens", (F.col("begin") + F.col("inside")).alias("before"))


def format_windows(
    df: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, window, text, loss, n_repeated) per window of a conversation.

    A turn counts its words and two marks as tokens. Sums of the tokens ahead of each turn cut
    a conversation into spans of ``budget`` less ``history`` and the system turn (a quarter of
    the budget at least); a turn belongs to the span it begins in, so a span is over by part of
    one turn at most and no turn is cut or dropped. A window is the first system turn if it came
    earlier, the turns that begin within ``history`` tokens ahead of the span, and the span
    itself. ``n_repeated`` turns at its front were in earlier windows. ``loss`` are the
    [start, end) character ranges of the texts of new assistant turns, so each is a target once.

    Turns go by number, then role and text; equal rows are turns each; a NULL text or role is
    empty, a NULL number comes first, NULL conversation ids are one conversation. Other columns
    are ignored; an empty table gives no windows. Groups are windows, never conversations.
    """
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = _summed(turns.withColumn("tokens", (F.size(words) + 2).cast("long")))
    system = (
        own.where(F.col("role") == SYSTEM)
        .groupBy(F.col("conv").alias("conv_"))
        .agg(F.min(F.struct("before", "tokens", "role", "text")).alias("system"))
    )
    room = F.greatest(F.lit(budget // 4), F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)))
    own = own.join(system, F.col("conv").eqNullSafe(F.col("conv_")), "left").withColumn("room", room)
    own = own.withColumn("span", F.floor(F.col("before") / F.col("room")))
    ahead = F.col("before") + F.least(F.lit(history), F.col("room")) >= (F.col("span") + 1) * F.col("room")
    places = F.when(ahead, F.array("span", F.col("span") + 1)).otherwise(F.array("span"))
    cast = own.select(
        "conv",
        F.explode(places).alias("window"),
        "span",
        "system",
        F.struct("before", "role", "text", "span").alias("turn"),
    )
    windows = (
        cast.groupBy("conv", "window")
        .agg(
            F.sort_array(F.collect_list("turn")).alias("turns"),
            F.max(F.col("span") == F.col("window")).alias("new"),
            F.max("system").alias("system"),
        )
        .where("new")
    )
    again = F.when(
        F.col("system").isNotNull()
        & (F.col("system.before") < F.element_at("turns", 1)["before"]),
        F.array(
            F.struct(
                F.col("system.before").alias("before"),
                F.col("system.role").alias("role"),
                F.col("system.text").alias("text"),
                F.lit(-1).cast("long").alias("span"),
            )
        ),
    ).otherwise(F.slice("turns", 1, 0))
    windows = windows.withColumn("turns", F.concat(again, "turns"))
    # Head and text of each turn as written, and whether the text is a target.
    written = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), escaped(t["role"], _ROLE_ESCAPES), F.lit(MIDDLE)).alias("head"),
            escaped(t["text"]).alias("body"),
            ((t["span"] == F.col("window")) & (t["role"] == TARGET)).alias("target"),
        ),
    )
    windows = windows.select(
        "conv", "window", written.alias("written"), F.size(F.filter("turns", lambda t: t["span"] != F.col("window"))).alias("n_repeated")
    )
    none = F.slice(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), 1, 0)

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        end = (start + F.length(t["body"])).cast("long")
        mark = F.array(F.struct(start.cast("long").alias("start"), end.alias("end")))
        return F.struct(
            (end + len(TAIL)).alias("at"), F.when(t["target"], F.concat(state["loss"], mark)).otherwise(state["loss"]).alias("loss")
        )

    loss = F.aggregate("written", F.struct(F.lit(0).cast("long").alias("at"), none.alias("loss")), add, lambda state: state["loss"])
    text = F.array_join(F.transform("written", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))), "")
    return windows.select(F.col("conv").alias(conv_col), "window", text.alias("text"), loss.alias("loss"), "n_repeated")


def read_windows(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, window, turns, targets, chars): new turns as (role, text), texts under the mask, length as formatted."""
    pieces = F.split("text", TAIL)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, MIDDLE, 1)
        return F.struct(
            unescaped(F.substring(head, F.lit(len(HEAD) + 1), F.length(head)), _ROLE_ESCAPES).alias("role"),
            unescaped(F.substring(piece, F.length(head) + len(MIDDLE) + 1, F.length(piece))).alias("text"),
        )

    def target(mark: Column) -> Column:
        start, end = mark["start"].cast("int"), mark["end"].cast("int")
        return unescaped(F.substring(F.col("text"), start + 1, end - start))

    return windows.select(
        conv_col,
        "window",
        F.transform(new, turn).alias("turns"),
        F.transform("loss", target).alias("targets"),
        F.length("text").cast("long").alias("chars"),
    )


def digests(read: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation: turns, digests of turns and targets, characters.

    Windows are dealt by conversation and sorted; digests run over them one by one, so a task
    holds a batch of windows and never a conversation.
    """
    rows = read.select(
        conv_col,
        "window",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"),
        "chars",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key, open_ = None, None

        def closed() -> tuple:
            n, turns, loss_chars, loss, chars = open_
            return (key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        for batch in batches:
            done = []
            for conv, _, n, turns, targets, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ is None or conv != key:
                    if open_ is not None:
                        done.append(closed())
                    key, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                open_[0] += n
                open_[1].update(turns.encode())
                open_[2] += len(targets)
                open_[3].update(targets.encode())
                open_[4] += chars
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done, strict=True)), strict=True)), arrow)
        if open_ is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in closed()), strict=True)), arrow)

    kinds = {"n_turns": T.LongType(), "turns_sha256": T.StringType(), "loss_chars": T.LongType()}
    kinds |= {"loss_sha256": T.StringType(), "formatted_chars": T.LongType()}
    schema = T.StructType([read.schema[conv_col], *(T.StructField(n, k) for n, k in kinds.items())])
    arrow_kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(f.name, arrow_kinds[f.dataType.simpleString()]) for f in schema.fields])
    return rows.repartition(conv_col).sortWithinPartitions(conv_col, "window").mapInArrow(run, schema)
