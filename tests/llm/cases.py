"""Rows that every operator on documents must take: real ones, and NULL, empty, long and repeated ones."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(15_000))
#: Named like columns that operators use inside.
CLASHING = "id key block n part u v kept votes text_ words row group shard span window ids bytes page".split()

ODD_TEXTS = [
    None,
    "",
    " \t\n\r\x0b\x0c ",
    "one",
    "one",
    "Two words",
    "two WORDS",
    "ÉTÉ été ｆｕｌｌ 日本 語 です 。 ｘ　y \x85z   ß 𝔘 ² ½",
    "a  b   c \n d\t\te \x1c f \xa0 g",
    "same words " * 40,
    "<|endoftext|> ### </turn> \\ \\n {} $1 %s",
    LONG,
    LONG + " end",
    "x" * 5000,
]


def documents(spark, sf_dir):
    """The table, odd rows, rows that are equal as a whole, a NULL id, and columns with clashing names."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(10_000 + i, text) for i, text in enumerate(ODD_TEXTS)]
    odd += [(20_000, "a row that is there three times over, word for word and id for id")] * 3
    odd = spark.createDataFrame([*odd, (None, "a row without an id")], "doc_id long, text string")
    rows = table.unionByName(odd.repartition(3))
    return rows.select(*(F.lit(f"extra {c}").alias(c) for c in CLASHING), "doc_id", "text")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def collected(df):
    return [row.asDict(recursive=True) for row in df.collect()]
