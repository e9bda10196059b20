"""Documents to training sequences: quality rules, near and passage dedup, packing.

Each stage takes the documents that the one before has kept, and its decisions take effect: the
quality rules and the near-copy stage drop rows, the passage stage cuts texts, and the last one
returns pieces of sequences. Functions of (spark, docs, sf_dir), as in STAGES.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmood.llm import near_copies, packing, passages, quality
from threadmood.llm.queries import TOKENIZER_FILE
from threadmood.llm.shared import stored

#: Groups that rows of one id and text are dealt over before one of them is chosen.
SPREAD = 32


def quality_kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rules give a posterior quality of one half or more and that pass the base rules.

    NULL and empty texts are dropped, since they have no words. Each row is judged by itself.
    """
    return quality.judged(docs, whole=True).where("kept").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over five-word shingles, one row: that with the smallest id.

    Documents without words are linked with nothing and stay. What is linked are rows, told apart
    by 64 bits of id and text: an id on two texts is two documents, each judged by its own text, and
    of rows with one id and one text any one stays. A row with a NULL id is a document like others
    and stays unless it is a copy; of its copies those with an id are kept before it.
    """
    row = F.xxhash64("doc_id", "text").alias("row_")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    worded = docs.where(has_words)
    found = near_copies.near_copies(worded.select(row, "text"), words=5, id_col="row_").select("row_", "component_id").distinct()
    rows = worded.select(row, "doc_id").groupBy("row_", "doc_id").agg(F.count("*").alias("n"))
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_", "n")).alias("own")
    kept = stored(rows.join(found, "row_").groupBy("component_id").agg(smallest).select("own.row_", "own.n"), "one-of-each")
    numbered = docs.where(has_words).withColumn("row_", row)
    out = numbered.join(kept.where("n = 1").hint("shuffle_hash"), "row_", "left_semi")
    often = kept.where("n > 1")
    if not often.isEmpty():
        # Rows that are there often are dealt over several groups, and thinned out in each before they meet.
        spread = often.select("row_", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("deal_"))
        dealt = numbered.withColumn("deal_", (F.monotonically_increasing_id() % SPREAD).cast("int"))
        met = dealt.join(spread.hint("shuffle_hash"), ["row_", "deal_"], "left_semi").drop("deal_")
        out = out.unionByName(met.dropDuplicates(["row_"]))
    return out.select(*docs.columns).unionByName(docs.where(~has_words))


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of any 200-byte string that starts twice or more; ``n_chars`` is counted anew.

    A document of which nothing is left stays, with an empty text.
    """
    return passages.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences; see packing.pack."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER_FILE))


STAGES = [
    ("quality rules", quality_kept),
    ("near copies", one_of_each),
    ("repeated passages", without_passages),
    ("packing", packed),
]

#: Components and byte spans have no SQL form of bearable cost; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written once to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
