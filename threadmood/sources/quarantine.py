"""Records that do not fit a declared schema, set apart by the scan that meets them, with their text and the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmood.functions.scalar import as_whole_number
from threadmood.sources import paths

#: Columns of a rejected record; names that no input may use.
FILE, RECORD, REASON, FITS = "_file", "_record", "_reason", "_fits"
_CORRUPT = "_corrupt"
NOT_JSON, FIELD_COUNT, NOT_WHOLE = "not a JSON object", "another number of fields than the header", "not a whole number"


@dataclass(frozen=True)
class Separated:
    """``rows`` fit the schema; ``rejected`` are (file, record, reason). Both are stored."""

    rows: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int


def as_text(schema: T.StructType) -> T.StructType:
    """The schema with whole numbers as text, since inputs may hold them as text or decimals."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.IntegralType) else f.dataType) for f in schema.fields])


def _checked(text: DataFrame, schema: T.StructType, record: Column, broken: Column) -> DataFrame:
    """Typed columns with the record and the reason where one does not fit; ``broken`` is a reason or NULL."""
    typed, reasons = [], [broken]
    for field in schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            value, wrong = as_whole_number(value, field.dataType.simpleString())
            reasons.append(F.when(wrong, f"{NOT_WHOLE}: {field.name}"))
        typed.append(value.alias(field.name))
    reason = F.coalesce(*reasons)
    kept = F.when(reason.isNotNull(), record)
    return text.select(*typed, F.when(reason.isNotNull(), F.col(FILE)).alias(FILE), kept.alias(RECORD), reason.alias(REASON))


def parse_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per line that is not blank; a line that is no JSON object or holds other values has a reason."""
    lines = spark.read.text(path).select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE)).where(F.trim(RECORD) != "")
    inner = T.StructType([*as_text(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(RECORD, inner, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = lines.withColumn("parsed", parsed).select("parsed.*", FILE, RECORD)
    # An array or a bare value parses to nothing without being called corrupt.
    object_ = F.ltrim(RECORD).startswith("{")
    return _checked(rows, schema, F.col(RECORD), F.when(F.col(_CORRUPT).isNotNull() | ~object_, NOT_JSON))


def parse_csv(spark: SparkSession, path: str, schema: T.StructType, header: list[str]) -> DataFrame:
    """One row per record of headered CSV; one with more or fewer fields than the header has a reason."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in (*header, _CORRUPT)])
    read = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    rows = read.schema(text).csv(path).select("*", F.col("_metadata.file_path").alias(FILE))
    record = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*(F.col(f"`{name}`") for name in header))))
    return _checked(rows, schema, record, F.when(F.col(_CORRUPT).isNotNull(), FIELD_COUNT))


def required(parsed: DataFrame) -> DataFrame:
    """The rows, where a record that does not fit is an error."""
    message = F.concat(F.col(REASON), F.lit(": "), F.col(RECORD))
    fits = F.when(F.col(REASON).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    return parsed.where(fits).drop(FILE, RECORD, REASON)


def separate(parsed: DataFrame, path: str) -> Separated:
    """Write rows and rejected records in one pass, counted on the way, unless a finished table is there."""
    spark = parsed.sparkSession
    fits = F.col(REASON).isNull()
    if paths.is_finished(spark, path):
        counts = None
    else:
        seen = Observation()
        counted = parsed.observe(seen, F.count_if(fits).alias("rows"), F.count(REASON).alias("rejected"))
        counted.withColumn(FITS, fits).write.mode("overwrite").partitionBy(FITS).parquet(path)
        counts = seen.get
    stored = spark.read.schema(T.StructType([*parsed.schema.fields, T.StructField(FITS, T.BooleanType())])).parquet(path)
    if counts is None:
        counts = stored.agg(F.count_if(FITS).alias("rows"), F.count_if(~F.col(FITS)).alias("rejected")).first().asDict()
    columns = [name for name in parsed.columns if name not in (FILE, RECORD, REASON)]
    rejected = stored.where(~F.col(FITS)).select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"), F.col(REASON).alias("reason"))
    return Separated(stored.where(FITS).select(*columns), rejected, counts["rows"], counts["rejected"])
