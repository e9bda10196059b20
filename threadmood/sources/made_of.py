"""What an output was made of, as a short text that is stored with it: other inputs or settings give another text."""

from __future__ import annotations

import hashlib
import posixpath
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The file of an output that says what it was made of; readers pass over names like this.
MADE_OF = "_made_of"


def chained(*parts: object) -> str:
    """One text for parts in this order."""
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()


def of_frame(df: DataFrame) -> str:
    """The columns of a DataFrame, and names, sizes and times of all files in the folders it reads.

    The files are listed by Spark and summed up over the cluster; no file is opened. Rows that come from
    no file count by their columns alone.
    """
    folders = sorted({posixpath.dirname(name) for name in df.inputFiles()})
    if not folders:
        return chained(df.schema.json())
    files = df.sparkSession.read.format("binaryFile").load([unquote(folder) for folder in folders])
    number = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.select(number.alias("number")).agg(F.count("*"), F.sum("number")).first()
    return chained(df.schema.json(), *row)
