"""CSV export of a query result (the dashboard's download).

Header row, comma separator, minimal quoting with doubled quotes, times as
``yyyy-MM-dd HH:mm:ss``.  NULL is written as an empty field and an empty
string as ``""`` so both survive a round trip (read back with
``read_export``).  The write is distributed: one file per task, no
coalescing of the result onto a single executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV dialect of the export.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


# A quoted empty field reads as this marker (never produced by the writer,
# which escapes quotes), and is then turned back into "".  Reading it as ""
# directly would make it equal to ``nullValue`` and so NULL.
_EMPTY_MARK = "\u0000empty\u0000"


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back with its schema (quoted newlines allowed).

    NULL and empty strings come back as they were written.
    """
    df = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("multiLine", "true")
        .option("emptyValue", _EMPTY_MARK)
        .csv(path)
    )
    return df.select(
        *[
            F.when(F.col(f.name) == F.lit(_EMPTY_MARK), F.lit("")).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )
