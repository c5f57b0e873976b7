"""The product dump: 46 comma-separated fields, no header, quoted text that
may hold commas, doubled quotes, markup and line breaks.

Only positions 0, 10 and 23 have known names (encodedkey, id, name); the
others are ``cNN`` by position.  Types follow the clean dump.

Reading a multi-line CSV cannot split a file inside a record, so each file is
one task: a large dump should be many part files (as ``write_product_dump`` writes
it, ``FILE_RECORDS`` at most in each), or be read with
``product_repair.repair_product_dump``, which splits files anywhere and puts
clean and damaged records together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import program_scope

# Field types by position, as in the clean dump.
_BOOL = {1, 2, 7, 8, 9, 15, 29, 30, 36, 41, 43}
_TS = {3, 16}
_DOUBLE = {18, 21, 34}
_DECIMAL = {20, 22, 25, 28, 42}
_NAMES = {0: "encodedkey", 10: "id", 23: "name"}

N_FIELDS = 46
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Records of a written part file at most, as a file is read whole by one task.
FILE_RECORDS = 20_000


def field_name(pos: int) -> str:
    return _NAMES.get(pos, f"c{pos:02d}")


def _type(pos: int) -> T.DataType:
    if pos in _BOOL:
        return T.BooleanType()
    if pos in _TS:
        return T.TimestampNTZType()
    if pos in _DOUBLE:
        return T.DoubleType()
    if pos in _DECIMAL:
        return T.DecimalType(38, 10)
    return T.StringType()


PRODUCT_SCHEMA = T.StructType([T.StructField(field_name(i), _type(i), True) for i in range(N_FIELDS)])


def read_product_dump(spark: SparkSession, path: str, null_text: str | None = None) -> DataFrame:
    """Read dump files with the declared schema.

    ``null_text``: the text that stands for NULL besides the empty field
    (``'None'`` in dumps written from Python objects).
    """
    r = (spark.read.schema(PRODUCT_SCHEMA)
         .option("header", False).option("multiLine", True)
         .option("quote", '"').option("escape", '"')
         .option("timestampNTZFormat", TS_FORMAT)
         .option("mode", "FAILFAST"))
    if null_text is not None:
        r = r.option("nullValue", null_text)
    return r.csv(path)


def write_product_dump(df: DataFrame, path: str) -> None:
    """Write records in the dump's format: quote only where needed, quotes
    doubled, timestamps ``yyyy-MM-dd HH:mm:ss``, NULL as an empty field.  A task
    with more than ``FILE_RECORDS`` records writes several part files."""
    (df.write.mode("overwrite")
     .option("maxRecordsPerFile", FILE_RECORDS)
     .option("header", False).option("quote", '"').option("escape", '"')
     .option("timestampNTZFormat", TS_FORMAT)
     .csv(path))


CORRUPT = "_damaged_record"


def split_product_dump(spark: SparkSession, path: str,
                       null_text: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Read a possibly damaged dump as ``(records, damaged)``.

    Records that do not parse into the 46 typed fields — an unquoted comma
    giving 47 fields, a record cut at a line break, a value of the wrong
    type — go to ``damaged`` as their raw text (column ``_damaged_record``,
    with ``encodedkey`` as far as it parsed); ``records`` holds the rest.  ``read_product_dump`` (FAILFAST) instead
    stops at the first such record.
    """
    schema = T.StructType(PRODUCT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    r = (spark.read.schema(schema)
         .option("header", False).option("multiLine", True)
         .option("quote", '"').option("escape", '"')
         .option("timestampNTZFormat", TS_FORMAT)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if null_text is not None:
        r = r.option("nullValue", null_text)
    # parse once and write the result (damaged text included) to the shared
    # folder: the multi-line CSV is read a single time, and Spark refuses
    # queries on a raw CSV that touch only the corrupt-record column
    parsed = program_scope(spark).new_path("product-dump-parsed")
    r.csv(path).write.mode("overwrite").parquet(parsed)
    df = spark.read.parquet(parsed)
    records = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    damaged = df.filter(F.col(CORRUPT).isNotNull()).select("encodedkey", CORRUPT)
    return records, damaged
