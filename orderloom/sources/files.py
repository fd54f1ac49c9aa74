"""Batch sources: the raw orders CSV, flattened cart items CSV, the Parquet export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import CART_ITEMS, RAW_ORDERS
from orderloom.sources.csv_splits import read_csv_splits
from orderloom.session import shuffles_freed
from orderloom.sources.dialect import Dialect, detect

_CORRUPT = "_corrupt_record"

#: CSV that keeps text as it is: quotes doubled, spaces kept, NULL an empty field and '' a quoted one.
RESULT_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
RESULT_CSV_WRITE = RESULT_CSV | {"nullValue": "", "emptyValue": '""'}
#: a large CSV as gzip files (some sixth of the bytes at the fastest level); rows of a file, which one task reads
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}
#: an empty field is read as ``nullValue``, so this must be no text that occurs; quoted fields may hold newlines
RESULT_CSV_READ = RESULT_CSV | {"nullValue": "\0", "emptyValue": "", "multiLine": True}


def _splits(spark: SparkSession, path: str) -> bool:
    """Whether a file at ``path`` is larger than one task should read."""
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    return largest is not None and largest > limit


def read_orders_csv(spark: SparkSession, path: str, multi_line: bool = True, dialect: Dialect | None = None) -> DataFrame:
    """Header CSV, 16 text columns, malformed lines skipped.

    The delimiter, quote and escape are told from a sample of the lines unless ``dialect``
    names them; lines that no delimiter cuts evenly are an error.

    PERMISSIVE with a corrupt-record column and an explicit filter: unlike
    DROPMALFORMED, the drop does not depend on which columns a later query
    happens to prune. A quoted empty string reads as NULL.

    ``multi_line`` lets quoted fields span lines. Spark's reader parses such a file in
    one task; files of more than maxPartitionBytes are read in many tasks instead
    (``csv_splits``). Pass False for a feed without embedded newlines.
    """
    dialect = dialect or detect(spark, path)
    if multi_line and _splits(spark, path):
        return read_csv_splits(spark, path, RAW_ORDERS, dialect)
    schema = T.StructType(RAW_ORDERS.fields + [T.StructField(_CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(schema)
               .option("header", True)
               .option("multiLine", multi_line)
               .options(**dialect.options())
               .option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", _CORRUPT)
               .csv(path))
    # The corrupt flag is computed only while a declared column is read, also under a bare
    # count(): the filter always holds for the last column but cannot be folded away.
    last = F.col(RAW_ORDERS.fieldNames()[-1])
    parsed = F.coalesce(F.length(last), F.lit(0)) >= 0
    return df.filter(F.col(_CORRUPT).isNull() & parsed).select(*RAW_ORDERS.fieldNames())


def write_orders_csv(raw: DataFrame, path: str, delimiter: str = ",", gzip: bool = False) -> None:
    """Write a raw feed as header CSV, keeping surrounding spaces (Spark trims by default)."""
    writer = (raw.select(*RAW_ORDERS.fieldNames()).write.mode("overwrite")
              .option("header", True).options(**Dialect(delimiter).options(), **(GZIP if gzip else {})))
    with shuffles_freed(raw.sparkSession):
        writer.csv(path)


def read_cart_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flattened snapshot items, typed by the declared 12-column schema."""
    return spark.read.schema(CART_ITEMS).options(**RESULT_CSV_READ).csv(path)


def read_sales_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: the year/month partitioned export; filters on year/month prune folders."""
    return spark.read.parquet(path)


def read_snapshots(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed snapshot documents with the declared nested schema.

    NDJSON (one document per line) splits across tasks; ``multi_line`` reads
    pretty-printed files, one document per file.
    """
    from orderloom.schemas import SNAPSHOT
    return spark.read.schema(SNAPSHOT).option("multiLine", multi_line).json(path)
