"""Symbol master lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barforge.functions import normalize_symbol
from barforge.schemas import MASTER, SYMBOL_SUFFIX


def read_constituents(spark: SparkSession, path: str) -> DataFrame:
    """Index constituents CSV with a header row (S1). Every column is read
    as text; nothing is inferred."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def master_symbols(constituents: DataFrame, suffix: str = SYMBOL_SUFFIX) -> DataFrame:
    """Trimmed, suffixed symbols with company names."""
    return constituents.select(normalize_symbol(F.col("Symbol"), suffix).alias("symbol"),
                               F.col("`Company Name`").alias("company_name"))


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """The master list: a file or a whole folder of CSV files, one header
    line each, fields optionally enclosed in double quotes, columns taken by
    position (S2, S3). A missing path raises an error naming the fix."""
    try:
        return (spark.read.schema(MASTER)
                     .option("header", True).option("enforceSchema", True)
                     .option("quote", '"').option("escape", '"')
                     .csv(path))
    except Exception as e:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(
                f"{path} not found: write the master list first (write_master)") from e
        raise


#: The column that holds a row as it stands in the file, if it does not fit.
RAW = "_raw"


def read_master_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a master list that may hold bad records.

    A record with too few or too many fields, or with a broken quotation, or
    without a symbol, is no row of the list: it is kept as its raw text
    (``record``) among the rejects. The file is parsed once, whole, and
    written to the shared folder; column pruning would change what the parser
    calls a bad record."""
    from barforge.sources.storage import materialise

    raw = StructType([*MASTER.fields, StructField(RAW, StringType())])
    parsed = (spark.read.schema(raw).option("header", header).option("enforceSchema", True)
                   .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", RAW).csv(path))
    parsed = materialise(parsed)
    bad = F.col(RAW).isNotNull() | F.col("symbol").isNull()
    return (parsed.where(~bad).select(*MASTER.names),
            parsed.where(bad).select(F.coalesce(RAW, F.concat(F.lit(","), "company_name"), F.lit("")).alias("record")))


def rejects_path(path: str) -> str:
    """Where the rejects of a master list are written: beside it."""
    return f"{path.rstrip('/')}__rejects"


def load_master(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The good rows of a master list; its rejects are written beside it, one record a line."""
    rows, rejects = read_master_checked(spark, path, header)
    rejects.write.mode("overwrite").text(rejects_path(path))
    return rows


def write_master(master: DataFrame, path: str) -> None:
    """Master list as one CSV file with a header, no index (S6). The list
    has one row per index member, so a single output file is bounded."""
    (master.select(F.col("symbol").alias("Symbol"), F.col("company_name").alias("Company Name"))
           .coalesce(1).write.mode("overwrite").option("header", True).csv(path))
