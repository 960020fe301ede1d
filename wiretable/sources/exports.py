"""Capture field-export sources (S1-S5) and the staged/table scans.

Binary captures are decoded upstream by a capture tool; the engine reads its
text exports.  Two layouts exist:

* ``raw16`` — tab separated, header, unquoted, IPv4 and IPv6 columns;
* ``raw13`` — comma separated, double-quoted, header, IPv4 only.

Every row keeps the file it came from (``source_file``) through the hidden
``_metadata`` column, so per-file accounting needs no per-file loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW13, RAW13_FIELDS, RAW16, Profile, profile as _profile


# Holds the text of a row whose number of fields is not the export's.
ODD_ROW = "_odd_row"


def file_name(c: Column) -> Column:
    """File name of a ``_metadata`` path: its percent escapes decoded, ``+`` kept."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def list_exports(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """Non-recursive listing of files matching ``glob`` (path, source_file, bytes), sorted.

    Uses the binary-file source with its content column pruned, so only file
    metadata is read.  An empty listing is an error, as in the reference.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "false").load(directory)
               .select("path", file_name(F.col("_metadata.file_name")).alias("source_file"),
                       F.col("length").alias("bytes"))
               .orderBy("path"))
    if not listing.head(1):
        raise FileNotFoundError(f"no export matching {glob!r} in {directory}")
    return listing


def export_options(reader, prof: str | Profile, glob: str | None = None):
    """Schema and options of a profile's export, for a batch or a stream reader.

    ``raw16``: tab separated, unquoted; short rows are padded with NULLs.
    ``raw13``: comma separated; a field may be quoted, quotes inside it are
    doubled and a backslash is an ordinary character.  Rows with another number
    of fields come with their text in ``ODD_ROW``: longer rows are valid (the
    first 13 fields count), shorter ones are not.
    """
    prof = _profile(prof)
    if prof.ipv6:
        reader = (reader.schema(RAW16).option("sep", "\t").option("header", True)
                  .option("quote", "").option("escape", "")
                  .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))
    else:
        schema = T.StructType([*RAW13.fields, T.StructField(ODD_ROW, T.StringType())])
        # Without column pruning every row is parsed whole, so its fields are counted.
        reader = (reader.schema(schema).option("sep", ",").option("header", True)
                  .option("quote", '"').option("escape", '"').option("columnPruning", False)
                  .option("columnNameOfCorruptRecord", ODD_ROW))
    reader = reader.option("mode", "PERMISSIVE")
    return reader.option("pathGlobFilter", glob) if glob else reader


def with_lineage(df: DataFrame, by_folder: bool = False) -> DataFrame:
    """Adds ``source_file``, and ``short_row`` where the export can have short rows.

    ``by_folder``: a capture's export is a folder of part files, named by the folder.
    """
    source = (F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1) if by_folder
              else F.col("_metadata.file_name"))
    df = df.withColumn("source_file", file_name(source))
    if ODD_ROW not in df.columns:
        return df
    # Possessive, as a backtracking group recurses once per character of a long field.
    outside = F.regexp_replace(F.col(ODD_ROW), '"(?:[^"]++|"")*+(?:"|$)', "")
    commas = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    # A short row lacks its last field; reading that column too, the odd rows can be asked for alone.
    short = F.col(f"`{RAW13_FIELDS[-1]}`").isNull() & (commas < len(RAW13_FIELDS) - 1)
    return df.withColumn("short_row", F.coalesce(short, F.lit(False))).drop(ODD_ROW)


def read_export(spark: SparkSession, path: str, prof: str | Profile,
                glob: str | None = None, by_folder: bool = False) -> DataFrame:
    """A profile's text exports, with their lineage."""
    return with_lineage(export_options(spark.read, prof, glob).csv(path), by_folder)


def read_stage(spark: SparkSession, path: str, schema: T.StructType | str,
               fmt: str = "parquet") -> DataFrame:
    """Scan a stage written by an earlier run with its declared schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, name: str = "network_traffic") -> DataFrame:
    return spark.table(name)
