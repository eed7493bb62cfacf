"""Batch tables: Parquet (also with drifting schemas), CSV, nested JSON documents."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import plain_files

# Paths whose footers are looked at together.
FOOTER_THREADS = 8


# Column of a text row that its schema does not fit.
BAD_ROW = "_bad_row"


def read_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """A Parquet file or folder; filters and column selection reach the scan.

    Give the schema of a partitioned table: without one the types of its partition columns are guessed from
    the folder names, and the text `01` comes back as the number 1.
    """
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def harmonise_union(frames: list[DataFrame], casts: dict[str, str]) -> DataFrame:
    """Union of frames whose schemas have drifted apart.

    The first frame names the columns: others are projected onto it, extra columns are dropped, and a
    missing column raises an AnalysisException. `casts` gives the common type of columns that drift.
    """
    columns = frames[0].columns
    aligned = [
        frame.select(*(F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in columns))
        for frame in frames
    ]
    return reduce(DataFrame.unionByName, aligned)


def read_drifting(
    spark: SparkSession, paths: list[str], casts: dict[str, str], schemas: list[StructType] | None = None
) -> DataFrame:
    """Parquet paths whose schemas drift, as one table with the columns of the first path, its widest file if they differ.

    One reader over files that hold a column as INT and as DOUBLE fails whatever `mergeSchema` says, so files
    are grouped by schema, those of a folder too: the plan has one scan per distinct schema. Each file costs a
    small job that reads a footer; these run side by side. With very many files give `schemas`, one per path,
    which all files of the path are taken to have; then no footer is read here.
    """
    if schemas is None:
        with ThreadPoolExecutor(FOOTER_THREADS) as pool:
            listed = list(pool.map(lambda path: plain_files(spark, path) or sorted(spark.read.parquet(path).inputFiles()), paths))
            paths = [file for files in listed for file in files]
            schemas = list(pool.map(lambda file: spark.read.parquet(file).schema, paths))
        first = max(range(len(listed[0])), key=lambda at: len(schemas[at]))
        for each in (paths, schemas):
            each.insert(0, each.pop(first))
    groups: dict[str, list[int]] = {}
    for at, schema in enumerate(schemas):
        groups.setdefault(schema.json(), []).append(at)
    scans = [spark.read.schema(schemas[same[0]]).parquet(*(paths[at] for at in same)) for same in groups.values()]
    return harmonise_union(scans, casts)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    header: bool = True,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV with a declared schema, so that no pass over the file infers one.

    A header has to name the schema's columns in its order, else reading raises. In PERMISSIVE mode a cell
    that does not fit its type is NULL and surplus cells are left out, see `rejected_csv`; FAILFAST raises.
    """
    return spark.read.schema(schema).csv(
        path, header=header, enforceSchema=not header, timestampFormat=timestamp_format, mode=mode
    )


def _bad_rows(rows: DataFrame) -> DataFrame:
    """Rows with text in BAD_ROW. All columns are read, for a row is checked on the columns that are read only."""
    cells = F.hash(*(c for c in rows.columns if c != BAD_ROW))
    return rows.filter(F.col(BAD_ROW).isNotNull() & (cells >= -(1 << 31)))


def _rejected(reader: DataFrameReader, schema: str | StructType) -> DataFrameReader:
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    probe = StructType(list(declared.fields)).add(BAD_ROW, "string")
    return reader.schema(probe).option("columnNameOfCorruptRecord", BAD_ROW)


def rejected_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    header: bool = True,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
) -> DataFrame:
    """Rows of a CSV with a cell that does not fit or a cell too few or too many; the row is in `_bad_row`."""
    reader = _rejected(spark.read, schema).options(header=header, timestampFormat=timestamp_format)
    return _bad_rows(reader.csv(path))


def read_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON documents, one per line; a field that only some documents have is a nullable column.

    What does not fit is NULL, see `rejected_documents`.
    """
    return spark.read.schema(schema).json(path)


def rejected_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Documents that do not parse or have a field of another type; the line is in `_bad_row`."""
    return _bad_rows(_rejected(spark.read, schema).json(path))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Give `df` a name for SQL text in this session."""
    df.createOrReplaceTempView(name)
    return df
