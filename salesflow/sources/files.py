"""CSV, ORC and prediction files."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.schema import PREDICTIONS, RAW, RAW_TEXT, SALES
from salesflow.session import first_lines

if TYPE_CHECKING:
    import pyarrow as pa

ARRIVAL = ("arrived_at", "arrived_file", "arrived_block", "arrived_row")


#: Ordinary CSV: a quote inside a quoted field is doubled, and a quoted field may hold line ends.
QUOTING = {"quote": '"', "escape": '"'}
# The texts that mean a missing value in raw files.
MISSING = tuple(
    "|#N/A|#N/A N/A|#NA|-1.#IND|-1.#QNAN|-NaN|-nan|1.#IND|1.#QNAN|<NA>|N/A|NA|NULL|NaN|None|n/a|nan|null".split("|")
)


def read_raw_csv(
    spark: SparkSession, path: str | list[str], as_text: bool = False, multi_line: bool = False
) -> DataFrame:
    """Raw sales CSV: fields by the names in the header line, whatever their order; other columns are left out.

    Files read together share one header. A field that the header lacks is an
    error. ``multi_line`` allows line ends inside quoted fields; such files
    are not split over tasks. Texts that stand for a missing value are NULL.
    A typed read leaves a value that does not fit NULL; ``as_text`` with
    ``tag_rejects`` says why.
    """
    options = QUOTING | {"header": True, "multiLine": multi_line, "enforceSchema": False}
    found = spark.read.csv(path, **options)
    absent = [f.name for f in RAW.fields if f.name not in found.columns]
    if absent:
        raise ValueError(f"no such column in the header: {', '.join(absent)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found.columns])
    text = spark.read.schema(schema).csv(path, **options)

    def cell(name: str) -> Column:
        return F.when(~F.col(f"`{name}`").isin(*MISSING), F.col(f"`{name}`"))

    if as_text:
        return text.select(*[cell(f.name).alias(f.name) for f in RAW_TEXT.fields])
    typed = {f.name: f.dataType.simpleString() for f in RAW.fields}
    return text.select(*[(cell(n) if t == "string" else cell(n).try_cast(t)).alias(n) for n, t in typed.items()])


def read_mixed_csv(spark: SparkSession, path: str, as_text: bool = False, multi_line: bool = False) -> DataFrame:
    """All raw sales CSV files in and below a folder, each by the names in its own header line; see ``read_raw_csv``.

    Files with the same header line are one scan, so there are as many scans
    as different headers. Files without any line are left out; a folder
    without files gives no rows.
    """
    groups: dict[str, list[str]] = {}
    for file, header in sorted(first_lines(spark, path).items()):
        if header.strip():
            groups.setdefault(header.removeprefix("\ufeff").rstrip("\r"), []).append(file)
    if not groups:
        return spark.createDataFrame([], RAW_TEXT if as_text else RAW)
    return reduce(DataFrame.unionByName, [read_raw_csv(spark, files, as_text, multi_line) for files in groups.values()])


def read_csv_inferred(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with types inferred from the data: one more pass over the text than a declared schema."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio)


def write_predictions(scored: DataFrame, path: str) -> None:
    """Headerless CSV, replaced as a whole; an empty input leaves a readable empty folder."""
    scored.write.mode("overwrite").format("csv").options(header="false", **QUOTING).save(path)


def scan_predictions(spark: SparkSession, *folders: str) -> DataFrame:
    """All prediction files in and below the folders as one DataFrame; columns by position."""
    return spark.read.schema(PREDICTIONS).csv(
        list(folders), header=False, pathGlobFilter="*.csv", recursiveFileLookup=True, **QUOTING
    )


def with_arrival(scan: DataFrame) -> DataFrame:
    """Add the order in which rows arrived: file time, file, block, row within the block.

    Must be applied to the scan itself. Row ids grow along a block, and
    blocks of one file are ordered by their offset, so the four columns
    reproduce "files by modification time, then line by line" however the
    files are split over tasks. A retried task reads the same block and
    gives the same values.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("arrived_file"),
        F.col("_metadata.file_block_start").alias("arrived_block"),
        F.monotonically_increasing_id().alias("arrived_row"),
    )


def _rows_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``_row``, which counts the rows of a file's block; a task reads its blocks one after the other."""
    import pyarrow

    block, count = None, 0
    for batch in batches:
        rows = []
        for own in zip(batch.column("_file").to_pylist(), batch.column("_block").to_pylist()):
            block, count = own, (count + 1 if own == block else 0)
            rows.append(count)
        yield pyarrow.RecordBatch.from_arrays([*batch.columns, pyarrow.array(rows, pyarrow.int64())], names=[*batch.schema.names, "_row"])


def with_row_ids(scan: DataFrame, into: str = "id") -> DataFrame:
    """Add an id that no other row has, equal rows included: a digest of file, block and row in the block.

    Must be applied to the scan itself. No shuffle. A retried task, and a
    later run that cuts the files alike (``spark.sql.files.maxPartitionBytes``
    and the number of cores), give every row the same id. A column named ``into`` is replaced.
    """
    kept = [c for c in scan.columns if c.lower() != into.lower()]
    located = scan.select(*[f"`{c}`" for c in kept], F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    schema = T.StructType([*located.schema.fields, T.StructField("_row", T.LongType())])
    numbered = located.mapInArrow(_rows_of_blocks, schema)
    own = F.sha2(F.concat_ws("|", "_block", "_row", "_file"), 256)
    return numbered.withColumn(into, own).drop("_file", "_block", "_row")


def create_sales_table(spark: SparkSession, name: str, location: str) -> None:
    """The stored sales table, ORC, unless it exists already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SALES.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING ORC LOCATION '{location}'")
