"""Footers of delivered Parquet files, read inside Spark tasks.

The listing stays distributed and each task opens the ends of its files: one job for any number of files, no
data page is read, and neither the list nor the footers pass through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"
# stores that the tasks open themselves; files of others are handed to them by Spark, whole
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}
FOOTER = "n_records bigint, data_schema string, error string"


def _open(path: str):
    scheme, _, rest = path.partition(":")
    if scheme == "file":  # one slash or three
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, inner = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")
    return store.open_input_file(inner)


def spark_schema(file: pq.ParquetFile) -> T.StructType:
    """The schema that Spark reads the file with: its own note in the footer, else by the file's types."""
    kept = (file.metadata.metadata or {}).get(ROW_METADATA)
    if kept:
        return T.StructType.fromJson(json.loads(kept))
    found = from_arrow_schema(file.schema_arrow, prefer_timestamp_ntz=True)
    old = {file.schema.column(i).path for i in range(len(file.schema)) if file.schema.column(i).physical_type == "INT96"}
    return T.StructType([T.StructField(f.name, T.TimestampType()) if f.name in old else f for f in found])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        counts, schemas, errors = [], [], []
        for r in range(batch.num_rows):
            rows, schema, error = None, None, None
            try:
                given = batch.column("content")[r].as_buffer() if "content" in names else None
                with pa.BufferReader(given) if given is not None else _open(batch.column("path")[r].as_py()) as source:
                    file = pq.ParquetFile(source)
                    rows, schema = file.metadata.num_rows, json.dumps(spark_schema(file).jsonValue())
            except Exception as e:  # noqa: BLE001  whatever is wrong with a delivered file is a finding
                error = type(e).__name__
            counts.append(rows)
            schemas.append(schema)
            errors.append(error)
        kept = [n for n in names if n != "content"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(counts, pa.int64()), pa.array(schemas, pa.string()), pa.array(errors, pa.string())],
            [*kept, "n_records", "data_schema", "error"],
        )


def footers(spark: SparkSession, root: str, partition_types: dict[str, str], some: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(partition columns, path, n_records, data_schema, error) of every file below ``root``; ``error`` if it has no footer.

    ``some`` filters by the partition columns, which prunes directories. ``data_schema`` is Spark's JSON.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    files = some(files) if some else files
    by = [F.col(c).cast(t).alias(c) for c, t in partition_types.items()]
    handed = [] if ":" not in root or root.partition(":")[0] in SCHEMES else ["content"]
    ddl = ", ".join(f"{c} {t}" for c, t in partition_types.items())
    return files.select(*by, "path", *handed).mapInArrow(_read, f"{ddl}, path string, {FOOTER}")
