"""Damaged Parquet files, found by the executors."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession


def damaged_files(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Reasons by name of the files that cannot be read to their end.

    Executors fetch each file through Spark's own file systems, read its footer, then every
    page of every column, one row group at a time, with page checksums where the file has
    them. A file that breaks in the middle is named like one without a footer, so a reader can
    leave it out whole; so is one that the file system does not give out. Spark packs files into
    tasks of ``spark.sql.files.maxPartitionBytes``; a task holds that much.
    """

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            reasons = []
            for i in range(batch.num_rows):
                reason = None
                try:
                    content = pa.BufferReader(batch["content"][i].as_buffer())
                    file = pq.ParquetFile(content, page_checksum_verification=True)
                    for group in range(file.num_row_groups):
                        file.read_row_group(group, use_threads=False)
                except (pa.ArrowException, OSError, ValueError) as error:
                    reason = str(error).split("\n")[0]
                reasons.append(reason)
            columns = [batch["path"], pa.array(reasons, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "reason"])

    if not files:
        return {}
    reader = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true")
    checked = reader.load(list(files)).select("path", "content").mapInArrow(check, "path string, reason string")
    found = {plain_name(row.path): row.reason for row in checked.collect()}
    reasons = {file: found.get(plain_name(file), "could not be fetched") for file in files}
    return {file: reason for file, reason in reasons.items() if reason}


def plain_name(file: str) -> str:
    """A file's name in one form: Spark writes local ones with one slash or three."""
    return re.sub("^file:/+", "file:/", unquote(file))
