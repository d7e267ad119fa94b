"""GeoParquet sink: exact row groups and a ``geo`` footer key.

Spark's own Parquet writer offers neither, so the rows leave through a Python
data source whose tasks each write one file with pyarrow. A task holds one row
group at a time. Files are written to a hidden folder beside the target, which
becomes the table by one rename when the whole job commits; what a task that
ran twice left there is dropped first. A target that holds anything is refused
unless it is to be replaced; then it steps aside until the new table is in its
place, and comes back if that fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from terrafold.sources.filesystem import resolve

FORMAT = "terrafold_geoparquet"


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


class GeoParquetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite):
        return GeoParquetWriter(self.options, schema)


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, options, schema):
        self.path = options["path"].rstrip("/")
        self.replace = options.get("replace", "false") == "true"
        self.rows_per_group = int(options["rows_per_group"])
        self.geo = options["geo"]
        self.schema = schema
        above, _, name = self.path.rpartition("/")
        self.staging = f"{above}/_staging-{uuid.uuid4().hex}-{name}"

    def _arrow_schema(self) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(self.schema).with_metadata({"geo": self.geo})

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        schema = self._arrow_schema()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.parquet"
        out, held, rows, total = None, [], 0, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    out = self._open(name, schema)
                held.append(pa.Table.from_batches([batch]).cast(schema))
                rows += batch.num_rows
                total += batch.num_rows
                if rows >= self.rows_per_group:
                    full = pa.concat_tables(held)
                    cut = rows // self.rows_per_group * self.rows_per_group
                    out.write_table(full.slice(0, cut), row_group_size=self.rows_per_group)
                    held, rows = [full.slice(cut)], rows - cut
            if out is not None and rows:
                out.write_table(pa.concat_tables(held), row_group_size=self.rows_per_group)
        finally:
            if out is not None:
                out.close()
        return Written(name if total else None, total)

    def _open(self, name: str, schema: pa.Schema) -> pq.ParquetWriter:
        system, folder = resolve(self.staging)
        system.create_dir(folder, recursive=True)
        return pq.ParquetWriter(f"{folder}/{name}", schema, filesystem=system,
                                compression="zstd")

    def commit(self, messages) -> None:
        system, staging = resolve(self.staging)
        names = {m.name for m in messages if m is not None and m.name}
        if not names:
            # A table without rows is still a table: one file with the schema.
            names = {"part-000000-empty.parquet"}
            self._open(*names, self._arrow_schema()).close()
        for left in system.get_file_info(fs.FileSelector(staging)):
            if left.base_name not in names:
                system.delete_file(left.path)
        with system.open_output_stream(f"{staging}/_SUCCESS"):
            pass
        publish(system, staging, resolve(self.path)[1], self.replace)

    def abort(self, messages) -> None:
        system, staging = resolve(self.staging)
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


def publish(system: fs.FileSystem, staging: str, target: str, replace: bool) -> None:
    """Make the folder ``staging`` the table at ``target``."""
    aside = None
    if system.get_file_info(target).type != fs.FileType.NotFound:
        if not replace and not is_vacant(system, target):
            raise FileExistsError(f"{target} holds files and is not to be replaced")
        aside = f"{staging}-aside"
        system.move(target, aside)
    try:
        system.move(staging, target)
    except Exception:
        if aside is not None:
            system.move(aside, target)
        raise
    if aside is not None:
        system.delete_dir(aside)


def is_vacant(system: fs.FileSystem, path: str) -> bool:
    """Whether nothing, or an empty folder, is at ``path``."""
    kind = system.get_file_info(path).type
    return kind == fs.FileType.NotFound or (
        kind == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(path)))


def write(df: DataFrame, path: str, geo: str, rows_per_group: int, replace: bool = False) -> None:
    """Write the partitions of ``df`` in order, one file each, as the table at ``path``."""
    path = path.rstrip("/")
    if not replace and not is_vacant(*resolve(path)):
        raise FileExistsError(f"{path} holds files and is not to be replaced")
    df.sparkSession.dataSource.register(GeoParquetSource)
    (df.write.format(FORMAT).mode("append").option("rows_per_group", str(rows_per_group))
     .option("geo", geo).option("replace", str(replace).lower()).save(path))
