"""A Spark data source that serves the dimension version current at read time.

A Parquet frame in a stream-static join keeps the file listing it was planned
with. This source resolves the version inside ``read``, which runs anew for
every micro-batch, so a device added while a stream runs is found by the next
batch. The module is shipped to workers by value and imports nothing of ours.
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "tidemark_dimension"


def _filesystem(path):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def current_version(path):
    """(filesystem, root, version) of the newest committed version, or None as version."""
    from pyarrow import fs

    files, root = _filesystem(path)
    selector = fs.FileSelector(f"{root}/commits", recursive=True, allow_not_found=True)
    versions = [
        int(info.path.rsplit("/", 2)[1].split("=", 1)[1])
        for info in files.get_file_info(selector)
        if info.type == fs.FileType.File
        and info.base_name.startswith("part-")
        and info.path.rsplit("/", 2)[1].startswith("version=")
    ]
    return files, root, max(versions, default=None)


class DimensionReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.slices = int(options["slices"])
        self.limit = int(options["max_rows"]) if "max_rows" in options else None

    def partitions(self):
        return [InputPartition(i) for i in range(self.slices)]

    def read(self, partition):
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root, version = current_version(self.path)
        if version is None:
            return
        if self.limit is not None:
            rows = 0
            for info in files.get_file_info(fs.FileSelector(f"{root}/commits/version={version}")):
                if info.base_name.startswith("part-"):
                    rows += sum(pq.read_table(info.path, filesystem=files)["row_count"].to_pylist())
            if rows > self.limit:
                raise RuntimeError(
                    f"the dimension has {rows} rows, over the {self.limit} it may be broadcast with; "
                    "restart the stream with broadcast=False"
                )
        # Every version is hashed into the same slices, so slice i always holds the same devices
        # and two slices read a moment apart cannot show one device twice or not at all.
        prefix = f"part-{partition.value:05d}-"
        for info in files.get_file_info(fs.FileSelector(f"{root}/versions/version={version}")):
            if info.base_name.startswith(prefix):
                with files.open_input_file(info.path) as source:
                    yield from pq.ParquetFile(source).iter_batches()


class DimensionSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return (
            "device_id STRING, temp_threshold DOUBLE, location_id STRING, model STRING, status STRING"
        )

    def reader(self, schema):
        return DimensionReader(self.options)
