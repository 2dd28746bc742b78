"""A data source over landed Parquet listings that takes filters to the files.

``spark.read.format("listings").option("path", ...)``: equality and membership tests on
columns are handed to the Parquet reader, so row groups without a hit are not read; the rest
of a filter stays with Spark.  Each file is read by its own task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class ListingReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        self.names, self.path, self.taken = schema.fieldNames(), path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1:
                self.taken.append((f.attribute[0], "=", f.value))
            elif isinstance(f, In) and len(f.attribute) == 1:
                self.taken.append((f.attribute[0], "in", list(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        info = system.get_file_info(root)
        if info.is_file:
            return [_File(self.path)]
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        prefix = self.path[: len(self.path) - len(root)] if "://" in self.path else ""
        return [_File(prefix + f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.endswith(".parquet")]

    def read(self, partition: _File) -> Iterator:
        import pyarrow.dataset as ds
        import pyarrow.compute as pc

        test = None
        for name, op, value in self.taken:
            one = pc.field(name) == value if op == "=" else pc.field(name).isin(value)
            test = one if test is None else test & one
        yield from ds.dataset(partition.path, format="parquet").scanner(columns=self.names, filter=test).to_batches()


class Listings(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listings"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ListingReader(schema, self.options["path"])
