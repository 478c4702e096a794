"""Members of tar archives as a table, without extraction: a data source that walks headers by ranged reads.

    spark.dataSource.register(TarMembers)
    spark.read.format("tar_members").load("/data/shards")

archive, member (its name), basename, size, offset (of its bytes in the archive). An archive is a partition. Payloads are
skipped by seeking; filters on basename and member are pushed down, so only rows that pass leave the reader. Broken archives
give the members before the break.
"""

from __future__ import annotations

import posixpath
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "archive string, member string, basename string, size long, offset long"


def members(file) -> Iterator[tuple[str, int, int]]:
    """(name, size, offset) of the regular files of an uncompressed archive that is read at random places."""
    try:
        with tarfile.open(fileobj=file, mode="r:") as archive:
            while (m := archive.next()) is not None:
                archive.members = []  # the walk keeps nothing
                if m.isfile():
                    yield m.name, m.size, m.offset_data
    except (tarfile.TarError, EOFError):
        return


class Archive(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.wanted = path, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership on names are applied to headers; others stay with Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in ("basename", "member"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, root = self._files()
        found = files.get_file_info(fs.FileSelector(root, recursive=True)) if files.get_file_info(root).type == fs.FileType.Directory else [files.get_file_info(root)]
        return [Archive(p) for p in sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".tar"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        files, _ = self._files()
        with files.open_input_file(partition.value) as file:
            for name, size, offset in members(file):
                base = posixpath.basename(name)
                if base in self.wanted.get("basename", {base}) and name in self.wanted.get("member", {name}):
                    yield partition.value, name, base, size, offset


class TarMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarMembers)
    return spark.read.format("tar_members").load(path)


def located(wanted: DataFrame, found: DataFrame, expected: str = "expected") -> DataFrame:
    """wanted with archive, member, offset and size of its expected name: in the first archive that has it, a member of
    exactly that name before one in a folder, then the first. Null where none has."""
    named = found.withColumn("_exact", F.col("member") == F.col("basename"))
    w = W.partitionBy("basename").orderBy("archive", F.col("_exact").desc(), "offset")
    first = named.withColumn("_k", F.row_number().over(w)).filter("_k = 1").select(F.col("basename").alias(expected), "archive", "member", "offset", "size")
    return wanted.join(first, expected, "left")


def write_tars(df: DataFrame, path: str, name: str, content: str, archives: int) -> None:
    """Rows as members of so many archives (a row goes where the digest of its name says), in order of names. Members stream
    into their archive; a task that runs again writes the same file again."""

    def write(batches):
        import io

        import pyarrow as pa
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        files.create_dir(root, recursive=True)
        at, n, out, archive = None, 0, None, None
        for b in batches:
            for k, member, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if k != at:
                    if archive:
                        archive.close(), out.close()
                    out = files.open_output_stream(f"{root}/shard-{k:05d}.tar")
                    at, archive = k, tarfile.open(fileobj=out, mode="w|")
                info = tarfile.TarInfo(member)
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))
                n += 1
        if archive:
            archive.close(), out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    keyed = df.select(F.pmod(F.crc32(F.col(name)), F.lit(archives)).cast("int").alias("_k"), name, F.encode(F.coalesce(content, F.lit("")), "UTF-8").alias(content))
    keyed.repartition("_k").sortWithinPartitions("_k", name).mapInArrow(write, "n long").agg(F.sum("n")).first()
