"""Statistics of a table's partitions that are kept beside it.

A companion holds what ``build`` makes of the rows of each partition folder, together with the
names of the files it saw there. Every write of a partition gives its files new names, so a
folder whose names are the same has not changed and is not read again. The names come from
the file index that Spark has of any table it reads: no data is opened to compare them.

Rows of a folder are one directory of the companion, written before the list that names it is
published as a new version of a small table. A crash between a write of the table and that of
its companion leaves old names in the list, so the folder is read by the next refresh; one
in the middle of a refresh leaves directories that no list names, which the repetition replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.plans.lineage import delete
from lakemart.plans.store import TableStore

#: The partition folder of a row, relative to the table; empty for tables without partitions.
FOLDER = "stat_folder"
_PART = "stat_part"


@dataclass(frozen=True)
class Companion:
    """``build`` maps rows of some folders, with ``FOLDER``, to rows with ``FOLDER``.

    ``version`` names what ``build`` does: another one makes all folders new.
    """

    store: TableStore
    table: str
    name: str
    build: Callable[[DataFrame], DataFrame]
    version: str = "1"

    @property
    def _list(self) -> str:
        return f"{self.table}__{self.name}"

    @property
    def _data(self) -> str:
        return f"{self.store.root}/{self._list}-parts"

    def parts(self) -> dict[str, str]:
        """The directory that holds what is true of each folder's present files."""
        version = self.store.location(self.table).rsplit("/", 1)[1]
        names: dict[str, list[str]] = {}
        for path in self.store.read(self.table).inputFiles():
            folder, name = path.split(f"/{self.table}/{version}/", 1)[1].rpartition("/")[::2]
            names.setdefault(folder, []).append(name)
        return {
            folder: hashlib.sha256("\n".join([self.version, folder, *sorted(files)]).encode()).hexdigest()[:24]
            for folder, files in names.items()
        }

    def known(self) -> dict[str, str]:
        listed = self.store.read_or_none(self._list)
        return {} if listed is None else {row[FOLDER]: row[_PART] for row in listed.collect()}

    def rows_of(self, folders: list[str]) -> DataFrame:
        """The table's rows of some folders, no other file is opened; with ``FOLDER``."""
        store, location = self.store, self.store.location(self.table)
        jvm = store.spark._jvm
        base = store._path(location)
        paths = [
            # Names of folders are encoded in paths as Spark shows them.
            jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f"{base.toUri().toString()}/{folder}")).toString() if folder else location
            for folder in folders
        ]
        schema = store.schema(self.table)
        if not paths:
            rows = store.spark.createDataFrame([], schema)
            return rows.withColumn(FOLDER, F.lit(""))
        rows = store.spark.read.schema(schema).option("basePath", location).parquet(*paths)
        version = location.rsplit("/", 1)[1]
        inside = F.substring_index(F.col("_metadata.file_path"), f"/{self.table}/{version}/", -1)
        return rows.withColumn(FOLDER, F.regexp_replace(inside, "/?[^/]*$", ""))

    def refresh(self) -> DataFrame:
        """The companion of the table as it is now; reads only folders that have changed."""
        now, known = self.parts(), self.known()
        changed = sorted(folder for folder, part in now.items() if known.get(folder) != part)
        if changed or set(known) - set(now):
            self._write(now, known, changed)
        return self.read()

    def changed_folders(self) -> list[str]:
        """Folders that a refresh would read."""
        known = self.known()
        return sorted(folder for folder, part in self.parts().items() if known.get(folder) != part)

    def _write(self, now: dict[str, str], known: dict[str, str], changed: list[str]) -> None:
        spark = self.store.spark
        if changed:
            parts = spark.createDataFrame([(f, now[f]) for f in changed], f"{FOLDER} string, {_PART} string")
            built = self.build(self.rows_of(changed)).join(F.broadcast(parts), FOLDER)
            self.store._write_json(f"{self.store.root}/{self._list}-schema-{self.version}.json", built.drop(_PART).schema.jsonValue())
            (
                built.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(_PART)
                .parquet(self._data)
            )
        listed = spark.createDataFrame(sorted(now.items()), f"{FOLDER} string, {_PART} string")
        self.store.overwrite(listed, self._list)
        for folder, part in known.items():
            if now.get(folder) != part:
                delete(spark, f"{self._data}/{_PART}={part}")

    def read(self) -> DataFrame:
        """What the last refresh has left."""
        kind = self.store._read_json(f"{self.store.root}/{self._list}-schema-{self.version}.json")
        if kind is None:
            # A table that never had a file.
            return self.build(self.rows_of([]))
        written = StructType.fromJson(kind)
        rows = self.store.spark.read.schema(written.add(_PART, "string")).parquet(self._data)
        return rows.where(F.col(_PART).isin(sorted(self.known().values()))).drop(_PART)
