"""Tables as plain Spark Parquet folders.

A full overwrite goes to a new version folder, because a Parquet path cannot be
overwritten while it is read; readers take the last version with a ``_SUCCESS``
marker. Within a version, partitions are replaced with Spark's dynamic partition
overwrite from a staged copy, so that an interrupted replacement can be repeated.
The schema is kept beside the data: reads then open no footers to merge schemas,
and columns that old files lack come back as NULL.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakemart.operators.contract import ContractViolation, compare_fields, field_types, retype
from lakemart.plans.lineage import delete


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    def _path(self, location: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(location)

    def _fs(self, location: str):
        return self._path(location).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write_json(self, location: str, content: dict) -> None:
        out = self._fs(location).create(self._path(location), True)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()

    def _read_json(self, location: str) -> dict | None:
        if not self._fs(location).exists(self._path(location)):
            return None
        return json.loads(self.spark.read.text(location, wholetext=True).first()[0])

    def _versions(self, table: str) -> list[int]:
        found = self._fs(self.root).globStatus(self._path(f"{self.root}/{table}/v=*/_SUCCESS"))
        names = [f.getPath().getParent().getName() for f in (found or [])]
        return sorted(int(name.removeprefix("v=")) for name in names)

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def location(self, table: str) -> str:
        versions = self._versions(table)
        if not versions:
            raise FileNotFoundError(f"table {table} does not exist under {self.root}")
        return f"{self.root}/{table}/v={versions[-1]}"

    def schema(self, table: str) -> StructType:
        version = self.location(table).rsplit("/", 1)[1]
        return StructType.fromJson(self._read_json(f"{self.root}/{table}/schema-{version}.json"))

    def read(self, table: str) -> DataFrame:
        """The published rows. Readers never write: an interrupted replacement waits for ``recover``."""
        return self.spark.read.schema(self.schema(table)).parquet(self.location(table))

    def read_or_none(self, table: str) -> DataFrame | None:
        """None only when the table does not exist; other errors propagate."""
        return self.read(table) if self.exists(table) else None

    def overwrite(self, df: DataFrame, table: str, partition_by=(), check=None) -> None:
        """Write a new version; readers see it once ``check`` on it has passed."""
        versions = self._versions(table)
        version = f"v={versions[-1] + 1 if versions else 1}"
        target = f"{self.root}/{table}/{version}"
        self._write_json(f"{self.root}/{table}/schema-{version}.json", df.schema.jsonValue())
        (
            gathered(df, partition_by)
            .write.mode("overwrite")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            .partitionBy(*partition_by)
            .parquet(target)
        )
        if check is not None:
            check(self.spark.read.schema(df.schema).parquet(target))
        self._publish(target)
        self.drop_old_versions(table)

    def _publish(self, target: str) -> None:
        self._fs(target).create(self._path(f"{target}/_SUCCESS"), True).close()

    def drop_old_versions(self, table: str, keep: int = 2) -> None:
        """Remove versions no reader of the last ``keep`` can need."""
        for version in self._versions(table)[:-keep]:
            delete(self.spark, f"{self.root}/{table}/v={version}")
            delete(self.spark, f"{self.root}/{table}/schema-v={version}.json")

    def append(self, df: DataFrame, table: str, allow_break: bool = False) -> None:
        """Append; columns the table lacks are added to its schema.

        Files of one table have one type per column. A batch with another type raises;
        with ``allow_break`` the stored rows are cast to it, none of them losing a value,
        and written anew together with the batch.
        """
        if not self.exists(table):
            return self.overwrite(df, table)
        diff = compare_fields(field_types(self.schema(table)), field_types(df.schema))
        retyped = [name for name, kind, _, _ in diff if kind == "retyped"]
        if retyped and not allow_break:
            raise ContractViolation(f"{table}: an append cannot retype {', '.join(retyped)}")
        if retyped:
            stored = retype(self.read(table), df.schema, table)
            return self.overwrite(stored.unionByName(df, allowMissingColumns=True), table)
        self._add_columns(table, df.schema)
        df.write.mode("append").parquet(self.location(table))

    def put_batch(self, df: DataFrame, table: str, column: str, batch_id: int) -> None:
        """Append one numbered batch; repeating a batch replaces it."""
        location = self.location(table) if self.exists(table) else f"{self.root}/{table}/v=1"
        df.write.mode("overwrite").parquet(f"{location}/{column}={batch_id}")
        if self.exists(table):
            self._add_columns(table, df.schema)
        else:
            schema = StructType([*df.schema.fields, StructField(column, LongType())])
            self._write_json(f"{self.root}/{table}/schema-v=1.json", schema.jsonValue())
            self._publish(location)

    def replace_partitions(self, df: DataFrame, table: str, partition_by, touched) -> None:
        """Give the ``touched`` partitions the content of ``df``.

        ``touched`` lists the old (partition values, ``_folder``) rows; a folder
        whose partition is absent from ``df`` is removed.
        """
        # Inside the table's folder: what recovery needs must live as long as the table.
        staged = f"{self.root}/{table}/stage-{uuid.uuid4().hex}"
        gathered(df, partition_by).write.partitionBy(*partition_by).parquet(staged)
        written = self._folders(staged, len(partition_by))
        emptied = [
            r["_folder"]
            for r in touched
            if self._from_uri(r["_folder"]).toString().split("/")[-len(partition_by) :] not in written
        ]
        intent = {"staged": staged, "by": list(partition_by), "emptied": emptied}
        self._write_json(
            f"{self.root}/{table}/replacing.json", intent | {"schema": df.schema.jsonValue()}
        )
        self.recover(table)

    def _from_uri(self, encoded: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(encoded))

    def _folders(self, location: str, depth: int) -> list[list[str]]:
        """Names of the partition folders below a location, level by level."""
        found = self._fs(location).globStatus(self._path(location + "/*=*" * depth))
        return [f.getPath().toString().split("/")[-depth:] for f in (found or [])]

    def recover(self, table: str) -> None:
        """Finish a replacement that was interrupted; for the one writer of the table.

        Staged folders hold whole partitions, written once: each takes the place of the one
        of its name. One that is no longer there has been moved already.
        """
        marker = f"{self.root}/{table}/replacing.json"
        intent = self._read_json(marker)
        if intent is None:
            return
        self._add_columns(table, StructType.fromJson(intent["schema"]))
        fs, location = self._fs(self.root), self.location(table)
        for names in self._folders(intent["staged"], len(intent["by"])):
            source, target = (self._path("/".join([base, *names])) for base in (intent["staged"], location))
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
        for folder in intent["emptied"]:
            fs.delete(self._from_uri(folder), True)
        delete(self.spark, marker)
        delete(self.spark, intent["staged"])

    def _add_columns(self, table: str, incoming: StructType) -> None:
        known = self.schema(table)
        added = [f for f in incoming.fields if f.name not in known.fieldNames()]
        if added:
            version = self.location(table).rsplit("/", 1)[1]
            merged = StructType(known.fields + added)
            self._write_json(f"{self.root}/{table}/schema-{version}.json", merged.jsonValue())


def gathered(df: DataFrame, partition_by) -> DataFrame:
    """Bring the rows of a table partition together before a partitioned write.

    ``rebalance`` lets adaptive execution split a partition that holds most rows,
    so one hot month does not become one task, and small months stay in few files.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def with_folder(df: DataFrame) -> DataFrame:
    """Add ``_folder``, the folder of the file each row was read from."""
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("_folder"))
