"""Versioned tables with idempotent upserts on plain Parquet.

The records of a table are spread over parts by hash of their key, each part a folder of its own; a state file for each
version names the folders. An upsert reads and writes only the parts that its keys fall into and then makes the next state
file, if no other writer made it before, so that readers see the old or the new state, a lost executor or a failed job leaves
the old one, and of two writers one fails. The number of parts grows with the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.session import remove, work_path

#: Records of a part, on the mean, beyond which all parts are split; least parts; versions kept for readers that have begun.
PART_RECORDS, LEAST_PARTS, VERSIONS = 1_000_000, 8, 3

_TYPES = {"TEXT": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "JSONB": T.StringType()}


def table_schema(columns: dict[str, str]) -> T.StructType:
    """Schema of declared columns: ``TEXT``, ``DATE``, ``TIMESTAMP``, ``JSONB``, each with ``NOT NULL`` or a default behind it."""
    fields = []
    for name, kind in columns.items():
        words = kind.upper().split()
        if words[0] not in _TYPES:
            raise ValueError(f"type not supported: {kind}")
        fields.append(T.StructField(name, _TYPES[words[0]], "NOT NULL" not in kind.upper()))
    return T.StructType(fields)


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first record of each key in the given order; records with a NULL or empty key are left out."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def upserted(target: DataFrame, batch: DataFrame, key: str, keep: Sequence[str] = (), defaults: dict[str, Column] | None = None) -> DataFrame:
    """``target`` after an upsert of ``batch`` by ``key``.

    A record of the batch replaces the stored one in every column it has, NULLs too; columns in ``keep`` stay as stored where
    the record was there before and get their default where it is new.
    """
    defaults = defaults or {}
    b = batch.select(F.col(key).alias("__k"), F.struct(*[F.col(c) for c in batch.columns]).alias("__b"))
    t = target.select(F.col(key).alias("__tk"), F.struct(*[F.col(c) for c in target.columns]).alias("__t"))
    joined = t.join(b, F.col("__tk") == F.col("__k"), "full")
    new, old = F.col("__b").isNotNull(), F.col("__t").isNotNull()
    out = []
    for c in target.columns:
        stored = F.col(f"__t.`{c}`")
        if c in keep or c not in batch.columns:
            out.append(F.when(old, stored).otherwise(defaults.get(c, F.lit(None))).cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.when(new, F.col(f"__b.`{c}`")).otherwise(stored).cast(target.schema[c].dataType).alias(c))
    return joined.select(*out)


class DuplicateKey(ValueError):
    """A batch holds a primary key twice."""


class ConcurrentCommit(RuntimeError):
    """Another writer committed a version since this one began; nothing of this one is kept."""


class SnapshotTable:
    """A table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, columns: dict[str, str], key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.columns, self.schema = columns, table_schema(columns)

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path
        return at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[int]:
        fs, at = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(at(self.path))] if fs.exists(at(self.path)) else []
        return sorted(int(n.removeprefix("_state-")) for n in names if n.startswith("_state-"))

    def _state(self, version: int) -> dict:
        fs, at = self._fs()
        stream = fs.open(at(f"{self.path}/_state-{version:012d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> dict:
        """``version`` (-1 before the first), number of ``parts``, ``folders`` and ``records`` by part."""
        versions = self._versions()
        return self._state(versions[-1]) if versions else {"version": -1, "parts": LEAST_PARTS, "folders": {}, "records": {}}

    def _part(self, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(parts)).cast("int")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """The current state; an empty table before the first commit."""
        return self._rows(list(self.state()["folders"].values()))

    def create(self) -> None:
        """An empty first version, unless there is one."""
        state = self.state()
        if state["version"] < 0:
            self._commit(state | {"version": 0})

    def _commit(self, state: dict) -> None:
        fs, at = self._fs()
        try:
            out = fs.create(at(f"{self.path}/_state-{state['version']:012d}"), False)
        except Exception as e:
            if fs.exists(at(f"{self.path}/_state-{state['version']:012d}")):
                raise ConcurrentCommit(f"{self.path}: version {state['version']} is another writer's") from e
            raise
        out.write(bytearray(json.dumps(state).encode()))
        out.close()

    def _write(self, rows: DataFrame, version: int, parts: int) -> tuple[dict[str, str], dict[str, int]]:
        """Folders and numbers of records of the parts that ``rows`` fall into."""
        folder = f"data-{version:012d}-{uuid.uuid4().hex[:8]}"
        rows.withColumn("__part", self._part(parts)).repartition(parts, "__part").write.partitionBy("__part").parquet(f"{self.path}/{folder}")
        written = self.spark.read.parquet(f"{self.path}/{folder}").groupBy("__part").count().collect()
        return {str(r["__part"]): f"{folder}/__part={r['__part']}" for r in written}, {str(r["__part"]): r["count"] for r in written}

    def upsert(self, batch: DataFrame, keep: Sequence[str] = (), defaults: dict[str, Column] | None = None, order: Sequence[str] | None = None) -> bool:
        """Upserts a batch; False if it holds no record, and nothing was written.

        With ``order`` the first record of each key counts. Without it a key that comes twice is an error. The batch is
        evaluated once. Raises :class:`ConcurrentCommit` if another writer was faster.
        """
        state = self.state()
        chosen = batch if order is None else first_per_key(batch, self.key, order)
        at = work_path(self.spark, "upsert")
        chosen.select(*[c for c in batch.columns if c in self.columns]).write.parquet(at)
        chosen = self.spark.read.parquet(at)
        try:
            return self._upsert(chosen, state, keep, defaults, order is None)
        finally:
            remove(self.spark, at)

    def _upsert(self, batch: DataFrame, state: dict, keep: Sequence[str], defaults: dict[str, Column] | None, check: bool) -> bool:
        parts = state["parts"]
        fallen = {str(r["p"]): r["count"] for r in batch.groupBy(self._part(parts).alias("p")).count().collect()}
        if not fallen:
            return False
        if check and not batch.groupBy(self.key).count().where("count > 1").isEmpty():
            raise DuplicateKey(f"a batch for {self.path} holds a {self.key} twice")
        records = sum(state["records"].values()) + sum(fallen.values())
        split = records > 2 * PART_RECORDS * parts
        if split:
            while parts * PART_RECORDS < records:
                parts *= 2
        touched = list(state["folders"]) if split else [p for p in fallen if p in state["folders"]]
        before = self._rows([state["folders"][p] for p in touched])
        version = state["version"] + 1
        folders, counts = self._write(upserted(before, batch, self.key, keep, defaults), version, parts)
        if not split:
            folders, counts = state["folders"] | folders, state["records"] | counts
        self._commit({"version": version, "parts": parts, "folders": folders, "records": counts})
        self.vacuum()
        return True

    def vacuum(self, versions: int = VERSIONS) -> None:
        """Removes the state files of all but the last ``versions`` and the folders of earlier ones that these do not name."""
        fs, at = self._fs()
        known = self._versions()
        kept = known[-versions:]
        named = {f.split("/")[0] for v in kept for f in self._state(v)["folders"].values()}
        for v in known[:-versions]:
            fs.delete(at(f"{self.path}/_state-{v:012d}"), False)
        for s in fs.listStatus(at(self.path)):
            name = s.getPath().getName()
            # Folders of versions to come belong to writers at work.
            if name.startswith("data-") and name not in named and int(name.split("-")[1]) < kept[0]:
                fs.delete(s.getPath(), True)
