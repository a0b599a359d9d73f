"""Tables that are replaced, updated and widened without ever being half there (B12, B3, ALTER).

A table folder holds immutable data folders, one manifest per version and one
pointer file that names the current manifest:

    _current                 the name of a manifest
    _manifests/000002.json   schema, partition columns, and the folder of every partition
    _data/v000001-.../...    Parquet files, partitioned as declared

Every change writes new files first, then a manifest, and switches the pointer
last, by a rename that replaces.  A write that fails or is killed leaves the
pointer, and so all readers, at the old version; a reader that has resolved the
pointer keeps its files until ``drop_old``.  A table may therefore be replaced by
a query over itself.  Of two changes made at the same time the second to switch
is refused, because its manifest's number is taken.

``merge`` is UPDATE ... FROM by copy on write: only partitions that hold a match
are read and written again, all others keep their files.  ``alter_type`` widens a
column in the manifest alone; files of the narrower type are widened when read.

All file operations go through Hadoop's file system interface, so a table can
lie in any store that Spark reads.  Lists of partitions pass the driver; rows
never do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StructField, StructType

#: The width of the integral types, and the digits a DECIMAL needs to hold each.
_INTEGRAL = {"tinyint": (1, 3), "smallint": (2, 5), "int": (4, 10), "bigint": (8, 19)}


class SnapshotTable:
    """A versioned Parquet table in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # --- files ---------------------------------------------------------------

    @property
    def _jvm(self):
        return self.spark.sparkContext._jvm

    def _hadoop(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _fs(self):
        return self._hadoop().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _text(self, *names: str) -> str | None:
        fs, path = self._fs(), self._hadoop(*names)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, text: str, *names: str, replace: bool = False) -> None:
        stream = self._fs().create(self._hadoop(*names), replace)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _children(self, *names: str) -> list[str]:
        fs, path = self._fs(), self._hadoop(*names)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _partitions(self, folder: str, depth: int) -> list[str]:
        """The partition folders below a data folder, as ``a=1/b=2``; without partitions one empty name."""
        names = [""]
        for _ in range(depth):
            names = [f"{n}/{c}".lstrip("/") for n in names
                     for c in self._children("_data", folder, *([n] if n else [])) if "=" in c]
        return names

    # --- manifests -----------------------------------------------------------

    def version(self) -> int | None:
        """The number of the current version; None if there is none."""
        name = self._text("_current")
        return None if name is None else int(name.split(".")[0])

    def manifest(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        text = None if number is None else self._text("_manifests", f"{number:06d}.json")
        if text is None:
            raise ValueError(f"{self.path} has no version {'' if version is None else version}".rstrip())
        return json.loads(text)

    def _switch(self, base: int | None, schema: StructType, partition_by: Sequence[str], parts: dict[str, str]) -> int:
        number = (base or 0) + 1
        name = f"{number:06d}.json"
        manifest = {"schema": schema.jsonValue(), "partition_by": list(partition_by), "parts": parts}
        # an abandoned change may have left a manifest of this number that was never pointed to
        if self.version() != base:
            raise RuntimeError(f"{self.path} was changed at the same time")
        self._put(json.dumps(manifest), "_manifests", name, replace=True)
        pointer = f"_current.{uuid.uuid4().hex}"
        self._put(name, pointer)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(self._hadoop(pointer), self._hadoop("_current"), options)
        return number

    def _write(self, df: DataFrame, number: int, partition_by: Sequence[str], deal: bool = True) -> tuple[str, list[str]]:
        folder = f"v{number:06d}-{uuid.uuid4().hex[:12]}"
        if partition_by and deal:  # AQE sizes the files, and splits a partition that holds most rows
            df = df.hint("rebalance", *partition_by)
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/_data/{folder}")
        return folder, self._partitions(folder, len(partition_by))

    # --- reading -------------------------------------------------------------

    def exists(self) -> bool:
        return self.version() is not None

    def schema(self) -> StructType:
        return StructType.fromJson(self.manifest()["schema"])

    def read(self, version: int | None = None, partitions: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version (the current one), or of some of its partitions, by folder name."""
        manifest = self.manifest(version)
        schema = StructType.fromJson(manifest["schema"])
        wanted = manifest["parts"] if partitions is None else {p: manifest["parts"][p] for p in partitions
                                                              if p in manifest["parts"]}
        folders: dict[str, list[str]] = {}
        for part, folder in wanted.items():
            folders.setdefault(folder, []).append(part)
        found = None
        for folder, parts in folders.items():
            base = f"{self.path}/_data/{folder}"
            rows = (self.spark.read.schema(schema).option("basePath", base)
                    .parquet(*[f"{base}/{p}".rstrip("/") for p in parts]).select(*[f"`{c}`" for c in schema.names]))
            found = rows if found is None else found.unionByName(rows)
        return self.spark.createDataFrame([], schema) if found is None else found

    # --- changes -------------------------------------------------------------

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), deal: bool = True) -> int:
        """TRUNCATE + INSERT: the rows of ``df``, which may read this table, become the table.

        Rows are dealt out by partition first, a shuffle.  Without ``deal`` each
        task writes what it has, a file for each partition it has rows of.
        """
        base = self.version()
        folder, parts = self._write(df, (base or 0) + 1, partition_by, deal)
        return self._switch(base, df.schema, partition_by, {p: folder for p in parts})

    def rewrite(self, df: DataFrame, partitions: Iterable[str], base: int | None = None, deal: bool = True) -> int:
        """``df`` becomes the content of the named partitions; all others keep their files.

        ``base`` is the version that ``df`` was made from, if it is not to be
        the current one of now; ``deal`` is as in ``replace``.
        """
        base = self.version() if base is None else base
        manifest = self.manifest(base)
        schema, by = StructType.fromJson(manifest["schema"]), manifest["partition_by"]
        doomed = set(partitions)
        folder, written = self._write(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]),
                                      base + 1, by, deal)
        strange = set(written) - doomed
        if strange:
            raise ValueError(f"rows of other partitions: {sorted(strange)[:5]}")
        parts = {p: f for p, f in manifest["parts"].items() if p not in doomed} | {p: folder for p in written}
        return self._switch(base, schema, by, parts)

    def partition_names(self, rows: DataFrame) -> list[str]:
        """The folder names of the partitions that ``rows`` fall into."""
        by = self.manifest()["partition_by"]
        if not by:
            return [""]
        naming = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        values = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in by]).distinct().collect()
        return ["/".join(naming.getPartitionPathString(c, v) for c, v in zip(by, row)) for row in values]

    def merge(self, changes: DataFrame, keys: Sequence[str], insert: bool = False) -> list[str]:
        """UPDATE ... FROM: the other columns of ``changes`` are set in the rows with equal ``keys``.

        With ``insert``, change rows without a match become rows (NULL in the
        columns they lack).  Returns the partitions that were written again.  A
        key may stand once in ``changes``, else it is refused; NULL keys match
        nothing.  The changes are computed once and kept in a file until the end.
        """
        held_at = f"changes-{uuid.uuid4().hex}"  # beside the data, so that ``drop_old`` takes what a killed merge left
        stored = f"{self.path}/_data/{held_at}"
        try:
            changes.write.parquet(stored)
            return self._merge(self.spark.read.schema(changes.schema).parquet(stored), keys, insert)
        finally:
            self._fs().delete(self._hadoop("_data", held_at), True)

    def _merge(self, changes: DataFrame, keys: Sequence[str], insert: bool) -> list[str]:
        base = self.version()
        manifest = self.manifest(base)
        by, schema = manifest["partition_by"], StructType.fromJson(manifest["schema"])
        keys = list(keys)
        sets = [c for c in changes.columns if c not in keys]
        moved = set(by) & set(sets)
        if moved or set(sets) - set(schema.names):
            raise ValueError(f"columns that cannot be set: {sorted(moved | (set(sets) - set(schema.names)))}")
        if changes.dropna(subset=keys).groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError("a key stands more than once in the changes")
        if set(by) <= set(keys):
            touched = self.partition_names(changes.dropna(subset=keys))
        elif insert:
            raise ValueError("an insert needs the partition columns among the keys")
        else:
            touched = self.partition_names(self.read(base).join(changes.select(*keys), keys, "left_semi"))
        held = [p for p in touched if p in manifest["parts"]]
        old = self.read(base, held)
        values = changes.select(*keys, F.struct(F.lit(1).alias("one"), *[f"`{c}`" for c in sets]).alias("_new"))
        done = old.join(values, keys, "left").select(*[
            self._set(f, f.name in sets).alias(f.name) for f in schema])
        if insert:
            fresh = changes.dropna(subset=keys).join(old.select(*keys), keys, "left_anti")
            done = done.unionByName(fresh.select(*[
                (F.col(f"`{f.name}`") if f.name in changes.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema]))
            held = touched
        if held:
            self.rewrite(done, held, base)
        return sorted(held)

    @staticmethod
    def _set(field: StructField, is_set: bool) -> Column:
        old = F.col(f"`{field.name}`")
        if not is_set:
            return old
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.`{field.name}`").cast(field.dataType)).otherwise(old)

    def alter_type(self, column: str, to: str) -> int:
        """ALTER COLUMN TYPE to a type that holds every value of the old one; no file is written again."""
        base = self.version()
        manifest = self.manifest(base)
        fields = []
        for f in StructType.fromJson(manifest["schema"]):
            if f.name == column:
                new = StructType.fromDDL(f"x {to}")["x"].dataType
                if column in manifest["partition_by"] or not widens(f.dataType, new):
                    raise ValueError(f"{column} cannot become {to} without loss")
                f = StructField(f.name, new, f.nullable)
            fields.append(f)
        schema = StructType(fields)
        if column not in schema.names:
            raise ValueError(f"no column {column}")
        return self._switch(base, schema, manifest["partition_by"], manifest["parts"])

    def drop_old(self) -> list[str]:
        """Delete what the current version does not use; only this ends an old version."""
        number = self.version()
        live = set(self.manifest(number)["parts"].values())
        fs = self._fs()
        gone = [f for f in self._children("_data") if f not in live]
        for folder in gone:
            fs.delete(self._hadoop("_data", folder), True)
        for name in self._children("_manifests"):
            if name != f"{number:06d}.json":
                fs.delete(self._hadoop("_manifests", name), False)
        return gone


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``, exactly."""
    if old == new:
        return True
    if isinstance(old, IntegralType) and isinstance(new, IntegralType):
        return _INTEGRAL[new.simpleString()][0] >= _INTEGRAL[old.simpleString()][0]
    if isinstance(new, DecimalType):
        if isinstance(old, DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        if isinstance(old, IntegralType):
            return new.precision - new.scale >= _INTEGRAL[old.simpleString()][1]
    return False


def read_widened(spark: SparkSession, path: str, declared: StructType | None = None) -> DataFrame:
    """Files of one table whose columns have several DECIMAL or integral widths, as one frame.

    The footers are merged to the widest type of each column (different scales
    are refused); with ``declared`` the columns get its types, and a column whose
    stored type is wider is refused unless every value fits, in which case
    reading a value that does not fit raises.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    if declared is None:
        return rows
    missing = [f.name for f in declared if f.name not in rows.columns]
    if missing:
        raise ValueError(f"columns that no file has: {missing}")
    # ANSI casts raise on overflow; a smaller scale would round, which is a loss
    columns = []
    for f in declared:
        stored = rows.schema[f.name].dataType
        value = F.col(f"`{f.name}`")
        cast = value.cast(f.dataType)
        if not widens(stored, f.dataType):
            cast = F.when(value.isNull() | (cast == value), cast).otherwise(
                F.raise_error(F.concat(F.lit(f"{f.name} loses digits: "), value.cast("string"))))
        columns.append(cast.alias(f.name))
    return rows.select(*columns)
