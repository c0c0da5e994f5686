"""A stored table with one row per key: writes merge only the key buckets they touch.

Rows lie in folders by hash of their key. A log of numbered files, each complete and made only if its number is free, says
which folders a bucket consists of, oldest first; the highest number is the table. ``append`` adds a folder to the buckets
of its rows and reads nothing, ``upsert`` replaces these buckets by their merged rows, ``compact`` merges the buckets that
have several folders. No folder holds a key twice, so a bucket with one folder is read as it is and only the others are
reduced. Of two writers that want the same number one wins; the other takes its staged folder to the next number and merges
again only the buckets that the winner changed. A writer that dies leaves a folder nobody refers to.

Publishing writes a file of its own and renames it to the number, which fails if that exists; on HDFS this is one atomic
step, on a local file system it is not atomic between processes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamis.operators.checks import ContractError
from tamis.sources.files import exists
from tamis.sources.snapshot import TRIES

BUCKET, _SEQ, _ROW = "_bucket", "_seq", "_row"
Files = dict[int, list[tuple[int, str]]]  # bucket -> (number of the commit, folder), oldest first


def _publish(spark: SparkSession, root: str, version: int, content: str) -> bool:
    """Makes the log file of this number with this content; false if there is one already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    staged = jvm.org.apache.hadoop.fs.Path(f"{root}/staged/{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/log/{version:012d}")
    system = staged.getFileSystem(conf)
    system.mkdirs(target.getParent())
    out = system.create(staged, False)
    out.write(bytearray(content.encode()))
    out.close()
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), conf).rename(
            system.makeQualified(staged), system.makeQualified(target), keep)
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    return True


class KeyedTable:
    """One row per ``keys``: the one with the greatest ``order``, of equal ones the one that was written later.

    Within one write, rows of equal key and order are compared by their other columns, so any partitioning gives the same
    row. Columns in ``least`` keep their smallest value over all rows of the key that were ever written. Null keys are
    values like others; null order comes first. New columns are added, missing ones are null; a column of another type is
    an error, and so are columns that cannot be ordered. ``buckets``, ``keys``, ``order`` and ``least`` belong to the table
    and cannot change. A write without rows publishes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] = (),
                 least: Sequence[str] = (), buckets: int = 64):
        self.spark, self.root = spark, root
        self.layout = {"keys": list(keys), "order": list(order), "least": list(least), "buckets": buckets}

    def version(self) -> int:
        """Number of the last commit, 0 for none."""
        if not exists(self.spark, f"{self.root}/log"):
            return 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return max((int(s.getPath().getName()) for s in found if s.getPath().getName().isdigit()), default=0)

    def state(self) -> tuple[int, StructType, Files]:
        version = self.version()
        if not version:
            return 0, StructType(), {}
        said = json.loads(self.spark.read.text(f"{self.root}/log/{version:012d}", wholetext=True).first()["value"])
        if said["layout"] != self.layout:
            raise ContractError(f"the table was made with {said['layout']}")
        files = {int(b): [tuple(f) for f in own] for b, own in said["files"].items()}
        return version, StructType.fromJson(said["schema"]), files

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table, or the rows of some buckets; files of others are not opened."""
        version, schema, files = self.state()
        if not version:
            raise ContractError(f"nothing was written to {self.root}")
        wanted = files if buckets is None else {b: files[b] for b in buckets if b in files}
        alone = [own[0][1] for own in wanted.values() if len(own) == 1]
        rows = self._load(alone, schema)
        several = {b: own for b, own in wanted.items() if len(own) > 1}
        return rows.unionByName(self._merged(several, schema).drop(BUCKET)) if several else rows

    def append(self, rows: DataFrame) -> int:
        """Adds the rows as one more folder of their buckets, without reading any; returns the number of the commit."""
        staged, schema, touched = self._stage(rows)
        if not touched:
            return self.version()

        def change(files: Files, version: int, _: StructType) -> Files:
            return files | {b: [*files.get(b, []), (version, f"{staged}/{BUCKET}={b}")] for b in touched}

        return self._commit(schema, change)

    def upsert(self, rows: DataFrame) -> int:
        """Merges the rows into their buckets, which then have one folder each; returns the number of the commit."""
        staged, schema, touched = self._stage(rows)
        if not touched:
            return self.version()
        made: dict[int, tuple[list, str]] = {}  # bucket -> folders it was merged from, and into

        def change(files: Files, version: int, schema: StructType) -> Files:
            own = {b: (version, f"{staged}/{BUCKET}={b}") for b in touched}
            # Staged rows of new buckets stay where they are; others are merged if they changed since the last try.
            again = {b: files[b] for b in touched if b in files and (b not in made or made[b][0] != files[b])}
            if again:
                into = self._store(self._merged({b: [*old, own[b]] for b, old in again.items()}, schema))
                made.update({b: (old, f"{into}/{BUCKET}={b}") for b, old in again.items()})
            return files | {b: [(version, made[b][1])] if b in files else [own[b]] for b in touched}

        return self._commit(schema, change)

    def compact(self, folders: int = 2) -> int:
        """Merges every bucket that has so many folders or more; folders added meanwhile stay behind the merged one."""
        made: dict[int, tuple[list, str]] = {}
        schema, files = self.state()[1:]
        many = {b: own for b, own in files.items() if len(own) >= folders}
        if not many:
            return self.version()
        into = self._store(self._merged(many, schema))
        made = {b: (own, f"{into}/{BUCKET}={b}") for b, own in many.items()}

        def change(files: Files, version: int, _: StructType) -> Files:
            same = {b: (old, path) for b, (old, path) in made.items() if files[b][:len(old)] == old}
            return files | {b: [(old[-1][0], path), *files[b][len(old):]] for b, (old, path) in same.items()}

        return self._commit(schema, change)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.layout["keys"]), F.lit(self.layout["buckets"])).cast("int"))

    def _reduced(self, rows: DataFrame) -> DataFrame:
        """One row per key; an aggregate that combines before the shuffle, so a frequent key is no hot one."""
        keys, order, least = (self.layout[k] for k in ("keys", "order", "least"))
        rest = [c for c in rows.columns if c not in (*keys, *least, BUCKET, _SEQ)]
        best = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(_SEQ), F.struct(
            F.lit(0).alias(_ROW), *rest).alias(_ROW)))
        found = rows.groupBy(BUCKET, *keys).agg(best.alias("_best"), *[F.min(c).alias(c) for c in least])
        return found.select(BUCKET, *[F.col(f"_best.{_ROW}.`{c}`") if c in rest else F.col(f"`{c}`")
                                      for c in rows.columns if c not in (BUCKET, _SEQ)])

    def _load(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _merged(self, files: Files, schema: StructType) -> DataFrame:
        """The buckets' rows reduced, with their bucket; one scan per commit that they hold folders of."""
        by_commit: dict[int, list[str]] = {}
        for own in files.values():
            for seq, folder in own:
                by_commit.setdefault(seq, []).append(folder)
        rows = None
        for seq, folders in sorted(by_commit.items()):
            part = self._load(folders, schema).withColumn(_SEQ, F.lit(seq))
            rows = part if rows is None else rows.unionByName(part)
        return self._reduced(self._bucketed(rows))

    def _store(self, rows: DataFrame) -> str:
        """Writes rows with a bucket column; the hint lets Spark split a large bucket over several tasks."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).mode("errorifexists").parquet(path)
        return path

    def _stage(self, rows: DataFrame) -> tuple[str, StructType, list[int]]:
        clash = {BUCKET, _SEQ, "_best"} & set(rows.columns)
        if clash:
            raise ContractError(f"columns with reserved names: {', '.join(sorted(clash))}")
        path = self._store(self._reduced(self._bucketed(rows).withColumn(_SEQ, F.lit(0))))
        # The folder names: at most one per bucket of the layout.
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in target.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(target)]
        return path, rows.schema, sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def _commit(self, schema: StructType, change: Callable[[Files, int, StructType], Files]) -> int:
        for _ in range(TRIES):
            version, old, files = self.state()
            known = {f.name: f.dataType for f in old}
            wrong = [f.name for f in schema if f.name in known and known[f.name] != f.dataType]
            if wrong:
                raise ContractError(f"columns of another type than stored: {', '.join(wrong)}")
            both = StructType([*old, *(f for f in schema if f.name not in known)])
            files = change(files, version + 1, both)
            said = {"layout": self.layout, "schema": both.jsonValue(), "files": {str(b): own for b, own in sorted(files.items())}}
            if _publish(self.spark, self.root, version + 1, json.dumps(said)):
                return version + 1
        raise ContractError(f"{TRIES} other writes were published first")
