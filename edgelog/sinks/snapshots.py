"""The newest row of each id without reading every batch ever written.

A snapshot of a routed table holds the newest rows of each folder (index) and, per folder,
writer and run, a mark: the last batch it contains and when that was written. A refresh
reads the batches beyond the marks and the snapshot of just the folders they lie in;
a reader takes the snapshot and the batches beyond the marks, and ranks only the ids that
these hold, so the rows of the snapshot are not shuffled.

    rows/<folder>/version=<n>    newest rows, with the writer, run and batch they came from
    marks/version=<n>            what is contained; written last, which publishes the version

As in a store that replaces by id, an id belongs to its folder: the same id in two folders
is two rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelog.sinks.writers import found, read_routed

_FROM = ["writer", "run", "batch"]
_ORDER = {"writer": "_writer", "run": "_run", "batch": "_batch"}


@dataclass(frozen=True)
class Folder:
    """One batch of a routed table as it lies on disk."""

    part: tuple[str, ...]
    writer: str
    run: int
    batch: int
    written: int
    path: str


def folders(spark: SparkSession, base: str, parts: list[str]) -> list[Folder]:
    """Every batch folder of a routed table, from a listing; no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([base, *(f"{p}=*" for p in parts), "writer=*", "run=*", "batch=*"]))
    out = []
    for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
        where = status.getPath().toString()
        names = [unquote(n.split("=", 1)[1]) for n in where.rstrip("/").split("/")[-len(parts) - 3 :]]
        out.append(Folder(tuple(names[:-3]), names[-3], int(names[-2]), int(names[-1]), status.getModificationTime(), where))
    return out


@dataclass(frozen=True)
class Marks:
    """What the newest version of a snapshot contains."""

    version: int
    rows: dict[tuple[str, ...], int]
    done: dict[tuple, tuple[int, int]]

    def covers(self, f: Folder) -> bool:
        batch, written = self.done.get((f.part, f.writer, f.run), (-1, -1))
        return f.batch <= batch and f.written <= written

    def rewritten(self, f: Folder) -> bool:
        """A batch the snapshot contains in an older form."""
        batch, written = self.done.get((f.part, f.writer, f.run), (-1, -1))
        return f.batch <= batch and f.written > written


_MARKS = "part array<string>, writer string, run bigint, batch bigint, written bigint, rows_version bigint"


def marks(spark: SparkSession, target: str) -> Marks:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/marks/version=*")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    whole = [int(s.getPath().getName().split("=")[1]) for s in there if found(spark, f"{s.getPath()}/_SUCCESS")]
    if not whole:
        return Marks(0, {}, {})
    version = max(whole)
    held = spark.read.schema(_MARKS).parquet(f"{target}/marks/version={version}").collect()  # a row per folder and writer
    return Marks(
        version, {tuple(r["part"]): r["rows_version"] for r in held},
        {(tuple(r["part"]), r["writer"], r["run"]): (r["batch"], r["written"]) for r in held},
    )


def _plan(spark: SparkSession, base: str, target: str, parts: list[str]) -> tuple[Marks, list[Folder], set, list[Folder]]:
    """Marks, all folders, the parts to be ranked anew from all their batches, and the batches to read."""
    have, there = marks(spark, target), folders(spark, base, parts)
    anew = {f.part for f in there if have.rewritten(f)}
    return have, there, anew, [f for f in there if f.part in anew or not have.covers(f)]


def _batches(spark: SparkSession, base: str, parts: list[str], wanted: list[Folder], schema: T.StructType) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", base)
    return rows.parquet(*[f.path for f in wanted]).withColumnsRenamed(_ORDER) if wanted else spark.createDataFrame([], schema).withColumnsRenamed(_ORDER)


def _stored(spark: SparkSession, target: str, parts: list[str], kept: dict[tuple[str, ...], int], schema: T.StructType) -> DataFrame:
    """Snapshot rows of the folders in ``kept``."""
    own = T.StructType([T.StructField(_ORDER.get(f.name, f.name), f.dataType) for f in schema])
    if not kept:
        return spark.createDataFrame([], own)
    path = spark._jvm.org.apache.hadoop.fs.Path
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    paths = ["/".join([f"{target}/rows", *(f"{n}={escape(v)}" for n, v in zip(parts, part)), f"version={version}"]) for part, version in kept.items()]
    there = [p for p in paths if path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(p))]
    rows = spark.read.schema(own).option("basePath", f"{target}/rows")
    return rows.parquet(*there).select(*own.names) if there else spark.createDataFrame([], own)


def _newest(df: DataFrame, parts: list[str], keys: list[str]) -> DataFrame:
    """The newest row per folder and key, in the order of :func:`edgelog.sinks.writers.latest`."""
    rest = [c for c in df.columns if c not in _ORDER.values()]
    order = [F.col("_run").desc(), F.col("_batch").desc(), F.xxhash64(*rest).desc()]
    rank = F.row_number().over(Window.partitionBy(*parts, *keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def refresh(spark: SparkSession, base: str, target: str, keys: list[str] | None = None, part: list[str] | None = None) -> list[tuple[str, ...]]:
    """Bring the snapshot ``target`` of the table ``base`` up to date; the folders that were ranked anew.

    Nothing is read of folders without new batches. A run that dies leaves the version before
    it; what it has written is not published.
    """
    parts, ids = part or ["index_name"], keys or ["id"]
    have, there, anew, wanted = _plan(spark, base, target, parts)
    touched = sorted({f.part for f in wanted})
    version = have.version + 1
    if not touched:
        return []
    schema = read_routed(spark, base, parts).schema
    old = {p: have.rows[p] for p in touched if p in have.rows and p not in anew}
    rows = _newest(_batches(spark, base, parts, wanted, schema).unionByName(_stored(spark, target, parts, old, schema)), parts, ids)
    marked = rows.withColumn("version", F.lit(version)).hint("rebalance", *[F.col(p) for p in parts])
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "version").parquet(f"{target}/rows")
    done = dict(have.done)
    for f in there:
        batch, written = done.get((f.part, f.writer, f.run), (-1, -1))
        done[f.part, f.writer, f.run] = (max(batch, f.batch), max(written, f.written))
    lines = [(list(p), w, r, b, t, version if p in touched else have.rows[p]) for (p, w, r), (b, t) in done.items()]
    spark.createDataFrame(lines, _MARKS).coalesce(1).write.mode("overwrite").parquet(f"{target}/marks/version={version}")
    return touched


def newest_rows(
    spark: SparkSession, base: str, target: str, keys: list[str] | None = None, part: list[str] | None = None,
) -> DataFrame:
    """The newest row per folder and id: the snapshot, and what was written since.

    The same rows as ``writers.latest`` with the folder in the key gives from all batches.
    """
    parts, ids = part or ["index_name"], keys or ["id"]
    have, _, anew, wanted = _plan(spark, base, target, parts)
    schema = read_routed(spark, base, parts).schema
    old = _stored(spark, target, parts, {p: v for p, v in have.rows.items() if p not in anew}, schema)
    plain = old.drop(*_ORDER.values()).columns
    if not wanted:
        return old.select(*plain)
    new = _batches(spark, base, parts, wanted, schema)
    key = [*parts, *ids]
    same = new.select(*[F.col(c).alias(f"_new_{c}") for c in key]).distinct()
    meet = [old[c].eqNullSafe(same[f"_new_{c}"]) for c in key]
    changed = _newest(new.unionByName(old.join(same, meet, "left_semi")), parts, ids)
    return old.join(same, meet, "left_anti").select(*plain).unionByName(changed.select(*plain))
