"""Compaction of a stream's landing table: many small files become few, while the stream and its readers go on.

The sink's log says which files a landing table has, and only the sink may write it. So compaction leaves the landing folder
as it is and keeps a second one beside it, `<landing>.compacted`:

* `gen=<id>/<partition folders>`: what a run has rewritten,
* `manifests/<id>`: the whole state after it: rewritten files that count (`live`), landing files they stand for (`covered`),
* `commits/<n>`: the id of the n-th state. The largest n is the table; creating it is the swap.

The table is its live files plus what the sink's log lists beyond the covered ones. A run that dies before its commit leaves
files that nothing counts; one that dies after it leaves files that nothing reads. Both go in a later run, and none
sooner than `grace` after the commit that made it useless, so that readers that had planned on it can end.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from solvind.operators.layout import stage
from solvind.schemas import LANDING_STREAM
from solvind.workspace import delete_folders, staging

TARGET_BYTES = 128 * 1024 * 1024
GRACE_SECONDS = 24 * 3600
COMMIT_SECONDS = 600  # after which a commit without content is one whose run has died
FILES_AT_ONCE = 100_000  # oldest partitions first; the next run takes the rest
STATE = "kind string, file string, size long, folder string, since long"
#: The `k=v` folders of a file, without the generation.
_FOLDER = r"(?:/gen=[^/]+)?((?:/[^/=]+=[^/]*)+)/[^/]+$"


def _local_name(file) -> Column:
    """A file's name without scheme and host, which the log and the scan write in different ways."""
    return F.regexp_replace(file, r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "")


def compacted_path(path: str) -> str:
    return f"{path.rstrip('/')}.compacted"


class _Files:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.make = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.make(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self.make(folder)
        return [status.getPath().getName() for status in self.system.listStatus(path)] if self.system.exists(path) else []

    def text(self, path: str) -> str:
        stream = self.system.open(self.make(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Fails if the file exists: of two runs that commit the same state one is refused."""
        stream = self.system.create(self.make(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def modified(self, path: str) -> float:
        return self.system.getFileStatus(self.make(path)).getModificationTime() / 1000


@dataclass
class Snapshot:
    """One committed state. `number` 0 is the table before the first compaction."""

    number: int
    state: DataFrame  # STATE


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    base = compacted_path(path)
    files = _Files(spark, base)
    for number in sorted((int(name) for name in files.names(f"{base}/commits") if name.isdigit()), reverse=True):
        generation = files.text(f"{base}/commits/{number}")
        if generation:  # an empty one is being written, or was when its run died
            return Snapshot(number, spark.read.schema(STATE).parquet(f"{base}/manifests/{generation}"))
    return Snapshot(0, spark.createDataFrame([], STATE))


def sink_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, folder) of every file that the sink's log counts, none if there is no log.

    The driver reads the log, as it does for every scan of the table: the last summary and the batches after it.
    """
    log = f"{path.rstrip('/')}/_spark_metadata"
    files, sizes, gone = _Files(spark, log), {}, set()
    names = [name for name in files.names(log) if name.split(".")[0].isdigit()]
    summary = max((int(name.split(".")[0]) for name in names if name.endswith(".compact")), default=-1)
    for name in names:
        batch = int(name.split(".")[0])
        if batch > summary or name == f"{summary}.compact":
            for line in files.text(f"{log}/{name}").splitlines()[1:]:
                entry = json.loads(line)
                sizes[entry["path"]] = entry["size"]
                if entry["action"] == "delete":
                    gone.add(entry["path"])
    listed = spark.createDataFrame([(file, size) for file, size in sizes.items() if file not in gone], "file string, size long")
    return listed.withColumn("folder", F.regexp_extract("file", _FOLDER, 1))


def table_files(spark: SparkSession, path: str, at: Snapshot | None = None) -> DataFrame:
    """(kind, file, size, folder) of the files that make up the table: `live` rewritten ones and those of the sink."""
    at = at or snapshot(spark, path)
    covered = at.state.where("kind = 'covered'").select("file")
    sink = sink_files(spark, path).join(covered, "file", "left_anti").withColumn("kind", F.lit("sink"))
    return at.state.where("kind = 'live'").select("kind", "file", "size", "folder").unionByName(sink)


def _read(spark: SparkSession, path: str, files: Sequence, schema: StructType) -> DataFrame:
    """Rows of listed files (kind, file) with their folder columns."""
    named = StructType([*schema.fields, StructField("gen", StringType())])
    parts = []
    for kind, base, shape in (("sink", path, schema), ("live", compacted_path(path), named)):
        some = [unquote(row.file) for row in files if row.kind == kind]
        if some:
            read = spark.read.schema(shape).option("basePath", base).option("ignoreMissingFiles", "true").parquet(*some)
            parts.append(read.select(*schema.fieldNames(), _local_name(F.col("_metadata.file_path")).alias("_file")))
    if not parts:
        return spark.createDataFrame([], StructType([*schema.fields, StructField("_file", StringType())]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_landed(spark: SparkSession, path: str, schema: StructType = LANDING_STREAM, with_file: bool = False) -> DataFrame:
    """The landing table, compacted or not, each row once; `with_file` adds the file that holds it as `_file`.

    File names pass through the driver, as in every scan.
    """
    at = snapshot(spark, path)
    if at.number:
        rows = _read(spark, path, table_files(spark, path, at).select("kind", "file").collect(), schema)
    else:
        rows = spark.read.schema(schema).option("ignoreMissingFiles", "true").parquet(path)
        rows = rows.select(*schema.fieldNames(), _local_name(F.col("_metadata.file_path")).alias("_file"))
    return rows if with_file else rows.drop("_file")


def plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(kind, file, size, folder, bin): files below half the target, put together by folder into bins of about the target.

    Small ones first. A bin of one file is left alone, as is a file that is large enough.
    """
    order = Window.partitionBy("folder").orderBy("size", "file")
    filled = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    binned = files.where(F.col("size") < target_bytes / 2).withColumn("bin", F.floor(F.coalesce(filled, F.lit(0)) / target_bytes))
    together = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("together", together).where("together > 1").drop("together")


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType = LANDING_STREAM,
    target_bytes: int = TARGET_BYTES,
    order_by: Sequence[str] = ("dt",),
    grace: float = GRACE_SECONDS,
    files_at_once: int = FILES_AT_ONCE,
    now: float | None = None,
) -> dict[str, int]:
    """Rewrite the small files of a landing table and commit; then remove what has been useless for `grace` seconds.

    Returns files before and after among those rewritten, and files removed. The work follows the small files, not the table.
    """
    base, now = compacted_path(path), time.time() if now is None else now
    columns = [name for name in schema.fieldNames()]
    with staging(spark):
        at = snapshot(spark, path)
        chosen = plan(table_files(spark, path, at), target_bytes).orderBy("folder", "bin", "file").limit(files_at_once)
        chosen, before = stage(chosen, "plan")
        after = 0
        if before:
            generation = uuid.uuid4().hex
            folders = [part.split("=", 1)[0] for part in chosen.first().folder.strip("/").split("/")]
            files = chosen.select("kind", "file").collect()
            rows = _read(spark, path, files, schema)
            bins = chosen.select("folder", "bin").distinct().count()
            there = Observation()
            dealt = rows.join(chosen.select(_local_name(F.col("file")).alias("_file"), F.col("folder").alias("_folder"), F.col("bin").alias("_bin")), "_file")
            dealt = dealt.repartition(bins, "_folder", "_bin").sortWithinPartitions(*folders, *order_by)
            dealt.select(*columns).observe(there, F.count(F.lit(1)).alias("rows")).write.partitionBy(*folders).parquet(f"{base}/gen={generation}")
            expected = _read(spark, path, files, schema).count()  # from the files' footers
            if there.get.get("rows", 0) != expected:  # nothing counts what was written, and the next run removes it
                raise RuntimeError(f"compaction of {path} wrote {there.get.get('rows', 0)} rows of {expected}")
            written = _written(spark, f"{base}/gen={generation}").withColumn("since", F.lit(int(now)))
            state, after = stage(written, "written")
            _commit(spark, path, at, generation, _next_state(spark, path, at, chosen, state, int(now)))
    return {"before": before, "after": after, **clean(spark, path, grace, now)}


def _written(spark: SparkSession, folder: str) -> DataFrame:
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    uri = F.col("_metadata.file_path")
    return listing.select(F.lit("live").alias("kind"), uri.alias("file"), F.col("length").alias("size"), F.regexp_extract(uri, _FOLDER, 1).alias("folder"))


def _next_state(spark: SparkSession, path: str, at: Snapshot, chosen: DataFrame, written: DataFrame, now: int) -> DataFrame:
    """The state after a run: what it wrote, live files it did not take, and landing files that are covered now.

    Rewritten files that no longer count stay as `dead` until they are removed. Covered files that the sink's log has
    forgotten are forgotten here too.
    """
    taken = chosen.select("file")
    kept = at.state.where("kind = 'live'").join(taken, "file", "left_anti")
    dead = at.state.where("kind = 'live'").join(taken, "file", "left_semi").withColumns({"kind": F.lit("dead"), "since": F.lit(now).cast("long")})
    known = at.state.where("kind = 'covered'").join(sink_files(spark, path).select("file"), "file", "left_semi")
    covered = chosen.where("kind = 'sink'").select(F.lit("covered").alias("kind"), "file", "size", "folder", F.lit(now).cast("long").alias("since"))
    parts = [written.withColumn("since", F.col("since").cast("long")), kept, dead, known, at.state.where("kind = 'dead'"), covered]
    state = parts[0]
    for part in parts[1:]:
        state = state.unionByName(part)
    return state


def _commit(spark: SparkSession, path: str, at: Snapshot, generation: str, state: DataFrame) -> None:
    base = compacted_path(path)
    files = _Files(spark, base)
    state.coalesce(1).write.parquet(f"{base}/manifests/{generation}")
    number = at.number + 1
    while str(number) in files.names(f"{base}/commits") and not files.text(f"{base}/commits/{number}"):
        if files.modified(f"{base}/commits/{number}") > time.time() - COMMIT_SECONDS:
            raise RuntimeError(f"another compaction of {path} is committing")
        number += 1  # that run died
    files.create(f"{base}/commits/{number}", generation)


def clean(spark: SparkSession, path: str, grace: float = GRACE_SECONDS, now: float | None = None) -> dict[str, int]:
    """Remove files that a commit made useless at least `grace` seconds ago, and what runs without a commit left behind."""
    base, now = compacted_path(path), time.time() if now is None else now
    at, files = snapshot(spark, path), _Files(spark, base)
    if not at.number:
        return {"removed": 0}
    limit = now - grace
    useless = at.state.where(F.col("kind").isin("covered", "dead") & (F.col("since") <= limit)).select("file").collect()
    gone = delete_folders(spark, [unquote(row.file) for row in useless])["files"]
    committed = {files.text(f"{base}/commits/{name}") for name in files.names(f"{base}/commits") if name.isdigit()}
    for name in files.names(base):
        folder = f"{base}/{name}"
        if name.startswith("gen=") and name[4:] not in committed and files.modified(folder) <= limit:
            gone += delete_folders(spark, [folder])["files"]
    return {"removed": gone}
