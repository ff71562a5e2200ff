"""Delivery: copying export files to a landing folder as a Spark job
(D1-D5, D8, D10, D11, A6).

A plan, stored once, has one row for each distinct source: which are copied,
which another source of the same name supersedes, and which a ledger says were
delivered before as they are now. Executors copy the bytes in ``mapInPandas``
(a copy is I/O, not a relational expression). Each copy:

* goes to ``<target>/.parcel-<job>-p<partition>-a<attempt>-<name>.part`` and is
  then renamed onto ``<target>/<name>`` (atomic replace), so a re-run, a
  retried task after a lost executor, or a speculative duplicate leaves
  either the old or the new complete file, never a partial one; a retried
  task removes its predecessors' temporary files by name (no listing). Inside
  one store the store copies, and no bytes pass through Python;
* retries I/O errors with exponential back-off (5 attempts, 1..30 s); a
  missing source is reported at once;
* reports one delivery-log row: sizes on both sides, status, attempts,
  error text, seconds and MB/s. A copy whose size differs from its source's is
  an error that is retried, never ``ok``.

A file of more than ``PART_BYTES`` that goes to a mounted folder is copied in
byte ranges by several tasks into one temporary file; each range is read back
and compared by checksum, and the whole is renamed when all ranges are there.

The log is written once to the shared checkpoint folder and read back, so
copies happen exactly once per successful task however often the log is
queried afterwards.
"""

from __future__ import annotations

import heapq
import os
import time
import uuid
import zlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel import files
from parcel.functions import paths
from parcel.functions.sizes import size_mb
from parcel.session import scratch_dir, ship_package, stored

DELIVERY_LOG_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("source_uri", T.StringType()),
    T.StructField("source_size", T.LongType()),
    T.StructField("target_size", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("mb_per_s", T.DoubleType()),
])

WORK_LIST_SCHEMA = "source_uri string, filename string, size bigint"
#: A ledger's rows: sources that were delivered, as they were then.
LEDGER_SCHEMA = "source_uri string, size bigint, mtime timestamp_ntz, target_dir string, filename string"
#: Bytes of a file that one task copies, where ranges can be written.
PART_BYTES = 256 << 20

CHUNK = 8 << 20


class SourceMissing(FileNotFoundError):
    """The source object does not exist; copying it again cannot help."""


class DeliveryError(RuntimeError):
    def __init__(self, message: str, log: DataFrame | None = None):
        super().__init__(message)
        self.log = log


@dataclass(frozen=True)
class RetryPolicy:
    """Attempts and exponential wait ``min(max, max(min, mult * 2^(n-1)))``."""

    attempts: int = 5
    wait_min: float = 1.0
    wait_max: float = 30.0
    multiplier: float = 1.0

    def wait(self, attempt: int) -> float:
        return min(self.wait_max, max(self.wait_min, self.multiplier * (2 ** (attempt - 1))))


def work_list(inv: DataFrame) -> DataFrame:
    """Inventory -> work list: full source URI, target name (the basename),
    the listed size and, where the inventory has it, the time of change."""
    return inv.select(
        paths.location("bucket", "key").alias("source_uri"),
        paths.basename("key").alias("filename"),
        F.col("size").cast("bigint").alias("size"),
        *([F.col("mtime")] if "mtime" in inv.columns else []),
    )


def work_list_from_uris(uris: DataFrame, column: str = "uri") -> DataFrame:
    """Work list from a URI list (D8): sizes are unknown until copied."""
    return uris.select(
        F.col(column).alias("source_uri"),
        paths.basename(column).alias("filename"),
        F.lit(None).cast("bigint").alias("size"),
    )


def _temp_name(dpath: str, job: str, partition: int, attempt: int, filename: str) -> str:
    return f"{dpath.rstrip('/')}/.parcel-{job}-p{partition}-a{attempt}-{filename}.part"


def _copy_file(src_uri: str, target_dir: str, filename: str, job: str, partition: int,
               attempt: int, clean_earlier: bool = True) -> tuple[int, int]:
    """Copy one file via a temporary name; returns (source bytes, target bytes).

    The temporary name is fixed by (job, partition, task attempt). A retried
    task (attempt > 0, e.g. after its executor was lost) first removes what
    the earlier attempts of the same partition may have left for this file,
    so no listing is needed to clean up. With speculative execution earlier
    attempts may still be running, so ``clean_earlier`` is then off (the
    leftovers are hidden ``.parcel-*.part`` names that listings skip).
    """
    sfs, spath = files.resolve(src_uri)
    dfs, dpath = files.resolve(target_dir)
    for earlier in range(attempt if clean_earlier else 0):
        stale = _temp_name(dpath, job, partition, earlier, filename)
        try:
            if dfs.get_file_info(stale).type.name == "File":
                dfs.delete_file(stale)
        except OSError:
            pass
    info = sfs.get_file_info(spath)
    if info.type.name != "File":
        raise SourceMissing(f"no such source: {src_uri}")
    tmp = _temp_name(dpath, job, partition, attempt, filename)
    final = f"{dpath.rstrip('/')}/{filename}"
    try:
        if files.same_store(sfs, dfs):
            sfs.copy_file(spath, tmp)
        else:
            # compression=None: copy bytes as they are (no codec guessed from the name)
            with sfs.open_input_stream(spath, compression=None) as reader, \
                    dfs.open_output_stream(tmp, compression=None) as writer:
                while True:
                    chunk = reader.read(CHUNK)
                    if not chunk:
                        break
                    writer.write(chunk)
        read, wrote = int(info.size or 0), int(dfs.get_file_info(tmp).size or 0)
        if read != wrote:
            raise OSError(f"{src_uri} has {read} bytes, its copy {wrote}")
        dfs.move(tmp, final)
    finally:
        try:
            if dfs.get_file_info(tmp).type.name == "File":
                dfs.delete_file(tmp)
        except Exception:  # noqa: BLE001 - cleanup must not hide the real error
            pass
    return int(info.size or 0), int(dfs.get_file_info(final).size or 0)


def _copy_part(src_uri: str, target_dir: str, filename: str, job: str, offset: int, length: int, size: int) -> tuple[int, int]:
    """Copy a byte range of a file into the file's one temporary name, which
    every range's task may make or find. Repeatable. Returns (bytes read, bytes
    found in the target with the same checksum)."""
    sfs, spath = files.resolve(src_uri)
    tmp = _temp_name(files.local_path(target_dir), job, 0, 0, filename)
    info = sfs.get_file_info(spath)
    if info.type.name != "File":
        raise SourceMissing(f"no such source: {src_uri}")
    if info.size != size:
        raise ValueError(f"{src_uri} has {info.size} bytes, was planned with {size}")
    out = os.open(tmp, os.O_RDWR | os.O_CREAT, 0o666)
    try:
        if os.fstat(out).st_size != size:
            os.ftruncate(out, size)
        read = 0
        with sfs.open_input_file(spath) as source:
            source.seek(offset)
            while read < length:
                chunk = source.read(min(CHUNK, length - read))
                if not chunk:
                    raise OSError(f"{src_uri} ends before byte {offset + length}")
                at = 0
                while at < len(chunk):
                    at += os.pwrite(out, memoryview(chunk)[at:], offset + read + at)
                if zlib.crc32(os.pread(out, len(chunk), offset + read)) != zlib.crc32(chunk):
                    raise OSError(f"{filename}: bytes from {offset + read} on differ from their source")
                read += len(chunk)
        os.fsync(out)
    finally:
        os.close(out)
    return read, read


def _end_parts(target_dir: str, filename: str, job: str, size: int | None) -> int | None:
    """Rename a file whose ranges have all come (``size``), else drop it.
    Repeatable."""
    folder = files.local_path(target_dir)
    tmp, final = _temp_name(folder, job, 0, 0, filename), os.path.join(folder, filename)
    if size is None:
        if os.path.exists(tmp):
            os.unlink(tmp)
        return None
    if os.path.exists(tmp):
        if os.path.getsize(tmp) != size:
            raise OSError(f"{filename} has {os.path.getsize(tmp)} bytes, its source {size}")
        os.replace(tmp, final)
    return os.path.getsize(final)


def _tried(policy: RetryPolicy, step) -> tuple[int, str | None, tuple]:
    """Attempts, error and result of a step that is retried on I/O errors."""
    attempt = 0
    while True:
        attempt += 1
        try:
            return attempt, None, step()
        except SourceMissing as exc:  # a missing source is not retried
            return attempt, f"{type(exc).__name__}: {exc}", (None, None)
        except OSError as exc:
            if attempt >= policy.attempts:
                return attempt, f"{type(exc).__name__}: {exc}", (None, None)
            time.sleep(policy.wait(attempt))
        except Exception as exc:  # noqa: BLE001 - reported, not retried
            return attempt, f"{type(exc).__name__}: {exc}", (None, None)


def _copier(target_dir: str, policy: RetryPolicy, stop_marker: str | None, job: str, clean_earlier: bool):
    """Build the per-partition function for ``mapInPandas``. With a stop
    marker, the first failure of any task makes it, and all tasks look for it
    before each copy."""

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        partition, task_attempt = (ctx.partitionId(), ctx.attemptNumber()) if ctx else (0, 0)
        for pdf in batches:
            rows = []
            for uri, name, size, offset, length in zip(*(pdf[c] for c in ("source_uri", "filename", "size", "offset", "length"))):
                if stop_marker is not None and files.exists(stop_marker):
                    rows.append((name, uri, None, None, "skipped", 0, None, 0.0, None))
                    continue
                started = time.time()
                if pd.isna(offset):
                    step = lambda: _copy_file(uri, target_dir, name, job, partition, task_attempt, clean_earlier)  # noqa: E731, B023
                else:
                    step = lambda: _copy_part(uri, target_dir, name, job, int(offset), int(length), int(size))  # noqa: E731, B023
                attempts, error, (src_size, dst_size) = _tried(policy, step)
                seconds = time.time() - started
                rate = (src_size / seconds / 1048576.0) if error is None and seconds > 0 else None
                rows.append((name, uri, src_size, dst_size, "ok" if error is None else "failed", attempts, error, seconds, rate))
                if error is not None and stop_marker is not None:
                    files.touch(stop_marker)
            yield pd.DataFrame(rows, columns=[f.name for f in DELIVERY_LOG_SCHEMA.fields]).astype(
                {"source_size": "Int64", "target_size": "Int64", "attempts": "int32"}
            )

    return run


def _ender(target_dir: str, policy: RetryPolicy, job: str):
    """mapInPandas body: end the files that were copied in ranges."""

    def run(batches):
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                whole = row.status == "ok"
                _, error, got = _tried(policy, lambda: (_end_parts(target_dir, row.filename, job, int(row.source_size) if whole else None),))  # noqa: B023
                status, error = ("ok", None) if whole and error is None else ("failed", row.error if error is None else error)
                rate = row.source_size / row.seconds / 1048576.0 if status == "ok" and row.seconds > 0 else None
                rows.append((row.filename, row.source_uri, row.source_size if whole else None, got[0], status, row.attempts, error, row.seconds, rate))
            yield pd.DataFrame(rows, columns=[f.name for f in DELIVERY_LOG_SCHEMA.fields]).astype(
                {"source_size": "Int64", "target_size": "Int64", "attempts": "int32"}
            )

    return run


def _looker():
    """mapInPandas body: size and time of change of sources that lack one."""

    def run(batches):
        for pdf in batches:
            sizes, times = [], []
            for uri in pdf["source_uri"]:
                fs, path = files.resolve(uri)
                info = fs.get_file_info(path)
                sizes.append(info.size if info.type.name == "File" else None)
                when = info.mtime.replace(tzinfo=None) if info.type.name == "File" and info.mtime is not None else None
                times.append(None if when is None else when.replace(microsecond=when.microsecond // 1000 * 1000))
            yield pd.DataFrame({"source_uri": pdf["source_uri"], "filename": pdf["filename"],
                                "size": pd.array(sizes, "Int64"), "mtime": times})

    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none, if it hasn't been begun."""
    if not files.exists(path) or not any(e.base_name.endswith(".parquet") for e in files.list_dir(path)):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _planned(work: DataFrame, target_dir: str, ledger: str | None) -> DataFrame:
    """One row for each distinct source, with its ``action``: ``copy``,
    ``superseded`` or ``unchanged``."""
    spark = work.sparkSession
    work = work if "mtime" in work.columns else work.withColumn("mtime", F.lit(None).cast("timestamp_ntz"))
    rows = work.select("source_uri", "filename", "size", "mtime")
    if ledger is not None:
        known = rows.where("size is not null and mtime is not null")
        looked = rows.where("size is null or mtime is null").mapInPandas(
            _looker(), "source_uri string, filename string, size bigint, mtime timestamp_ntz")
        rows = known.unionByName(looked)
    # one shuffle, by name: the same source listed twice is one row, and the last one of a name is copied
    dealt = rows.repartition("filename").groupBy("filename", "source_uri").agg(F.max("size").alias("size"), F.max("mtime").alias("mtime"))
    last = F.max("source_uri").over(Window.partitionBy("filename"))
    plan = dealt.withColumn("action", F.when(F.col("source_uri") == last, "copy").otherwise("superseded"))
    if ledger is not None:
        mine = read_ledger(spark, ledger).where(F.col("target_dir") == target_dir)
        done = mine.select("source_uri", "filename", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"), F.lit(True).alias("_done")).distinct()
        same = F.col("size").eqNullSafe(F.col("_size")) & F.col("mtime").eqNullSafe(F.col("_mtime")) & F.col("_done")
        plan = plan.join(done, ["source_uri", "filename"], "left").groupBy("source_uri", "filename", "size", "mtime", "action").agg(
            F.coalesce(F.bool_or(same), F.lit(False)).alias("_same"))
        plan = plan.withColumn("action", F.when(F.col("_same") & (F.col("action") == "copy"), "unchanged").otherwise(F.col("action"))).drop("_same")
    return stored(plan, "delivery-plan")


def _units(copied: DataFrame, part_bytes: int | None) -> DataFrame:
    """Work rows: a whole file (null ``offset``), or its byte ranges."""
    whole = [F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("bigint").alias("length")]
    if part_bytes is None:
        return copied.select("source_uri", "filename", "size", *whole)
    large = F.col("size") > part_bytes
    starts = F.when(large, F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(part_bytes).cast("bigint")))
    rows = copied.select("source_uri", "filename", "size", F.explode_outer(starts).alias("offset"))
    return rows.withColumn("length", F.least(F.lit(part_bytes).cast("bigint"), F.col("size") - F.col("offset")))


def deliver(
    work: DataFrame,
    target_dir: str,
    mode: str = "parallel",
    workers: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
    raise_on_failure: bool = True,
    part_bytes: int = PART_BYTES,
    ledger: str | None = None,
) -> DataFrame:
    """Copy every work-list file into ``target_dir`` and return the
    (materialised) delivery log.

    ``mode="parallel"`` (D4): files are spread over ``workers`` tasks (default:
    four per core) by their sizes, those above ``part_bytes`` in ranges where
    the target is a mounted folder; every file is tried, then the driver raises
    if any failed (unless ``raise_on_failure=False``).

    ``mode="ordered"`` (D3): files are range-partitioned by name over
    ``workers`` tasks, which has to be given (1: one pass in name order, as one
    stream copies). The first failure of any range stops all of them, before
    their next copy, by a marker beside the log; the rest is ``skipped``.

    A source listed twice is one file. Of several sources with one name the
    last in key order is copied, the rule that reconciliation applies; the
    others are logged as ``superseded``.

    ``ledger`` names a folder that remembers what was delivered: sources that
    it has with their size and time of change are ``unchanged`` and not copied
    again; what is copied is added. Delete it to deliver all again.
    """
    if mode not in ("parallel", "ordered"):
        raise ValueError("mode must be 'parallel' or 'ordered'")
    if mode == "ordered" and not workers:
        raise ValueError("ordered mode needs a number of workers (1 for a single stream)")
    spark = work.sparkSession
    ship_package(spark)
    files.makedirs(target_dir)  # D6/D7: one mkdirs; fails early if not writable
    log_path = scratch_dir(spark, "delivery-log")
    job = uuid.uuid4().hex[:12]
    plan = _planned(work, target_dir, ledger)
    chosen = plan.where("action = 'copy'")
    ranges = part_bytes if mode == "parallel" and files.local_path(target_dir) is not None else None
    if mode == "parallel":
        units = _units(chosen, ranges)
        shaped, marker = _spread(units, workers or 4 * spark.sparkContext.defaultParallelism), None
    else:
        files.makedirs(f"{log_path}-stop")
        ordered = _units(chosen, None).repartitionByRange(workers, "filename") if workers > 1 else _units(chosen, None).coalesce(1)
        shaped, marker = ordered.sortWithinPartitions("filename", "source_uri"), f"{log_path}-stop/failed"
    speculative = spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true"
    copied = shaped.select("source_uri", "filename", "size", "offset", "length").mapInPandas(
        _copier(target_dir, policy, marker, job, not speculative), DELIVERY_LOG_SCHEMA)
    if ranges is not None and not chosen.where(F.col("size") > ranges).isEmpty():
        copied = _ended(stored(copied, "delivery-parts"), chosen, target_dir, policy, job, ranges)
    passed = plan.where("action <> 'copy'").select("filename", "source_uri", F.col("action").alias("status"), F.lit(0).alias("attempts"))
    copied.unionByName(passed, allowMissingColumns=True).write.mode("errorifexists").parquet(log_path)
    log = spark.read.schema(DELIVERY_LOG_SCHEMA).parquet(log_path)
    if ledger is not None:
        ok = log.where("status = 'ok'").select("source_uri", "filename")
        told = chosen.join(ok, ["source_uri", "filename"]).select(
            "source_uri", "size", "mtime", F.lit(target_dir).alias("target_dir"), "filename")
        told.write.mode("append").parquet(ledger)
    if raise_on_failure:
        found = delivery_counts(log).first()
        bad = found["failed"] + found["skipped"]
        if bad:
            raise DeliveryError(f"{bad} of {found['attempted']} files were not delivered", log)
    return log


def _ended(parts: DataFrame, chosen: DataFrame, target_dir: str, policy: RetryPolicy, job: str, part_bytes: int) -> DataFrame:
    """The log of whole files, with one row for each file that was copied in
    ranges: it is renamed if all ranges are there."""
    large = chosen.where(F.col("size") > part_bytes).select("source_uri", "filename", "size")
    of_file = parts.join(large, ["source_uri", "filename"]).groupBy("source_uri", "filename").agg(
        F.first("size").alias("source_size"),
        F.when(F.bool_and(F.col("status") == "ok") & (F.sum("source_size") == F.first("size")), "ok").otherwise("failed").alias("status"),
        F.sum("attempts").cast("int").alias("attempts"),
        F.min("error").alias("error"),
        F.sum("seconds").alias("seconds"),
    )
    ended = of_file.mapInPandas(_ender(target_dir, policy, job), DELIVERY_LOG_SCHEMA)
    return parts.join(large, ["source_uri", "filename"], "left_anti").select(*DELIVERY_LOG_SCHEMA.fieldNames()).unionByName(ended)


#: Slices of the units that are dealt to workers, for each worker.
SLICES = 16


def _spread(units: DataFrame, workers: int) -> DataFrame:
    """Partitions of about equal bytes: units fall into slices by hash, and
    slices go, largest first, to the worker with the least so far. A file of
    unknown size counts as one byte."""
    if workers == 1:
        return units.coalesce(1)
    slice_ = F.pmod(F.xxhash64("filename", "offset"), F.lit(SLICES * workers))
    weight = F.greatest(F.coalesce("length", "size", F.lit(1)), F.lit(1))
    sums = units.groupBy(slice_.alias("slice")).agg(F.sum(weight).alias("bytes"))
    heap = [(0, w) for w in range(workers)]
    worker = [0] * (SLICES * workers)
    for s, size in sorted(sums.collect(), key=lambda r: (-r["bytes"], r["slice"])):  # a row for each slice
        held, w = heapq.heappop(heap)
        worker[s] = w
        heapq.heappush(heap, (held + size, w))
    return units.repartitionById(workers, F.element_at(F.array(*[F.lit(w) for w in worker]), (slice_ + 1).cast("int")))


def delivery_counts(log: DataFrame) -> DataFrame:
    """Attempted / succeeded / failed (skipped, superseded, unchanged) counts of
    distinct files, plus the copy attempts spent."""
    return log.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "superseded").alias("superseded"),
        F.count_if(F.col("status") == "unchanged").alias("unchanged"),
        F.coalesce(F.sum("attempts"), F.lit(0)).cast("bigint").alias("attempts"),
    )


@dataclass
class TransferResult:
    """D1's result: the log plus the reference's summary fields."""

    export_name: str
    source: str
    destination: str
    log: DataFrame
    files_transferred: int
    total_bytes: int
    total_mb: float
    seconds: float
    outcome: str


def deliver_uri(
    spark: SparkSession,
    root: str,
    prefix: str,
    target_dir: str,
    export_name: str,
    pattern: str | None = None,
    mode: str = "parallel",
    workers: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> TransferResult:
    """Deliver every file under ``root``/``prefix`` (glob rules of S2);
    no matching file is an error (D11 ``no_files``)."""
    from parcel.sources.inventory import list_objects

    started = time.time()
    inv = list_objects(spark, root, prefix, pattern)
    if inv.isEmpty():
        raise FileNotFoundError(f"export {export_name}: nothing to deliver under {root}/{prefix}")
    log = deliver(work_list(inv), target_dir, mode=mode, workers=workers, policy=policy)
    row = log.where("status = 'ok'").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("source_size", F.lit(0).cast("bigint"))).alias("b"),
        F.max("filename").alias("only"),
    ).select("n", "b", "only", size_mb(F.col("b")).alias("mb")).first()
    d = target_dir.rstrip("/")
    destination = f"{d}/{row['only']}" if row["n"] == 1 else f"{d}/"  # D10
    return TransferResult(export_name, f"{root}/{prefix}", destination, log, int(row["n"]),
                          int(row["b"] or 0), float(row["mb"] or 0.0), round(time.time() - started, 2), "ok")


def retry_from_list(spark: SparkSession, list_path: str, target_dir: str,
                    workers: int | None = None, policy: RetryPolicy = RetryPolicy(), ledger: str | None = None) -> DataFrame:
    """Re-deliver the URIs listed in a text file/folder, each once, continue
    past failures, and return the delivery log (A6 counts via
    ``delivery_counts``). With a ledger, a second run copies what is left."""
    from parcel.sources.inventory import read_uri_list

    work = work_list_from_uris(read_uri_list(spark, list_path))
    return deliver(work, target_dir, mode="parallel", workers=workers, policy=policy, raise_on_failure=False, ledger=ledger)
