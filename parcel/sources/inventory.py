"""File inventories as DataFrames.

One listing for every caller: executors list the folders of a level, the rows
are written to the shared folder, and the sub-folders among them are the next
level's work, as data. Neither file names nor folder names pass through the
driver, so a level can hold any number of folders. A mounted folder is read as a
stream, whose entries leave the task in chunks; one of more than ``SPLIT`` names
is split into ranges of names that several tasks list on the next level. (An
object store's client gives a folder's listing as a whole: one task's work.)

Folder names are literal: ``[``, ``{`` or ``?`` in them mean nothing. All names
are listed, also those that start with ``_`` or ``.``, except those of this
library's own temporary form (stage folders of exports, unfinished copies).

Inventory schema: ``bucket string, key string, filename string,
size bigint, mtime timestamp_ntz`` (UTC wall clock). ``bucket`` is the
listing root, ``key`` the path below it.
"""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel import files
from parcel.functions import paths
from parcel.session import ship_package, stored
from parcel.sinks.publish import STAGE_NAME

INVENTORY_SCHEMA = T.StructType([
    T.StructField("bucket", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("mtime", T.TimestampNTZType()),
])


def empty_inventory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INVENTORY_SCHEMA)


#: Work of a listing: a folder, or the names of it from ``lo`` up to ``hi``.
WORK = "folder string, lo string, hi string"
LISTED_SCHEMA = T.StructType([
    *INVENTORY_SCHEMA.fields,
    T.StructField("folder", T.StringType()),
    T.StructField("lo", T.StringType()),
    T.StructField("hi", T.StringType()),
])
#: Entries that leave a listing task at a time.
CHUNK = 10_000
#: A folder with more names than that is split into ranges of about as many,
#: at most ``MOST_RANGES``, by names drawn from it evenly.
SPLIT, MOST_RANGES, DRAWN = 50_000, 64, 4_096
#: This library's own temporary names.
_COPY = re.compile(r"\.parcel-[0-9a-f]{12}-p[0-9]+-a[0-9]+-.*\.part", re.S)


def list_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    pattern: str | None = None,
    split: int = SPLIT,
) -> DataFrame:
    """Every file under ``root`` whose key starts with ``prefix``.

    ``prefix`` is a string prefix (``exp`` also matches ``exp_old/...``, I2).
    A ``*`` in it switches on basename globbing (I4); otherwise ``pattern`` is
    the optional basename glob. Listing starts at the deepest literal folder
    of the prefix, the rest is a filter. A missing location gives an empty
    inventory.
    """
    rule = paths.ListingRule.parse(prefix, pattern)
    root_q = files.qualify(root)
    start = files.join(root_q, rule.folder) if rule.folder else root_q
    return filter_objects(_walk(spark, root_q, [start], split=split), rule.prefix, rule.glob)


def _own_temporary(name: str, kind: str) -> bool:
    return bool(STAGE_NAME.fullmatch(name) if kind == "Directory" else _COPY.fullmatch(name))


def _ranges(folder: str, split: int) -> list[tuple[str | None, str | None]] | None:
    """Ranges of names that the folder is split into; ``None`` for a folder of
    at most ``split`` names. Holds ``DRAWN`` names, whatever their number."""
    drawn, count, rng = [], 0, random.Random(17)
    for name, _, _ in files.scan(folder):
        count += 1
        if len(drawn) < DRAWN:
            drawn.append(name)
        elif (at := rng.randrange(count)) < DRAWN:
            drawn[at] = name
    if count <= split:
        return None
    parts = min(MOST_RANGES, -(-count // split))
    drawn.sort()
    cuts = sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)})
    return list(zip([None, *cuts], [*cuts, None]))


def _lister(root_q: str, split: int):
    """mapInPandas body: the entries of each folder, or range of a folder's
    names, of the batch."""

    def run(batches):
        import pandas as pd

        names = LISTED_SCHEMA.fieldNames()
        _, root_path = files.resolve(root_q)
        root_path = root_path.rstrip("/")

        def frame(rows):
            return pd.DataFrame(rows, columns=names).astype({"size": "Int64"})

        for pdf in batches:
            for folder, lo, hi in zip(pdf["folder"], pdf["lo"], pdf["hi"]):
                lo, hi = (x if isinstance(x, str) else None for x in (lo, hi))
                if lo is None and hi is None and files.local_path(folder) is not None:
                    ranges = _ranges(folder, split)
                    if ranges is not None:
                        yield frame([(root_q, None, None, None, None, folder, *r) for r in ranges])
                        continue
                fs, path = files.resolve(folder)
                path = path.rstrip("/") or "/"
                below = path[len(root_path):].strip("/")
                rows = []
                if fs.get_file_info(path).type.name == "File":
                    info = fs.get_file_info(path)
                    rows.append(_entry(root_q, below, info.size, info.mtime))
                for name, kind, look in files.scan(folder) if not rows else ():
                    if lo is not None and name < lo or hi is not None and name >= hi or _own_temporary(name, kind):
                        continue
                    key = f"{below}/{name}" if below else name
                    if kind == "Directory":
                        rows.append((root_q, None, None, None, None, files.join(root_q, key), None, None))
                    elif kind == "File":
                        try:
                            rows.append(_entry(root_q, key, *look()))
                        except FileNotFoundError:  # it has gone since, or is a link to nothing
                            pass
                    if len(rows) == CHUNK:
                        yield frame(rows)
                        rows = []
                yield frame(rows)

    return run


def _entry(root_q: str, key: str, size, mtime) -> tuple:
    if mtime is not None:  # UTC; keep Hadoop's millisecond precision
        mtime = mtime.replace(tzinfo=None)
        mtime = mtime.replace(microsecond=mtime.microsecond // 1000 * 1000)
    return root_q, key, key.rsplit("/", 1)[-1], int(size) if size is not None else None, mtime, None, None, None


def _walk(spark: SparkSession, root_q: str, starts: list[str], recursive: bool = True, split: int = SPLIT) -> DataFrame:
    """Files under the folders ``starts``, level by level. The ranges of a
    large folder are work of the next level."""
    ship_package(spark)
    most = spark.sparkContext.defaultParallelism * 4
    level, n, found = spark.createDataFrame([(s, None, None) for s in starts], WORK), len(starts), None
    while n:
        listed = stored(level.repartition(min(n, most)).mapInPandas(_lister(root_q, split), LISTED_SCHEMA), "listing")
        rows = listed.where("folder is null").drop("folder", "lo", "hi")
        found = rows if found is None else found.unionByName(rows)
        level = listed.where("folder is not null").select("folder", "lo", "hi")
        if not recursive:
            level = level.where("lo is not null or hi is not null")
        n = level.count()
    return found if found is not None else empty_inventory(spark)


def list_folders(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """S2 over several folders of one root as a single relation (e.g.
    today's folder of every export). Folders that do not exist are skipped;
    none existing gives an empty inventory."""
    root_q = files.qualify(root)
    return filter_objects(_walk(spark, root_q, [files.join(root_q, f) for f in folders]))


def filter_objects(inv: DataFrame, prefix: str = "", glob: str | None = None) -> DataFrame:
    """I2 + I3 + I4 over any inventory DataFrame (e.g. a storage inventory
    report): string prefix, no folder markers, optional basename glob."""
    out = inv
    if prefix:
        out = out.where(F.col("key").startswith(prefix))
    out = out.where(~paths.is_dir_marker("key"))
    if glob:
        out = out.where(paths.glob_match("filename", glob))
    return out


def list_flat(spark: SparkSession, directory: str, split: int = SPLIT) -> DataFrame:
    """S3: files directly inside ``directory`` (no sub-folders); a missing
    directory is an empty inventory, other errors propagate (S3c)."""
    root_q = files.qualify(directory)
    return filter_objects(_walk(spark, root_q, [root_q], recursive=False, split=split))


def list_names(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """Basenames of every object under ``root`` / ``prefix``."""
    return list_objects(spark, root, prefix or "").select("filename")


def list_target_exports(spark: SparkSession, directory: str) -> DataFrame:
    """Flat target files whose names follow the shard pattern, with the
    export and date parsed from the name (I7); other names are left out."""
    from parcel.operators.inventory import with_shard_fields

    return with_shard_fields(list_flat(spark, directory))


def list_with_mb(spark: SparkSession, uri_root: str, prefix: str = "") -> DataFrame:
    """Listing with ``size_mb`` (2 dp, half-even) and the update time.
    A ``*`` cuts the prefix right before it."""
    from parcel.functions.sizes import size_mb

    star = prefix.find("*")
    cut = prefix[:star] if star >= 0 else prefix
    inv = list_objects(spark, uri_root, cut)
    return inv.select(F.col("key").alias("name"), size_mb("size").alias("size_mb"), F.col("mtime").alias("updated"))


def read_uri_list(spark: SparkSession, path: str) -> DataFrame:
    """One URI per line; lines are trimmed and blank ones dropped."""
    text = spark.read.text(path)
    return text.select(F.trim("value").alias("uri")).where(F.col("uri") != "")
