"""Session defaults and shared scratch locations.

Everything that must outlive a task (staged export shards, delivery logs,
missing-file lists) goes under the folder the cluster names in
``spark.checkpoint.dir``, which every executor shares. Where the setting is
absent, a local master gets a folder of its own; on a cluster that is an
error, because executors would write to disks that nobody else reads.

The library computes in wall-clock UTC. ``get_session`` sets that zone on the
sessions it builds; on a session of the caller's it is required, not set.
"""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "parcel", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the defaults this library relies on.

    On a cluster ``master`` stays ``None`` and the submit-time settings win;
    only keys that are unset are filled in.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for key, value in {**_DEFAULTS, **conf}.items():
            if key.startswith("spark.sql.") and active.conf.get(key, None) is None:
                active.conf.set(key, value)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this application."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # SparkContext appends a per-application uuid; its parent is the shared root.
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="parcel-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared checkpoint root (not created)."""
    return f"{checkpoint_root(spark)}/parcel/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once,
    whatever reads it, and safe against the loss of an executor."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``parcel`` importable in executor Python workers.

    The few steps that run Python inside tasks (copies, distributed listing,
    distributed shard moves) pickle functions of this package; executors need
    the package itself. It is zipped once per application into the shared
    checkpoint folder and registered with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app not in _SHIPPED:
            _ship(sc, spark)
            _SHIPPED.add(app)


def _ship(sc, spark: SparkSession) -> None:
    import io
    import os
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, dirs, names in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    from parcel import files

    uri = f"{checkpoint_root(spark)}/parcel/pyfiles-{uuid.uuid4().hex[:8]}/parcel.zip"
    fs, path = files.resolve(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(buf.getvalue())
    try:
        sc.addPyFile(uri)
    except Exception as exc:  # noqa: BLE001
        # already shipped with the application (e.g. --py-files parcel.zip)
        if "already registered" not in str(exc):
            raise
