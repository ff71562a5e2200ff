"""Publishing staged shards so that a failure at any point can be recovered.

A publication first writes its plan, a journal inside the stage folder: which
files of the target go aside and which staged files come in under which name.
Then it runs in steps, each of them a set of moves that can be repeated, and
marks each finished step with an empty file beside the plan:

    plan -> [move earlier files aside] aside -> [move new files in] -> published

If a move fails, the publication is undone by the same means:

    undo -> [new files back to the stage] out -> [earlier files back] undone

A plan without ``published`` or ``undone`` is unfinished: the driver was lost, or
the way back failed, too. Whoever writes this date folder next, or calls
``recover``, reads the plan and its marks and carries it on in its direction,
so the target ends with all new files or all earlier ones. A stage is deleted
only after its last mark: never while it holds the only copy of a file.

Moves of up to ``DRIVER_MOVES`` files run on a few driver threads, more as a
Spark job.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from parcel import files
from parcel.session import ship_package

DRIVER_MOVES = 64
STAGE_NAME = re.compile(r"_stage-([0-9]{8}|backfill)-[0-9a-f]{12}")


class PublishInterrupted(RuntimeError):
    """A publication could be neither finished nor undone; its stage is kept
    for ``recover``."""


def _move_one(src: str, dst: str) -> None:
    """Repeatable: a source that is gone is fine if its target is there."""
    fs, sp = files.resolve(src)
    _, dp = files.resolve(dst)
    if fs.get_file_info(sp).type.name == "File":
        fs.move(sp, dp)
    elif fs.get_file_info(dp).type.name != "File":
        raise FileNotFoundError(f"neither {src} nor {dst} exists")


def _move_partition(batches):
    import pandas as pd

    for pdf in batches:
        for src, dst in zip(pdf["src"], pdf["dst"]):
            _move_one(src, dst)
        yield pd.DataFrame({"dst": pdf["dst"]})


def _move(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    if not pairs:
        return
    if len(pairs) <= DRIVER_MOVES:
        with ThreadPoolExecutor(max_workers=min(16, len(pairs))) as pool:
            list(pool.map(lambda pair: _move_one(*pair), pairs))
        return
    ship_package(spark)
    n = min(len(pairs), spark.sparkContext.defaultParallelism * 2)
    moves = spark.createDataFrame(pairs, "src string, dst string").repartition(n)
    moves.mapInPandas(_move_partition, "dst string").write.format("noop").mode("overwrite").save()


@dataclass
class Publication:
    stage: str
    target: str
    new: list[tuple[str, str]]  # staged name, final name
    earlier: list[str]

    @classmethod
    def planned(cls, stage: str, target: str, new: list[tuple[str, str]]) -> Publication:
        """Write the plan; nothing has moved after that."""
        earlier = sorted(e.base_name for e in files.list_dir(target) if e.type.name == "File")
        found = cls(stage, target, new, earlier)
        files.makedirs(files.join(stage, "_journal"))
        files.write_whole(files.join(stage, "_journal", "plan.json"), json.dumps(asdict(found)).encode())
        return found

    @classmethod
    def read(cls, stage: str) -> Publication | None:
        """The plan of a stage, if it has one. Its own place counts, not the
        one it was written under, so an area may be mounted elsewhere."""
        plan = files.read_whole(files.join(stage, "_journal", "plan.json"))
        if plan is None:
            return None
        told = json.loads(plan)
        return cls(stage, told["target"], [tuple(x) for x in told["new"]], told["earlier"])

    def _mark(self, name: str) -> None:
        files.write_whole(files.join(self.stage, "_journal", name), b"")

    def _marked(self, name: str) -> bool:
        return files.exists(files.join(self.stage, "_journal", name))

    def _aside(self) -> list[tuple[str, str]]:
        return [(files.join(self.target, name), files.join(self.stage, "earlier", name)) for name in self.earlier]

    def _in(self) -> list[tuple[str, str]]:
        return [(files.join(self.stage, part), files.join(self.target, name)) for part, name in self.new]

    def set_aside(self, spark: SparkSession) -> None:
        if not self._marked("aside"):
            files.makedirs(self.target)
            files.makedirs(files.join(self.stage, "earlier"))
            _move(spark, self._aside())
            self._mark("aside")

    def move_in(self, spark: SparkSession) -> None:
        _move(spark, self._in())
        self._mark("published")

    def withdraw(self, spark: SparkSession) -> None:
        """The new files go back to the stage. Before all earlier files were
        aside none had come, and files in the target are earlier ones."""
        self._mark("undo")
        if self._marked("aside") and not self._marked("out"):
            came = [(final, part) for part, final in self._in() if files.exists(final) or not files.exists(part)]
            _move(spark, came)
        self._mark("out")

    def put_back(self, spark: SparkSession) -> None:
        _move(spark, [(kept, place) for place, kept in self._aside() if files.exists(kept) or not files.exists(place)])
        self._mark("undone")

    def finish(self) -> None:
        """Delete the stage, the journal last."""
        files.delete_dir(files.join(self.stage, "earlier"))
        files.delete_dir(self.stage)

    def carry_on(self, spark: SparkSession) -> bool:
        """To the end, in the direction it had; was it published?"""
        undone = self._marked("undo")
        if undone and not self._marked("undone"):
            self.withdraw(spark)
            self.put_back(spark)
        elif not undone and not self._marked("published"):
            self.set_aside(spark)
            self.move_in(spark)
        self.finish()
        return not undone


def publish(spark: SparkSession, stage: str, target: str, new: list[tuple[str, str]]) -> None:
    """Move the staged files ``new`` to their names in ``target``, in place of
    all files there. After an error the target holds its earlier files, or
    ``PublishInterrupted`` says that this is left to ``recover``."""
    run = Publication.planned(stage, target, new)
    try:
        run.set_aside(spark)
        run.move_in(spark)
    except Exception as failed:
        try:
            run.withdraw(spark)
            run.put_back(spark)
        except Exception as stuck:
            raise PublishInterrupted(f"{target} is between two exports; {stage} holds the rest: {stuck}") from failed
        run.finish()
        raise
    run.finish()


def unfinished(root: str, export_name: str) -> dict[str, list[Publication]]:
    """Publications of an export that were begun and not ended, by their
    target's folder date."""
    found: dict[str, list[Publication]] = {}
    for entry in files.list_dir(files.join(root, export_name)):
        if entry.type.name != "Directory" or not STAGE_NAME.fullmatch(entry.base_name):
            continue
        stage = files.join(root, export_name, entry.base_name)
        inner = [files.join(stage, e.base_name) for e in files.list_dir(stage) if e.type.name == "Directory" and "=" in e.base_name]
        for place in [stage, *inner]:
            run = Publication.read(place)
            if run is not None:
                found.setdefault(run.target.rstrip("/").rsplit("/", 1)[-1], []).append(run)
    return found


def recover(spark: SparkSession, root: str, export_name: str, folder_dates: list[str] | None = None) -> dict[str, str]:
    """Carry unfinished publications of an export (of these dates) to their
    end: ``{folder date: "new" or "earlier"}``, whose files the folder has now.
    Not to be called while another run publishes the same date."""
    ended = {}
    for date, runs in sorted(unfinished(root, export_name).items()):
        if folder_dates is None or date in folder_dates:
            for run in runs:
                ended[date] = "new" if run.carry_on(spark) else "earlier"
    return ended
