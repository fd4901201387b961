"""Progress manifest (S6 save, S7 load) for resumable runs, on a log of atomic commits.

Progress is a table ``run_id, epoch, step, world_size``.  It lives in a folder of

* ``log/00000000000000000007.json``: one small file a version, which holds a few rows itself or
  names a folder of rows, and the token of who committed it;
* ``data/<name>/``: rows that a Spark job wrote before they were committed.

A version becomes visible in one step and only if nobody else took its number, so of two
writers one comes after the other and neither is lost.  A token is committed once: a job that is
tried again, or a second worker that saves the same step, finds its version there.  Files of a
job that died before its commit are never read.  Loading keeps the latest row of each run.
Model and optimizer tensors are not part of this library.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from samplewright.operators.order import rescale_step

MANIFEST_SCHEMA = "run_id string, epoch int, step long, world_size int"


class CommitLog:
    """Rows of one schema under ``path``, added in atomic commits."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.entry = StructType.fromDDL("version long, token string, folder string").add("rows", ArrayType(self.schema))

    def entries(self) -> DataFrame:
        """``version, token, folder, rows`` of every commit; none where nothing was ever committed."""
        try:
            return self.spark.read.schema(self.entry).json(f"{self.path}/log/*.json")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise  # an outage must not look like an empty log
            return self.spark.createDataFrame([], self.entry)

    def rows(self, version: int | None = None) -> DataFrame:
        """All committed rows, or those of versions up to ``version``."""
        log = self.entries() if version is None else self.entries().filter(F.col("version") <= version)
        out = log.select(F.explode("rows").alias("r")).select("r.*")
        folders = [r["folder"] for r in log.filter("folder is not null").select("folder").collect()]  # one for each job
        if folders:
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders]))
        return out

    def commit(self, rows: DataFrame | list[dict], token: str) -> int:
        """The version that holds ``rows``; if ``token`` was committed before, its version, and nothing is added."""
        entry: dict = {"token": token}
        state = self._state(token)
        if state[1] is not None:
            return state[1]
        if isinstance(rows, DataFrame):
            entry["folder"] = uuid.uuid4().hex
            rows.write.parquet(f"{self.path}/data/{entry['folder']}")
        else:
            entry["rows"] = rows
        while True:
            last, mine = self._state(token)
            if mine is not None:
                return mine
            if self._put(f"{self.path}/log/{last + 1:020d}.json", json.dumps({"version": last + 1, **entry})):
                return last + 1

    def _state(self, token: str) -> tuple[int, int | None]:
        last, mine = self.entries().agg(F.max("version"), F.max(F.when(F.col("token") == token, F.col("version")))).first()
        return (0 if last is None else last), mine

    def _put(self, path: str, text: str) -> bool:
        """Create ``path`` with ``text`` whole, in one step; false if it exists.

        Local folders publish by a hard link.  Other stores publish by a rename that must not
        replace a file, which the store has to do atomically, as streaming checkpoints need too.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        draft = f".{uuid.uuid4().hex}.draft"
        if fs.getScheme() == "file":
            place = target.toUri().getPath()
            made = os.path.join(os.path.dirname(place), draft)
            with open(made, "x", encoding="utf-8") as out:
                out.write(text)
                out.flush()
                os.fsync(out.fileno())
            try:
                os.link(made, place)
            except FileExistsError:
                return False
            finally:
                os.unlink(made)
            return True
        made = jvm.org.apache.hadoop.fs.Path(target.getParent(), draft)
        out = fs.create(made, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(made, target, never)
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
                raise
            fs.delete(made, False)
            return False
        return True


def run_key(weight: str = "full_sft", hidden_size: int = 512, use_moe: bool = False) -> str:
    """Run identifier ``{weight}_{hidden}`` with ``_moe`` appended for expert models."""
    return f"{weight}_{hidden_size}{'_moe' if use_moe else ''}"


def manifest_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, MANIFEST_SCHEMA)


def save_progress(spark: SparkSession, path: str, run_id: str, epoch: int, step: int,
                  world_size: int = 1) -> int:
    """Commit one progress row; saving the same run, epoch and step again adds nothing."""
    row = {"run_id": run_id, "epoch": int(epoch), "step": int(step), "world_size": int(world_size)}
    return manifest_log(spark, path).commit([row], f"{run_id}/{int(epoch)}/{int(step)}")


def save_steps(spark: SparkSession, path: str, steps: DataFrame, token: str) -> int:
    """S6 for a table of progress rows: all of them or none become visible, once for each ``token``."""
    columns = [c.split()[0] for c in MANIFEST_SCHEMA.split(", ")]
    return manifest_log(spark, path).commit(steps.select(*columns), token)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_log(spark, path).rows()


def latest_progress(manifest: DataFrame) -> DataFrame:
    """The latest ``(epoch, step)`` per run with its saved world size."""
    best = F.max_by(F.struct("epoch", "step", "world_size"), F.struct("epoch", "step"))
    return manifest.groupBy("run_id").agg(best.alias("s")).select(
        "run_id", F.col("s.epoch").alias("epoch"), F.col("s.step").alias("step"),
        F.col("s.world_size").alias("world_size"))


def resume_point(latest: DataFrame, current_world_size: int | Column = 1) -> DataFrame:
    """S7 + W6: start ``(epoch, step)`` per run, step rescaled to the current worker count."""
    return latest.select("run_id", "epoch", "step", "world_size",
                         rescale_step(F.col("step"), F.col("world_size"), current_world_size)
                         .alias("start_step"))


def start_for(spark: SparkSession, path: str, run_id: str, current_world_size: int = 1) -> tuple[int, int]:
    """Start ``(epoch, step)`` for one run; ``(0, 0)`` when nothing was saved."""
    m = read_manifest(spark, path).filter(F.col("run_id") == run_id)
    rows = resume_point(latest_progress(m), current_world_size).select("epoch", "start_step").take(1)
    return (int(rows[0][0]), int(rows[0][1])) if rows else (0, 0)
