"""Session settings and staged tables."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamp text and local dates are computed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Without the setting, the checkpoint folder of the context is used. Only with a local master,
    where there is no other machine, one is made if there is none.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="levelscope-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: Spark's setting to delete the shuffle files of a query at its end, not some time later.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[str]] = []


def stage(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage, survives lost executors and, being Parquet, lets every later step read only
    the columns it needs. Shuffle files of the write, which is not run again, are freed with it. Within
    :func:`scratch` the folder is deleted at its end, or at that of the next outer one if it ``outlives``
    this one; else it belongs to the cluster's scratch space and its expiry.
    """
    spark = df.sparkSession
    run = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/levelscope/{run}/{label}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if outlives else _scopes
    if scopes:
        scopes[-1].append(path)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, label: str, column: str, buckets: int, dealt: bool = False) -> DataFrame:
    """As :func:`stage`, in buckets by a column: folds and joins on it need no shuffle afterwards.

    The rows are shuffled once for it, unless they are ``dealt`` by the column already; no value should have a great part
    of them. Spark knows buckets only of tables, so the written files are a table of this session's catalog too, within
    :func:`scratch` until its end.
    """
    spark = df.sparkSession
    name = f"levelscope_{label}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/levelscope/{spark.sparkContext.applicationId}/{name}"
    if _scopes:
        _scopes[-1].append(path)
    if dealt:
        writer = df.write.bucketBy(buckets, column)
    else:
        writer = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = file_system(spark, path)
    return system.exists(place)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables staged within, whether the work succeeds or not."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)
            name = path.rsplit("/", 1)[1]
            if name.startswith("levelscope_"):
                spark.sql(f"DROP TABLE IF EXISTS {name}")


COMPLETE = "_COMPLETE"
CLAIMS = "_owner"


def run_key(settings: dict) -> str:
    """A name for runs of the same job: equal settings, equal name."""
    text = json.dumps(settings, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


class _Outputs:
    """The claims of runs on a folder of outputs, kept as small files in it.

    Each attempt of a run has a claim of its own, ``<run>-<attempt>.open``, which nobody else ever writes. It
    may go on only if there is no other open claim when it lists them after writing its own: of two
    attempts at the same time each sees the other's or comes first, so that never both go on. A
    claim whose work failed is renamed ``.broken``, one whose work ended ``.done``.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.root, self.run = root, run
        self.system, self.place = file_system(spark, root)
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.name = f"{run}-{uuid.uuid4().hex}"
        self.changed = False  # what was finished before
        self.holder = f"{spark.sparkContext.applicationId} {datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S} UTC"

    def _at(self, *parts: str):
        return self.path("/".join((self.root, *parts)))

    def _names(self, place) -> set[str]:
        if not self.system.exists(place):
            return set()
        return {status.getPath().getName() for status in self.system.listStatus(place)}

    def write_new(self, *parts: str) -> None:
        """A small file that must not exist yet."""
        out = self.system.create(self._at(*parts), False)
        try:
            out.write(bytearray(f"{self.run} {self.holder}\n".encode()))
        finally:
            out.close()

    def claimed_by(self, name: str) -> str:
        stream = self.system.open(self._at(CLAIMS, name))
        try:
            return bytes(stream.readNBytes(1000)).decode(errors="replace").strip()
        finally:
            stream.close()

    def close(self, state: str) -> None:
        self.system.rename(self._at(CLAIMS, f"{self.name}.open"), self._at(CLAIMS, f"{self.name}.{state}"))

    def withdraw(self) -> None:
        """Takes the claim back, and the folders if they hold nothing else."""
        self.system.delete(self._at(CLAIMS, f"{self.name}.open"), False)
        with suppress(Py4JJavaError):  # another attempt may use or remove them meanwhile
            for folder in (self._at(CLAIMS), self.place):
                if not self.system.listStatus(folder):
                    self.system.delete(folder, False)

    def claim(self, take_over: bool) -> bool:
        """Takes the folder or raises; whether there is an earlier attempt of the same run to go on from."""
        if COMPLETE in self._names(self.place):
            raise ValueError(f"{self.root} already exists and is complete")
        try:
            self.write_new(CLAIMS, f"{self.name}.open")
            others = self._names(self._at(CLAIMS)) - {f"{self.name}.open"}
            ours = {name for name in others if name.startswith(f"{self.run}-")}
            for name in sorted(others):
                if name.endswith(".open") and not (take_over and name in ours):
                    raise ValueError(
                        f"{self.root} is being written by another run ({self.claimed_by(name)}); "
                        "if that has died, start this one with take_over"
                    )
                if name not in ours:
                    raise ValueError(f"{self.root} holds outputs of another run ({self.claimed_by(name)})")
            found = self._names(self.place) - {CLAIMS}
            if COMPLETE in found:
                raise ValueError(f"{self.root} already exists and is complete")
            if found and not ours:
                raise ValueError(f"{self.root} already exists and was not written by this job: {sorted(found)}")
        except Py4JJavaError as error:  # a claim went while it was looked at
            self.withdraw()
            raise ValueError(f"{self.root} is being written by another run") from error
        except Exception:
            self.withdraw()
            raise
        for name in ours:  # their attempts are over
            self.system.delete(self._at(CLAIMS, name), False)
        return bool(ours)


    def claim_again(self, take_over: bool) -> None:
        """Takes a finished folder to change it, or one on which the same run has failed, or raises."""
        try:
            self.write_new(CLAIMS, f"{self.name}.open")
            others = self._names(self._at(CLAIMS)) - {f"{self.name}.open"}
            ours = {name for name in others if name.startswith(f"{self.run}-")}
            for name in sorted(others):
                if name.endswith(".open") and not (take_over and name in ours):
                    raise ValueError(f"{self.root} is being written by another run ({self.claimed_by(name)})")
                if name.endswith(".broken") and name not in ours:
                    raise ValueError(f"a run on {self.root} has failed and must be finished: {self.claimed_by(name)}")
                if name.endswith(".done") and name in ours:
                    raise ValueError(f"{self.root} has these changes already")
            if COMPLETE not in self._names(self.place) and not ours:
                raise ValueError(f"{self.root} is not complete")
        except Py4JJavaError as error:
            self.withdraw()
            raise ValueError(f"{self.root} is being written by another run") from error
        except Exception:
            self.withdraw()
            raise
        self.changed = bool(ours)
        for name in ours:
            self.system.delete(self._at(CLAIMS, name), False)

    def incomplete(self) -> None:
        self.changed = True
        self.system.delete(self._at(COMPLETE), False)


@contextmanager
def amended(
    spark: SparkSession, root: str, run: str, take_over: bool = False
) -> Iterator[_Outputs]:
    """A change of finished outputs below ``root``, by one run at a time, and once by each run.

    While the outputs are changed (from ``incomplete()`` on) their marker is away. A run that fails then
    must be started again, before any other one, and must be able to do its changes twice; one that fails
    earlier has changed nothing.
    """
    outputs = _Outputs(spark, root, run)
    outputs.claim_again(take_over)
    try:
        yield outputs
        if not exists(spark, f"{root}/{COMPLETE}"):
            outputs.write_new(COMPLETE)
    except BaseException:
        if outputs.changed:
            outputs.close("broken")
        else:
            outputs.withdraw()
        raise
    outputs.close("done")


@contextmanager
def published(
    spark: SparkSession, root: str, run: str = "", take_over: bool = False
) -> Iterator[str]:
    """Several outputs below ``root`` that count only together.

    Yields the write mode. The folder must be new or left by a failed attempt of the same ``run`` (see
    :func:`run_key`), whose outputs are written over; a finished one, known by its marker, anything that
    this job has not written, and the outputs of another run are refused and stay as they are. So is a
    folder on which an attempt is at work. An attempt that was killed looks the same: ``take_over`` goes on
    from it, if the run is the same one.
    """
    outputs = _Outputs(spark, root, run or run_key({"root": root}))
    again = outputs.claim(take_over)
    try:
        yield "overwrite" if again else "errorifexists"
        outputs.write_new(COMPLETE)
    except BaseException:
        outputs.close("broken")
        raise
    outputs.close("done")
