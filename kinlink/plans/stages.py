"""A ledger of the stages of a job, so that a job whose driver was lost goes on where it stopped."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from kinlink.sources.digest import fingerprint
from kinlink.sources.tables import path_exists
from kinlink.storage import materialize, shared_dir

Build = Callable[[], DataFrame]


def once(make: Callable) -> Callable:
    """``make``, called by whichever thread is first."""
    lock, made = Lock(), []

    def get():
        with lock:
            if not made:
                made.append(make())
            return made[0]

    return get


@dataclass(frozen=True)
class StageDone:
    """``reused`` if the stage's table was there already."""

    name: str
    key: str
    reused: bool


class Stages:
    """Runs a job's stages in turn and keeps the table of each.

    Without a folder the tables are intermediates of the application. With one, a stage's table lies under its name and a
    key made of the key of the stage before it and the settings it depends on; the first key is that of the job's inputs.
    A stage whose table is complete is read and not built again, so a second run repeats only what the first did not
    finish, and changed settings only what depends on them. A table counts as complete once Spark has marked it so; one
    that was cut off is written anew.
    """

    def __init__(self, spark: SparkSession, store: str | None = None, inputs: Callable[[], str] = str):
        self.done: list[StageDone] = []
        self._spark, self._store = spark, store
        self._key = inputs() if store else ""

    def run(self, name: str, build: Build, settings=None) -> DataFrame:
        return self.run_all((name, build, settings))[0]

    def run_all(self, *stages: tuple[str, Build, object]) -> list[DataFrame]:
        """Stages that do not depend on each other; those to be built are built at the same time."""
        if not self._store:
            shared_dir(self._spark)
            return self._together([lambda n=name, b=build: materialize(b(), n) for name, build, _ in stages])
        before, work = self._key, []
        for name, build, settings in stages:
            key = fingerprint(before, name, settings)
            place = f"{self._store}/{name}/{key}"
            there = path_exists(self._spark, f"{place}/_SUCCESS")
            self.done.append(StageDone(name, key, there))
            work.append(lambda place=place, build=build, there=there: self._kept(place, None if there else build))
            self._key = fingerprint(self._key, key)
        return self._together(work)

    def _kept(self, place: str, build: Build | None) -> DataFrame:
        if build:
            build().write.mode("overwrite").parquet(place)
        return self._spark.read.parquet(place)

    def _together(self, work: list[Callable[[], DataFrame]]) -> list[DataFrame]:
        if len(work) == 1:
            return [work[0]()]
        with ThreadPoolExecutor(len(work)) as pool:
            return [f.result() for f in [pool.submit(inheritable_thread_target(self._spark)(w)) for w in work]]
