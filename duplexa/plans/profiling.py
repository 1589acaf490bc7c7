"""Time, rows, spill and memory of a run's steps, as Spark itself measured them, without extra passes over the data."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What is added up over a step's stages: our name, and that of Spark's status store.
SUMMED = {
    "tasks": "numCompleteTasks",
    "task_ms": "executorRunTime",
    "rows_in": "inputRecords",
    "bytes_in": "inputBytes",
    "rows_out": "outputRecords",
    "bytes_out": "outputBytes",
    "shuffled_rows": "shuffleWriteRecords",
    "shuffled_bytes": "shuffleWriteBytes",
    "memory_spilled": "memoryBytesSpilled",
    "disk_spilled": "diskBytesSpilled",
}


@dataclass
class Profile:
    """``step`` times what runs inside it; ``rows`` counts what flows past while an action runs.

    With a session, a step's jobs carry a tag of their own, by which their stages are found
    in Spark's status store afterwards: tasks, their time, rows and bytes read, shuffled
    and written, spill, and the largest peaks of a stage's execution memory and of an
    executor's heap. Steps may run in several threads; a step within a step counts for both.
    """

    spark: SparkSession | None = None
    seconds: dict[str, float] = field(default_factory=dict)
    watched: dict[str, Observation] = field(default_factory=dict)
    stages: dict[str, dict[str, int]] = field(default_factory=dict)

    @contextmanager
    def step(self, name: str):
        tag = f"duplexa-{uuid.uuid4().hex}"
        began = time.perf_counter()
        if self.spark:
            self.spark.sparkContext.addJobTag(tag)
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - began
            if self.spark:
                self.spark.sparkContext.removeJobTag(tag)
                self._add(name, tag)

    def _add(self, name: str, tag: str) -> None:
        sc = self.spark.sparkContext._jsc.sc()
        # What ended is told to the store by a queue.
        sc.listenerBus().waitUntilEmpty(10_000)
        store, found = sc.statusStore(), set()
        into = self.stages.setdefault(name, dict.fromkeys([*SUMMED, "jobs", "stages", "execution_memory", "heap", "forgotten"], 0))
        for job in sc.statusTracker().getJobIdsForTag(tag):
            into["jobs"] += 1
            ids = store.job(job).stageIds()
            found.update(ids.apply(n) for n in range(ids.size()))
        for stage in found:
            try:
                data = store.lastStageAttempt(stage)
            except Py4JJavaError:
                # The store keeps the latest stages only (spark.ui.retainedStages).
                into["forgotten"] += 1
                continue
            if data.status().toString() == "SKIPPED":
                continue
            into["stages"] += 1
            for ours, theirs in SUMMED.items():
                into[ours] += getattr(data, theirs)()
            into["execution_memory"] = max(into["execution_memory"], data.peakExecutionMemory())
            peaks = data.peakExecutorMetrics()
            if peaks.isDefined():
                into["heap"] = max(into["heap"], peaks.get().getMetricValue("JVMHeapMemory"))

    def rows(self, name: str, frame: DataFrame) -> DataFrame:
        seen = self.watched[name] = Observation(name)
        return frame.observe(seen, F.count(F.lit(1)).alias("rows"))

    def as_dict(self) -> dict:
        """Counts are there once an action has run over the watched frames."""
        return {"seconds": dict(self.seconds), "rows": {n: o.get["rows"] for n, o in self.watched.items()}, "stages": {n: dict(s) for n, s in self.stages.items()}}

    def table(self) -> str:
        total = sum(self.seconds.values()) or 1.0
        lines = []
        for name, seconds in self.seconds.items():
            line = f"{name:<24}{seconds:>10.3f} s{100 * seconds / total:>7.1f} %"
            if s := self.stages.get(name):
                line += f"{s['tasks']:>8} tasks{s['rows_in']:>14} rows in{s['rows_out']:>14} out{s['shuffled_bytes'] / 1e6:>10.1f} MB shuffled"
                line += f"{s['disk_spilled'] / 1e6:>10.1f} MB spilled{s['execution_memory'] / 1e6:>10.1f} MB memory{s['heap'] / 1e6:>10.1f} MB heap"
            lines.append(line)
        return "\n".join(lines)
