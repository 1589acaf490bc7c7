"""A whole run: index and accessibility once, then off-targets for every transcriptome; jobs of a wave side by side."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from duplexa import api
from duplexa.plans import reports
from duplexa.sources import files

LOG = logging.getLogger("duplexa.orchestration")


@dataclass
class Job:
    name: str
    run: Callable[[SparkSession], None]
    after: list[str] = field(default_factory=list)
    #: The folder that is written last, by which a resumed run knows that the job is done.
    output: str | None = None


def plan(
    sirnas: str, genome: str, transcriptomes: dict[str, str], output: str, accessibility: bool = True, window_size: int = 80, max_span: int = 40, unpaired_prob: int = 30, **scoring
) -> list[Job]:
    """Jobs in order: index, search, accessibility, and one scoring job for each named annotation."""
    index, sites, profiles = f"{output}/index", f"{output}/sites", f"{output}/accessibility"

    def find(spark):
        api.search(spark, sirnas, index=index).write.mode("overwrite").parquet(sites)

    def score(name, annotation):
        def run(spark):
            result = api.off_targets(spark, sites, gtf_file=annotation, accessibility_dir=profiles if accessibility else None, **scoring)
            reports.write_sites(reports.without_intermediates(result.sites), f"{output}/{name}/sites", "parquet")
            reports.write_summaries(result.sums, result.configs, f"{output}/{name}/summaries")

        return run

    jobs = [Job("index", lambda spark: api.index(spark, genome, index), output=f"{index}/facts"), Job("search", find, ["index"], sites)]
    if accessibility:
        fold = lambda spark: api.accessibility(spark, genome, window_size, max_span, unpaired_prob, output=profiles)
        jobs.append(Job("accessibility", fold, output=profiles))
    before = ["search", "accessibility"] if accessibility else ["search"]
    return jobs + [Job(f"off-targets:{name}", score(name, path), before, f"{output}/{name}/summaries") for name, path in transcriptomes.items()]


def waves(jobs: list[Job]) -> list[list[str]]:
    """Names of jobs that may run side by side, wave after wave; raises ValueError on a circle or an unknown name."""
    done: set[str] = set()
    out = []
    left = {j.name: set(j.after) for j in jobs}
    if missing := {a for after in left.values() for a in after} - set(left):
        raise ValueError(f"no such job: {', '.join(sorted(missing))}")
    while left:
        ready = sorted(n for n, after in left.items() if after <= done)
        if not ready:
            raise ValueError(f"jobs wait for each other: {', '.join(sorted(left))}")
        out.append(ready)
        done |= set(ready)
        left = {n: a for n, a in left.items() if n not in done}
    return out


def execute(spark: SparkSession, jobs: list[Job], dry_run: bool = False, side_by_side: int = 4, resume: bool = False) -> list[str]:
    """Runs the jobs wave by wave and returns the order; a failure stops the run after its wave.

    Jobs of a wave run side by side, ``side_by_side`` at most, each a distributed job of its
    own under a tag of its name, in a scheduler pool of its own where the session schedules
    fairly. With ``resume`` jobs are left out whose ``output`` a writer has finished, so a
    run that was stopped goes on where it ended; give it only for unchanged input.
    """
    by = {j.name: j for j in jobs}
    plan = waves(jobs)
    order = [name for wave in plan for name in wave]
    if dry_run:
        return order
    for wave in plan:
        left = [name for name in wave if not (resume and by[name].output and files.exists(spark, f"{by[name].output}/_SUCCESS"))]
        LOG.info("running %s; done before: %s", ", ".join(left) or "nothing", ", ".join(n for n in wave if n not in left) or "nothing")
        with ThreadPoolExecutor(max(1, side_by_side)) as pool:
            running = [pool.submit(_run_one, spark, by[name]) for name in left]
        for done in running:
            done.result()
    return order


def _run_one(spark: SparkSession, job: Job) -> None:
    context, tag = spark.sparkContext, "duplexa-" + "".join(c if c.isalnum() else "-" for c in job.name)
    context.addJobTag(tag)
    context.setLocalProperty("spark.scheduler.pool", tag)
    try:
        job.run(spark)
    finally:
        context.removeJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", None)
