"""Writers of site tables and per-siRNA summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.functions.parameters import Config
from duplexa.shipping import ship

# The lines of summaries and of the older report.
HEAD = "# On-target info for {sirna_id} #"
TAIL = "## End of on-target info ##"
CONFIG = "# For {title}; "
DETAIL_HEAD, DETAIL_NAMES, DETAIL_TAIL = "# Off-target info#", ["# ID1", "ID2"], "## End of off-target info"

FLOATS = ("energy", "exp_value", "opening_energy", "dG_total")


def compact(sites: DataFrame) -> DataFrame:
    """Places as 32-bit integers and energies as 32-bit floats; ids are left to Parquet's dictionaries."""
    kinds = dict(sites.dtypes)
    place = {c: F.col(c).cast("int") for c in ("start", "end") if kinds.get(c) == "bigint"}
    number = {c: F.col(f"`{c}`").cast("float") for c, kind in kinds.items() if kind == "double" and (c in FLOATS or c.startswith("P_off_target"))}
    return sites.withColumns(place | number)


def without_intermediates(sites: DataFrame) -> DataFrame:
    return sites.drop(*(c for c in sites.columns if c == "E_min" or c.startswith(("boltzmann_weight", "Z_sirna"))))


def write_sites(sites: DataFrame, path: str, kind: str = "tsv", ranked: bool = False) -> None:
    """tsv, csv or parquet in a folder of part files; ranked: by probability, over all parts in order."""
    if kind not in ("tsv", "csv", "parquet"):
        raise ValueError(f"output is tsv, csv or parquet, not {kind!r}")
    if ranked:
        sites = sites.orderBy(F.desc_nulls_first("P_off_target"), "sirna_id", "chrom", "start")
    if kind == "parquet":
        compact(sites).write.mode("overwrite").parquet(path)
    else:
        sites.write.mode("overwrite").option("header", "true").csv(path, sep="\t" if kind == "tsv" else ",")


def summary_text(sirna_id: str, sums: dict, configs: list[Config]) -> str:
    """One siRNA's summary file: a line for each config with P, Z and Zoff, with and without opening energy."""
    lines = [HEAD.format(sirna_id=sirna_id)]
    for c in configs:
        shown = []
        values = {}
        for mark in ("", "_noacc"):
            z, w = sums.get(f"Z_sirna{mark}{c.suffix}") or 0.0, sums.get(f"W_on{mark}{c.suffix}") or 0.0
            values |= {f"P{mark}": w / z if z > 0 else 0.0, f"Z{mark}": z, f"Zoff{mark}": z - w}
        for name in ("P", "Z", "Zoff"):
            shown += [f"{name}{mark}: {values[name + mark]!s}" for mark in ("", "_noacc")]
        lines.append(CONFIG.format(title=c.title) + "; ".join(shown))
    return "\n".join([*lines, TAIL + "\n"])


def summaries(sums: DataFrame, configs: list[Config]) -> Iterator[tuple[str, str]]:
    """(siRNA, text) one after the other; sums are a row a siRNA and come partition by partition."""
    for row in sums.toLocalIterator():
        yield row["sirna_id"], summary_text(row["sirna_id"], row.asDict(), configs)


def write_summaries(sums: DataFrame, configs: list[Config], path: str) -> None:
    """Every siRNA's summary as a text file of its own, in a folder sirna_id=ID under ``path``.

    Sums are a row a siRNA, so each folder gets one file. Executors render and write them
    with Spark's text writer; a failed run leaves none. Ids are escaped as Spark escapes names of folders.
    """
    ship(sums.sparkSession)
    fields = sums.columns

    def render(batches):
        for batch in batches:
            rows = [dict(zip(fields, row)) for row in zip(*(column.to_pylist() for column in batch.columns))]
            # The writer ends the last line.
            texts = [summary_text(r["sirna_id"], r, configs).removesuffix("\n") for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([str(r["sirna_id"]) for r in rows], pa.string()), pa.array(texts, pa.string())], ["sirna_id", "value"])

    # Names with points in them do not pass as they are.
    named = sums.where(F.col("sirna_id").isNotNull()).toDF(*(f"c{n}" for n in range(len(fields))))
    named.mapInArrow(render, "sirna_id string, value string").write.mode("overwrite").partitionBy("sirna_id").text(path)


def write_lines(spark: SparkSession, lines: Iterator[str], path: str) -> None:
    """Lines into one text file, through Spark's file systems, as they come."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        for line in lines:
            out.write(bytearray((line + "\n").encode()))
    finally:
        out.close()


def print_rows(rows: DataFrame) -> None:
    """All rows to standard output, tab-separated under their names, partition by partition."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def legacy_report(sirna_id: str, probabilities: DataFrame, totals: DataFrame, configs: list[Config], detailed: bool = False) -> Iterator[str]:
    """Lines of the older report: on-target chances for each config, then transcripts by chromosome and id.

    The field Z holds the on-target's weight.
    """
    row = totals.first().asDict()
    yield HEAD.format(sirna_id=sirna_id)
    for c in configs:
        parts = {}
        for mark in ("", "_noacc"):
            on, off = row[f"W_on{mark}{c.suffix}"], row[f"Zoff{mark}{c.suffix}"]
            z = on + off
            parts |= {f"Pon{mark}": on / z if z > 0 else 0.0, f"Poff{mark}": off / z if z > 0 else 0.0, f"Z{mark}": on, f"Zoff{mark}": off}
        names = [f"{n}{m}" for n in ("Pon", "Poff", "Z", "Zoff") for m in ("", "_noacc")]
        yield CONFIG.format(title=f"alpha={c.alpha} and gamma={c.gamma}") + "; ".join(f"{n}: {parts[n]:.12g}" for n in names)
    yield TAIL
    if detailed:
        yield DETAIL_HEAD
        yield "\t".join([*DETAIL_NAMES, *(f"alpha:{c.alpha},gamma:{c.gamma}{m}" for c in configs for m in ("", "(NoAcc)"))])
        for r in probabilities.orderBy("chrom", "transcript_id").toLocalIterator():
            values = [r[f"P{m}{c.suffix}"] or 0.0 for c in configs for m in ("", "_noacc")]
            yield "\t".join([str(r["chrom"]), str(r["transcript_id"]), *(f"{v:.12g}" for v in values)])
        yield DETAIL_TAIL
