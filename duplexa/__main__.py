"""Command line: python -m duplexa off-targets | accessibility | index | prepare | search | -c FILE."""

from __future__ import annotations

import argparse
import inspect
import sys
from pathlib import PurePath

from pyspark.sql import SparkSession

from duplexa import __version__, api, config
from duplexa.functions.parameters import DEFAULT_TEMPERATURE, Config
from duplexa.operators import scoring
from duplexa.plans import reports
from duplexa.plans.profiling import Profile

CALLS = {"off-targets": api.off_targets, "accessibility": api.accessibility, "index": api.index, "prepare": api.prepare, "search": api.search}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("duplexa")
    top.add_argument("--version", action="version", version=__version__)
    top.add_argument("-c", "--config", help="a run description in YAML or JSON")
    commands = top.add_subparsers(dest="command")
    for name, call in CALLS.items():
        sub = commands.add_parser(name, help=(call.__doc__ or "").splitlines()[0])
        for p in list(inspect.signature(call).parameters.values())[1:]:
            flag = "--" + p.name.replace("_", "-")
            if isinstance(p.default, bool):
                sub.add_argument(flag, dest=p.name, action=argparse.BooleanOptionalAction, default=p.default)
            else:
                kind = type(p.default) if isinstance(p.default, (int, float)) else str
                required = p.default is inspect.Parameter.empty
                sub.add_argument(flag, dest=p.name, type=str if p.name == "seed_length" else kind, required=required, default=None if required else p.default)
        if name in ("off-targets", "search"):
            sub.add_argument("--output-file")
            sub.add_argument("--output-format", choices=("tsv", "csv", "parquet"), default="tsv")
        if name == "off-targets":
            sub.add_argument("--summary-only", action="store_true")
            sub.add_argument("--legacy-format", action="store_true", help="print the older report of all sites together")
            sub.add_argument("--detailed-report", action="store_true", help="with every transcript in the older report")
            sub.add_argument("--profile", action="store_true", help="print time, rows, spill and memory of each step")
    return top


def run(spark: SparkSession, command: str, given: dict) -> None:
    out, kind, only = given.pop("output_file", None), given.pop("output_format", "tsv"), given.pop("summary_only", False)
    legacy, detailed, timed = (given.pop(name, False) for name in ("legacy_format", "detailed_report", "profile"))
    profile = Profile(spark if timed else None)
    with profile.step("plan"):
        result = CALLS[command](spark, **given)
    if command == "off-targets":
        if legacy or detailed:
            configs, on = [Config(), Config(0.8, 0.8)], result.on_target or {"energy": 0.0, "opening_energy": 0.0, "expression": 1000.0}
            by, totals = scoring.transcript_probabilities(
                result.matched, configs, on["energy"], on["opening_energy"], on["expression"], given.get("temperature", DEFAULT_TEMPERATURE)
            )
            name = PurePath(given["query_file"]).stem if given.get("query_file") else "siRNA"
            lines = reports.legacy_report(name, by, totals, configs, detailed)
            if out:
                reports.write_lines(spark, lines, out + ".results")
                reports.write_sites(reports.without_intermediates(result.sites), out + ".detailed_results", "tsv")
            else:
                for line in lines:
                    print(line)
        elif not out:
            with profile.step("sites"):
                scoring.top_sites(result.sites).show(10, truncate=False)
        else:
            if not only:
                with profile.step("sites"):
                    reports.write_sites(reports.without_intermediates(result.sites), out, kind, ranked=kind != "parquet")
            with profile.step("summaries"):
                reports.write_summaries(result.sums, result.configs, out + ".summaries")
        if timed:
            print(profile.table())
    elif command == "search":
        reports.write_sites(result, out, kind) if out else reports.print_rows(result)
    elif command in ("index", "prepare"):
        print(result)
    else:
        result.show(20, truncate=False)


def main(argv: list[str] | None = None) -> int:
    options = vars(parser().parse_args(argv))
    path, command = options.pop("config"), options.pop("command")
    if path:
        command, options = config.load(path)
    if not command:
        parser().print_help()
        return 2
    spark = SparkSession.builder.appName("duplexa").getOrCreate()
    try:
        run(spark, command, options)
    except (ValueError, FileNotFoundError) as error:
        print(f"duplexa: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
