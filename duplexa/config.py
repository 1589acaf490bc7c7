"""Run descriptions in YAML or JSON."""

from __future__ import annotations

import inspect
import json
from pathlib import Path

from duplexa import api

PATHS = {"predictions_file", "sirna_fasta", "target_fasta", "gtf_file", "accessibility_dir", "genome_file", "on_target_predictions", "on_target_file", "query_file", "target_index", "on_target_accessibility", "on_target_ids_file", "genome", "output", "output_file"}
CALLS = {"off-targets": api.off_targets, "accessibility": api.accessibility}
OUTPUT = {"output_file": None, "output_format": "tsv", "summary_only": False, "legacy_format": False, "detailed_report": False, "profile": False}

# Keys of descriptions with a section for each command, and the parameters they stand for.
SECTIONS = {"off-targets": "off_targets", "accessibility": "accessibility"}
FOLD_KEYS = {"window": "window_size", "span": "max_span", "unpaired": "unpaired_prob"}
KEYS = {
    "off-targets": {
        "risearch_file": "predictions_file",
        "transcriptome": "gtf_file",
        "feature": "feature_type",
        "output": "output_file",
        "fasta": "genome_file",
        "on_target": "on_target_file",
        "on_target_risearch_file": "on_target_predictions",
        "query": "query_file",
        "type": "predictions_type",
        **FOLD_KEYS,
    },
    "accessibility": {"fasta": "genome", **FOLD_KEYS},
}
NEEDED = {"off-targets": ["risearch_file"], "accessibility": ["fasta", "output"]}
#: Parameters that are text even where YAML reads a number.
TEXTS = {"alpha", "gamma", "theta"}


def _section(path: str, data: dict, command: str) -> dict:
    """The command's own section under our parameters' names; the other section and ``verbose`` are left alone."""
    if extra := sorted(set(data) - set(SECTIONS.values()) - {"verbose"}):
        raise ValueError(f"{path}: unknown {', '.join(extra)}")
    own = dict(data.get(SECTIONS[command]) or {})
    own.pop("verbose", None)
    if missing := [k for k in NEEDED[command] if own.get(k) is None]:
        raise ValueError(f"{path}: {SECTIONS[command]} needs {', '.join(missing)}")
    return {KEYS[command].get(k, k): v for k, v in own.items() if v is not None}


def load(path: str) -> tuple[str, dict]:
    """(command, parameters): command is off-targets or accessibility; relative paths are meant from the file's folder.

    Parameters stand beside ``command`` under the names that the calls have, or in a
    section of the command's name (off_targets, accessibility), with its keys.
    """
    text = Path(path).read_text()
    if path.endswith(".json"):
        data = json.loads(text)
    else:
        import yaml

        data = yaml.safe_load(text)
    if not isinstance(data, dict) or "command" not in data:
        raise ValueError(f"{path}: a run needs a command")
    command = data.pop("command")
    if command not in CALLS:
        raise ValueError(f"{path}: unknown command {command!r}; it is off-targets or accessibility")
    if set(data) & set(SECTIONS.values()):
        data = _section(path, data, command)
    known = set(inspect.signature(CALLS[command]).parameters) - {"spark"} | (set(OUTPUT) if command == "off-targets" else set())
    if extra := sorted(set(data) - known):
        raise ValueError(f"{path}: unknown {', '.join(extra)}")
    base = Path(path).resolve().parent
    for key in PATHS & set(data):
        if data[key] and "://" not in str(data[key]):
            data[key] = str((base / data[key]).resolve())
    for key in TEXTS & set(data):
        data[key] = str(data[key])
    return command, data
