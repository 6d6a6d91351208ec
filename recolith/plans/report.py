"""Audit report and delivery package; both are small files made on the driver from finished tables."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

from recolith.operators.validation import is_valid


def markdown(title: str, tables: dict[str, DataFrame]) -> str:
    """A Markdown report with one table for each small result."""
    out = [f"# {title}", ""]
    for name, df in tables.items():
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in df.collect()]
        out.append("")
    return "\n".join(out)


def package(team: str, files: list[str], out: str, report: DataFrame | None = None) -> Path:
    """A zip of local files with a manifest, refused where the validation report holds an error. The name is the
    team's, in lower case with underscores for spaces."""
    if report is not None and not is_valid(report):
        raise ValueError("the output files break the contract")
    path = Path(out) / f"{team.strip().replace(' ', '_').lower()}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, Path(f).name)
        z.writestr("manifest.json", json.dumps({"team": team, "files": {Path(f).name: Path(f).stat().st_size for f in files}}, indent=1))
    return path
