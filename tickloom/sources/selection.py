"""Which files a run reads: partition trees of normalised tables, run-scoped leaves, vendor files by date."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


@dataclass(frozen=True)
class Selection:
    """Chosen part files; ``layout`` is run-scoped, legacy, ambiguous or missing."""

    ok: bool
    layout: str
    files: tuple[str, ...] = ()
    runs: tuple[str, ...] = field(default=())


def select_silver(root: str | Path, symbol: str, date: str, run_id: str | None = None) -> Selection:
    """Files of one symbol and date.

    With a run only that run's leaf counts.  Without one a single run, or plain files, are taken; several runs, or
    runs beside plain files, are ambiguous and never mixed.  No files at all is not an error.
    """
    day = Path(root) / f"symbol={symbol}" / f"date={date}"
    parts = lambda folder: tuple(str(p) for p in sorted(folder.glob("part-*.parquet")))
    leaves = {p.name.removeprefix("run_id="): parts(p) for p in sorted(day.glob("run_id=*")) if p.is_dir()}
    leaves = {k: v for k, v in leaves.items() if v}
    plain = parts(day)
    if run_id is not None:
        return Selection(True, "run-scoped", leaves[run_id], (run_id,)) if run_id in leaves else Selection(True, "missing")
    if len(leaves) > 1 or (leaves and plain):
        return Selection(False, "ambiguous", runs=tuple(leaves))
    if leaves:
        (run, files), = leaves.items()
        return Selection(True, "run-scoped", files, (run,))
    return Selection(True, "legacy", plain) if plain else Selection(True, "missing")


def read_selection(spark: SparkSession, root: str | Path, selection: Selection) -> DataFrame:
    if not selection.files:
        raise FileNotFoundError(f"no files selected under {root}")
    return spark.read.option("basePath", str(root)).parquet(*selection.files)


def vendor_files(root: str | Path, date: str | None = None, legacy_root: bool = False) -> list[str]:
    """With a date, files of ``date=D`` (and, if asked, of the root); files of another date are rejected."""
    root = Path(root)
    if date is None:
        return [str(p) for p in sorted(root.rglob("*.parquet"))]
    found = sorted((root / f"date={date}").glob("*.parquet")) + (sorted(root.glob("*.parquet")) if legacy_root else [])
    for p in found:
        if any(d != date for d in _DATE.findall(p.name)):
            raise ValueError(f"{p.name} is of another date than {date}")
    return [str(p) for p in found]


def dates(root: str | Path, symbol: str) -> list[str]:
    """Dates that have at least one part file."""
    return sorted(p.name.removeprefix("date=") for p in (Path(root) / f"symbol={symbol}").glob("date=*") if any(p.rglob("part-*.parquet")))


def symbols(root: str | Path) -> list[str]:
    return sorted(p.name.removeprefix("symbol=") for p in Path(root).glob("symbol=*") if p.is_dir())
