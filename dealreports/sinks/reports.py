"""Workbooks as folders: ``root/report=<workbook>/sheet=<title>``, each sheet replaced as a whole."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dealreports.sinks.render import render, render_on_one_line


def sheet_path(root: str, workbook: str, title: str) -> str:
    return f"{root.rstrip('/')}/report={folder_name(workbook)}/sheet={folder_name(title)}"


def folder_name(name: str) -> str:
    return name.replace("%", "%25").replace("/", "%2F").replace(":", "%3A")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the number of its rows, told by the same pass that writes it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_sheet(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Creates or replaces one sheet; False if it has no rows. A sheet without rows has its header only."""
    df, seen = _counted(df)
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif fmt == "csv":
        render(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return seen.get["rows"] > 0


def write_report(
    frames: Mapping[str, DataFrame] | Sequence[DataFrame],
    root: str,
    workbook: str,
    titles: Sequence[str] | None = None,
    fmt: str = "parquet",
    skip_empty: bool = False,
) -> dict[str, str]:
    """Several tables as the sheets of one workbook; gives the path of every sheet.

    Either a mapping of titles to tables, or tables and as many ``titles``. With ``skip_empty`` sheets without rows
    are left out of the answer.
    """
    if not isinstance(frames, Mapping):
        if titles is None or len(titles) != len(frames):
            raise ValueError("tables and titles must match in length")
        if len(set(titles)) != len(titles):
            raise ValueError("titles must differ")
        frames = dict(zip(titles, frames))
    if not frames:
        raise ValueError("a report needs at least one table")
    paths = {title: sheet_path(root, workbook, title) for title in frames}
    has_rows = {title: write_sheet(df, paths[title], fmt) for title, df in frames.items()}
    return {title: paths[title] for title in frames if has_rows[title] or not skip_empty}


def write_extract(df: DataFrame, path: str) -> bool:
    """One extract as CSV with header, every cell on one line; False, and the header only, when there are no rows."""
    df, seen = _counted(df)
    render_on_one_line(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return seen.get["rows"] > 0


def write_split(df: DataFrame, root: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """One folder per value of ``by``, in one job.

    Rows are gathered by those values, large groups in several even parts, so that a folder gets few files and
    no task gets a whole group.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in by])
    writer = gathered.write.mode("overwrite").partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(root)


def write_csv(df: DataFrame, path: str) -> None:
    """Plain CSV export with header."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
