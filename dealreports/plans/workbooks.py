"""The scheduled runs: flatten once, then write every workbook from the flat table."""

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from dealreports import fixed
from dealreports.functions.attributes import FlatSpec, flatten
from dealreports.plans import daily, extracts, kpis, payroll, staging
from dealreports.sinks import manifest
from dealreports.sinks.render import render_on_one_line
from dealreports.sinks.reports import sheet_path, write_report, write_sheet, write_split
from dealreports.sources.tables import read_properties

# Every attribute that some report reads.
ALL_ATTRIBUTES = FlatSpec(
    keys=fixed.ATTRIBUTE_KEYS,
    keys_last=["contract_status", "closing_date", "contract_client_type"],
    labels=fixed.ALL_LABELS,
    labels_last=list(dict.fromkeys([*fixed.TRANSACTION_LABELS, *fixed.AGENT_LABELS])),
    key_dates=[k for k in fixed.ATTRIBUTE_KEYS if k not in ("contract_status", "contract_client_type")],
)


def write_flat(spark: SparkSession, properties: str, out: str, spec: FlatSpec = ALL_ATTRIBUTES) -> DataFrame:
    """The only pass over the JSON; gives the written flat table."""
    flat = flatten(read_properties(spark, properties), spec)
    flat.write.mode("overwrite").parquet(out)
    return spark.read.schema(flat.schema).parquet(out)


def write_monthly_counts(
    flat: DataFrame, root: str, as_of: datetime, teams: Mapping[str, Sequence[str]], fmt: str = "csv"
) -> dict[str, str]:
    wide = kpis.kpis_wide(kpis.monthly_kpis(flat, as_of, teams), as_of).drop("kpi")
    return write_report({"Overview": wide}, root, "monthly_counts", fmt=fmt)


def write_payroll(
    flat: DataFrame,
    root: str,
    coordinators: Sequence[str] = tuple(fixed.PAYROLL_COORDINATORS),
    labels: Sequence[str] = tuple(fixed.TRANSACTION_LABELS),
) -> dict[str, str]:
    """The transactions are written first; both matrices read the written sheet."""
    path = sheet_path(root, "payroll", "transaction_data")
    enriched = payroll.enrich(flat, labels=labels)
    write_sheet(enriched, path)
    enriched = flat.sparkSession.read.schema(enriched.schema).parquet(path)
    matrices = {
        "projected": payroll.payroll_matrix(enriched, "p", coordinators),
        "actual": payroll.payroll_matrix(enriched, "a", coordinators),
    }
    return {"transaction_data": path, **write_report(matrices, root, "payroll")}


def write_staging(flat: DataFrame, root: str, lists: staging.Lists = staging.Lists()) -> dict[str, str]:
    """The accounts are ranked and written first; the transactions read the written sheet.

    Transactions and accounts come newest first.
    """
    title = "Agent Account"
    accounts = staging.newest_first(staging.agent_accounts(flat, lists.agent_labels))
    paths = write_report({title: accounts}, root, "source_report")
    accounts = flat.sparkSession.read.schema(accounts.schema).parquet(paths[title])
    return paths | write_report(
        {
            "Transaction": staging.newest_first(staging.curated_transactions(flat, lists, accounts=accounts)),
            "Error Transaction": staging.error_transactions(flat, lists, accounts),
            "Duplicated Agent Account": staging.duplicate_agent_accounts(flat, lists.agent_labels),
        },
        root,
        "source_report",
    )


def write_daily_update(flat: DataFrame, root: str, year: int, as_of: datetime, scope: str = "period") -> str:
    """All months of the year in one job, a folder per month."""
    path = f"{root.rstrip('/')}/report=daily_update"
    report = daily.daily_update(flat, year, as_of, scope).drop("month").withColumnRenamed("period", "sheet")
    write_split(report, path, ["sheet"])
    return path


def publish_reports(flat: DataFrame, root: str, as_of: datetime, teams: Mapping[str, Sequence[str]]) -> dict[str, manifest.State]:
    """The monthly counts, payroll and source report, each workbook replaced at once when all its sheets are there."""
    writers = {
        "monthly_counts": lambda top: write_monthly_counts(flat, top, as_of, teams),
        "payroll": lambda top: write_payroll(flat, top),
        "source_report": lambda top: write_staging(flat, top),
    }
    return {name: manifest.publish(flat.sparkSession, root, name, write) for name, write in writers.items()}


def write_extracts(
    flat: DataFrame,
    root: str,
    as_of: datetime,
    teams: Mapping[str, Sequence[str]] = extracts.TEAMS,
    bounds: str = "calendar",
) -> dict[str, str]:
    """All extracts in one job, and last month's closings by half month and team; empty extracts leave no folder.

    Every cell is text on one line.
    """
    path = f"{root.rstrip('/')}/report=extracts"
    write_split(render_on_one_line(extracts.all_extracts(flat, as_of, teams, bounds)), path, ["extract"])
    return {"extracts": path, "closed_properties": write_closed_halves(flat, root, as_of, teams, bounds)}


def write_closed_halves(
    flat: DataFrame,
    root: str,
    as_of: datetime,
    teams: Mapping[str, Sequence[str]] = extracts.TEAMS,
    bounds: str = "calendar",
) -> str:
    """Last month's closings alone: a folder for each half month and team."""
    path = f"{root.rstrip('/')}/report=closed_properties"
    closed = extracts.closed_halves(flat, as_of, teams, bounds=bounds)
    write_split(render_on_one_line(closed), path, ["workbook", "sheet"])
    return path
