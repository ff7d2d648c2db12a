"""Curated transactions, transactions without an agent account, agent accounts and their duplicates."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.fixed import SYSTEM_COLUMNS
from dealreports.operators.columns import (
    changed,
    fill_blank,
    fill_dates,
    in_order,
    named,
    side_by_side,
    to_dates,
)
from dealreports.operators.corrections import correct_billing, empty_closing, empty_listing, override_status
from dealreports.operators.filters import is_not_value, is_value, never_started, title_is_excluded
from dealreports.operators.matching import duplicates_of_newest, newest_per, only_matched, only_unmatched


# What a transaction gets from its agent account.
JOINED = ["Contract Title", *fixed.AGENT_FIELDS]


@dataclass(frozen=True)
class Lists:
    """The column lists of the staging tables."""

    transaction_labels: Sequence[str] = tuple(fixed.TRANSACTION_LABELS)
    agent_labels: Sequence[str] = tuple(fixed.AGENT_LABELS)
    order: Sequence[str] = tuple(fixed.ORDER_COLUMNS)
    dates: Sequence[str] = tuple(fixed.DATE_COLUMNS)
    zero_fill: Sequence[str] = tuple(fixed.ZERO_FILL_COLUMNS)
    none_fill: Sequence[str] = tuple(fixed.NONE_FILL_COLUMNS)


@dataclass(frozen=True)
class Staged:
    curated: DataFrame
    errors: DataFrame
    agents: DataFrame
    duplicates: DataFrame


def transactions(flat: DataFrame, labels: Sequence[str] = fixed.TRANSACTION_LABELS) -> DataFrame:
    """Rows that are no agent account, by label, the last match of each."""
    rows = flat.where(is_not_value("labels_last.`Contract Status`", fixed.AGENT_ACCOUNT))
    return to_dates(side_by_side(rows, "labels_last", labels), ["Date Created"])


def agent_rows(flat: DataFrame, labels: Sequence[str] = fixed.AGENT_LABELS) -> DataFrame:
    """Agent-account rows with their ``id``."""
    rows = flat.where(is_value("labels_last.`Contract Status`", fixed.AGENT_ACCOUNT))
    return to_dates(side_by_side(rows, "labels_last", labels, "id"), ["Date Created"])


def agent_accounts(flat: DataFrame, labels: Sequence[str] = fixed.AGENT_LABELS) -> DataFrame:
    """The newest row per title. Ties are told by the joined fields first, so any choice of labels agrees in them."""
    rows = agent_rows(flat, list(dict.fromkeys([*labels, *JOINED])))
    newest = newest_per(rows, "Contract Title", "Date Created", told_by=JOINED)
    return in_order(newest, [c for c in rows.columns if c in (*SYSTEM_COLUMNS.values(), *labels)])


def duplicate_agent_accounts(flat: DataFrame, labels: Sequence[str] = fixed.AGENT_LABELS) -> DataFrame:
    """The agent rows that are not the newest of their title."""
    rows = agent_rows(flat, list(dict.fromkeys([*labels, *JOINED])))
    others = duplicates_of_newest(rows, "Contract Title", "Date Created", told_by=JOINED)
    return in_order(others, [c for c in rows.columns if c in (*SYSTEM_COLUMNS.values(), *labels)])


def drop_unreal(df: DataFrame) -> DataFrame:
    """Without test, training and deleted deals and without deals that nobody started."""
    return (
        df.where(~title_is_excluded("`Contract Title`"))
        .where(~never_started("`Empower TC Name`"))
        .where(~never_started("`Empower Agent Name`"))
    )


def clean(df: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """Ordered columns, dates typed, blanks filled. Empty dates stay NULL until the end."""
    typed = to_dates(in_order(df, lists.order), lists.dates)
    return fill_blank(fill_blank(typed, lists.zero_fill, "0"), lists.none_fill, "none")


def correct(df: DataFrame, cutover_year: int = fixed.CUTOVER_YEAR, zero_listing_amount: bool = False) -> DataFrame:
    df = empty_closing(df)
    df = empty_listing(df, cutover_year, zero_listing_amount)
    df = override_status(df)
    return correct_billing(df)


def stage(
    flat: DataFrame,
    lists: Lists = Lists(),
    cutover_year: int = fixed.CUTOVER_YEAR,
    zero_listing_amount: bool = False,
    date_filler: datetime | None = fixed.STAGING_DATE_FILLER,
) -> Staged:
    """The four staging tables out of the written flat table.

    Empty dates of the curated table come out as ``date_filler``, or as NULL when it is None.
    """
    curated = curated_transactions(flat, lists, cutover_year, zero_listing_amount, date_filler)
    return Staged(
        curated,
        error_transactions(flat, lists),
        agent_accounts(flat, lists.agent_labels),
        duplicate_agent_accounts(flat, lists.agent_labels),
    )


def curated_transactions(
    flat: DataFrame,
    lists: Lists = Lists(),
    cutover_year: int = fixed.CUTOVER_YEAR,
    zero_listing_amount: bool = False,
    date_filler: datetime | None = fixed.STAGING_DATE_FILLER,
    accounts: DataFrame | None = None,
) -> DataFrame:
    """Transactions with an agent account, cleaned and corrected; ``accounts`` may be a written table of them."""
    accounts = in_order(agent_accounts(flat, JOINED) if accounts is None else accounts, JOINED)
    deals = transactions(flat, lists.transaction_labels)
    matched = only_matched(deals, accounts, "Empower Agent Name", "Contract Title")
    curated = correct(drop_unreal(clean(matched, lists)), cutover_year, zero_listing_amount)
    return curated if date_filler is None else fill_dates(curated, lists.dates, date_filler)


def error_transactions(flat: DataFrame, lists: Lists = Lists(), accounts: DataFrame | None = None) -> DataFrame:
    """Transactions without an agent account, as they came."""
    titles = agent_rows(flat, ["Contract Title"]) if accounts is None else accounts
    deals = transactions(flat, lists.transaction_labels)
    unmatched = only_unmatched(deals, titles, "Empower Agent Name", "Contract Title")
    return changed(unmatched, {f: "CAST(NULL AS STRING)" for f in fixed.AGENT_FIELDS})


def newest_first(df: DataFrame) -> DataFrame:
    """Report order; only for output, since it moves every row.

    Rows of one moment come in any order, so their content may split them over several tasks.
    """
    return df.orderBy(named("Date Created").desc_nulls_last(), F.xxhash64(*[named(c) for c in df.columns]))
