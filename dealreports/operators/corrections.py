"""Ordered corrections of curated transactions. Each takes the table as the one before left it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dealreports import fixed
from dealreports.functions.text import in_list, literal
from dealreports.operators.columns import changed, is_blank
from dealreports.operators.filters import both_from_year


def empty_closing(df: DataFrame, statuses: Sequence[str] = fixed.NO_CLOSING_STATUSES) -> DataFrame:
    """Rows in these statuses have no closing. Runs before the billing status replaces the status."""
    return changed(df, {"Closing": f"CASE WHEN `Contract Status` IN {in_list(statuses)} THEN NULL ELSE Closing END"})


def empty_listing(
    df: DataFrame, cutover_year: int = fixed.CUTOVER_YEAR, zero_listing_amount: bool = False
) -> DataFrame:
    """Where contract work and listing both started in or after the year, the listing dates are emptied.

    The listing amount is left alone, since the test for it comes after its date was emptied;
    ``zero_listing_amount`` sets it to 0.
    """
    both = both_from_year("`CTC Started with Empower`", "`Listing Started with Empower`", cutover_year)
    emptied = {
        n: f"CASE WHEN {both} THEN NULL ELSE `{n}` END"
        for n in ("Listing Started with Empower", "Live on MLS Date", "Listing PAID Date")
    }
    if zero_listing_amount:
        emptied["Listing PAID Amount"] = f"CASE WHEN {both} THEN '0' ELSE `Listing PAID Amount` END"
    return changed(df, emptied)


def override_status(df: DataFrame) -> DataFrame:
    """A billing status replaces the contract status."""
    return changed(
        df,
        {"Contract Status": "CASE WHEN `Billing Status` <> 'none' THEN `Billing Status` ELSE `Contract Status` END"},
    )


def is_no_amount(text: str) -> str:
    """NULL, empty, or zero however it is written."""
    return f"({is_blank(text)} OR coalesce(try_cast({text} AS DOUBLE) = 0, FALSE))"


def correct_billing(df: DataFrame) -> DataFrame:
    """Blank amounts of rows with a closing: the other amount, or the price of the service."""
    price = (
        f"CASE WHEN `Preferred  Ai  CTC` = 'Yes' THEN {literal(fixed.PREFERRED_BILLING_AMOUNT)} "
        f"ELSE {literal(fixed.STANDARD_BILLING_AMOUNT)} END"
    )
    replacement = f"CASE WHEN {is_no_amount('`Other Amount`')} THEN {price} ELSE `Other Amount` END"
    missing = f"{is_no_amount('`Billing Amount`')} AND Closing IS NOT NULL"
    return changed(df, {"Billing Amount": f"CASE WHEN {missing} THEN {replacement} ELSE `Billing Amount` END"})
