"""The daily update against the predicates evaluated row by row."""

import random
from datetime import datetime, timedelta

import pytest
from records import record

from dealreports import fixed
from dealreports.plans import daily

YEAR = 2024
FILLER = fixed.REPORT_DATE_FILLER
SPECIAL = [
    "2024-01-01 00:00:00", "2024-01-31 23:59:59", "2024-01-31 23:59:59.5", "2024-02-29 23:59:59", "2024-03-01 00:00:00",
    "2024-12-31 23:59:59", "2024-12-31 23:59:59.9", "2025-01-01 00:00:00", "2025-01-31", "2025-02-10", "2023-12-31 23:59:59.5",
    "TBD", None,
]


def random_rows(n, seed):
    rng = random.Random(seed)

    def day():
        if rng.random() < 0.4:
            return rng.choice(SPECIAL)
        return str(datetime(2023, 11, 1) + timedelta(days=rng.randrange(500), hours=rng.randrange(24)))

    def row():
        values = {label: day() for label in daily.DATES.values()}
        values[daily.NAME] = rng.choice(["A", "B", "C", None])
        values[daily.AGENT_NAME] = rng.choice(["A", "B", "only on agents", None])
        values["Contract Status"] = rng.choice([*fixed.DAILY_CTC_STATUSES, *fixed.DAILY_PREFERRED_STATUSES, "x", None])
        values["Agent Provided by"] = rng.choice(["TC", "Empower", None])
        values["Onboarding Status"] = rng.choice(["1st Transaction", "x", None])
        values["Other Status"] = rng.choice([*fixed.LOST_AGENT_STATUSES, "x", None])
        return values

    return [row() for _ in range(n)]


def parsed(text):
    if text in (None, "TBD"):
        return FILLER
    return datetime.fromisoformat(text)


def month_of(date):
    return datetime(date.year, date.month, 1)


def plus(month, n):
    index = month.year * 12 + month.month - 1 + n
    return datetime(index // 12, index % 12 + 1, 1)


def holds(m, row, start, as_of, scope):
    date = parsed(row[daily.DATES[m.date]])
    second = timedelta(seconds=1)
    end, next_start, next_end = plus(start, 1) - second, plus(start, 1), plus(start, 2) - second
    onboard = parsed(row[daily.DATES["onboard"]])
    test = {
        "in": start <= date <= end and month_of(date) == start,
        "active": date >= max(end, as_of),
        "next": next_start < date <= next_end,
        "later": date > next_end,
        "until": date <= start,
        "onboarded": start <= date <= end and month_of(onboard) == start,
    }[m.rule]
    if scope == "period" and m.rule in ("active", "next", "later"):
        test = test and month_of(date) == start
    return test and (m.column is None or row[daily.TEXTS[m.column]] in m.values)


def expected(rows, as_of, scope):
    starts = {month_of(parsed(r[daily.DATES["start"]])) for r in rows}
    names = {r[daily.NAME] for r in rows}
    report = set()
    for start in sorted(s for s in starts if s.year == YEAR):
        for name in names:
            counts = [
                sum(
                    1
                    for r in rows
                    if name is not None and r[daily.TEXTS[m.key]] == name and holds(m, r, start, as_of, scope)
                )
                for m in daily.MEASURES
            ]
            report.add((start.date(), start.strftime("%B %Y").upper(), name, *counts))
    return report


@pytest.mark.parametrize("scope", ["period", "all"])
@pytest.mark.parametrize("as_of", [datetime(2024, 2, 10, 14, 30), datetime(2025, 6, 1)])
def test_report_equals_the_predicates(flat_of, scope, as_of):
    rows = random_rows(250, seed=3)
    flat = flat_of([record(i, items=list(r.items())) for i, r in enumerate(rows)])
    report = daily.daily_update(flat, YEAR, as_of, scope)
    assert report.columns == ["month", "period", daily.NAME, *[m.title for m in daily.MEASURES]]
    assert {tuple(r) for r in report.collect()} == expected(rows, as_of, scope)


def test_pending_files_of_other_months_only_show_in_the_wide_scope(flat_of):
    items = [(daily.NAME, "A"), ("Contract Status", "CTC - Pending"), ("CTC Started with Empower", "2024-01-05"), ("Closing", "2024-03-20")]
    flat = flat_of([record(1, items=items)])
    as_of = datetime(2024, 1, 10)
    narrow = daily.daily_update(flat, YEAR, as_of, "period").first()
    wide = daily.daily_update(flat, YEAR, as_of, "all").first()
    pick = ["Total ACTIVE Files - CTC", "CTC Pending for next month", "CTC Pending for other months"]
    assert [narrow[p] for p in pick] == [0, 0, 0]
    assert [wide[p] for p in pick] == [1, 0, 1]


def test_named_months_spare_the_search(flat_of):
    flat = flat_of([record(1, items=[(daily.NAME, "A")])])
    as_of = datetime(2024, 1, 10)
    assert daily.daily_update(flat, YEAR, as_of).count() == 0
    report = daily.daily_update(flat, YEAR, as_of, months=[datetime(2024, 3, 1)])
    assert [(r["period"], r[daily.NAME]) for r in report.collect()] == [("MARCH 2024", "A")]
    with pytest.raises(ValueError):
        daily.daily_update(flat, YEAR, as_of, "other")
