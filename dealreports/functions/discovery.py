"""Types of labels, found in the data: which labels hold dates (written how), whole numbers, money, or only text.

Every value falls into one class of a small lattice: a whole number is also money, everything is also text, a date of
one format is a date. Per label the classes are counted; counts of batches add up, so a new batch is read alone. A
label has the narrowest type that all but a small share of its values fit.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealreports.functions.text import literal

MISFITS = 0.05

# The date formats that are told apart, what they look like, and how they are read.
DATE_CLASSES = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yyyy H:mm": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?$",
}
_READ = {
    "yyyy-MM-dd": "try_cast({0} AS DATE)",
    "yyyy-MM-dd HH:mm:ss": "try_cast({0} AS TIMESTAMP_NTZ)",
    "M/d/yyyy": "try_to_date({0}, 'M/d/yyyy')",
    "M/d/yyyy H:mm": "coalesce(try_to_timestamp({0}, 'M/d/yyyy H:mm'), try_to_timestamp({0}, 'M/d/yyyy H:mm:ss'))",
}
WHOLE = r"^[+-]?\d{1,18}$"
MONEY = r"^[+-]?\$?(\d{1,18}|\d{1,3}(,\d{3}){1,5})(\.\d+)?$"


def class_sql(text: str) -> str:
    """The class of a text: blank, whole, money, a date format, or text."""
    cases = [f"WHEN trim({text}) = '' THEN 'blank'", f"WHEN {text} RLIKE {literal(WHOLE)} THEN 'whole'"]
    cases.append(f"WHEN {text} RLIKE {literal(MONEY)} THEN 'money'")
    for name, looks in DATE_CLASSES.items():
        cases.append(f"WHEN {text} RLIKE {literal(looks)} AND {_READ[name].format(text)} IS NOT NULL THEN {literal(name)}")
    return f"CASE {' '.join(cases)} ELSE 'text' END"


def class_counts(parsed: DataFrame) -> DataFrame:
    """(label, class, n) of a parsed table: its values by class, counted before the shuffle. NULL is no value."""
    values = parsed.select(F.explode("items").alias("item"))
    values = values.select(F.col("item.label").alias("label"), F.col("item.value").alias("value"))
    values = values.where("label IS NOT NULL AND value IS NOT NULL").selectExpr("label", f"{class_sql('value')} AS class")
    return values.groupBy("label", "class").agg(F.count("*").alias("n"))


def add_up(counts: DataFrame, more: DataFrame) -> DataFrame:
    """Counts of two batches as those of both."""
    return counts.unionByName(more).groupBy("label", "class").agg(F.sum("n").alias("n"))


def types_of(counts: DataFrame, misfits: float = MISFITS) -> DataFrame:
    """(label, type, format, n_values, n_blank, misfits): the narrowest type with at most that share of misfits.

    ``format`` is the most frequent one of a date label; values of its other formats count as fitting, for the
    reader of dates tries them all. A label that only has blank values is text.
    """
    dates = ", ".join(literal(name) for name in DATE_CLASSES)
    number = lambda condition: f"coalesce(sum(CASE WHEN {condition} THEN n END), 0)"
    known = counts.groupBy("label").agg(
        F.expr(f"{number("class <> 'blank'")} AS n_values"),
        F.expr(f"{number("class = 'blank'")} AS n_blank"),
        F.expr(f"{number("class = 'whole'")} AS n_whole"),
        F.expr(f"{number("class IN ('whole', 'money')")} AS n_money"),
        F.expr(f"{number(f'class IN ({dates})')} AS n_date"),
        F.expr(f"max(CASE WHEN class IN ({dates}) THEN struct(n, class) END).class AS format"),
    )
    fits = lambda n: f"n_values > 0 AND n_values - {n} <= n_values * {misfits!r}D"
    kind = f"CASE WHEN {fits('n_whole')} THEN 'whole' WHEN {fits('n_money')} THEN 'money' WHEN {fits('n_date')} THEN 'date' ELSE 'text' END"
    typed = known.withColumn("type", F.expr(kind))
    fitting = "CASE type WHEN 'whole' THEN n_whole WHEN 'money' THEN n_money WHEN 'date' THEN n_date ELSE n_values END"
    return typed.selectExpr(
        "label", "type", "CASE WHEN type = 'date' THEN format END AS format", "n_values", "n_blank",
        f"CASE WHEN n_values = 0 THEN 0D ELSE CAST(n_values - {fitting} AS DOUBLE) / n_values END AS misfits",
    )
