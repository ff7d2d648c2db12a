"""Attributes out of the JSON list of ``{"key", "label", "value"}`` objects.

The list is parsed once per row into an array of structs; every attribute is then a position lookup in it.
Elements that are no objects are passed over, and text that is no JSON list, or more than one, gives NULL for every
attribute.
"""

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports.functions.calendar import date_sql
from dealreports.functions.text import literal, quoted
from dealreports.session import written

_NAMES = ("key", "label")
# Put after the text, in a list of both: only a text that is one whole JSON value leaves it in second place.
_END = "no attribute list holds this text 5d1e"

# A plain list: every element an object of key, label and value in any order, each a text, a whole number, true, false
# or null, written without blanks or with one after a colon or comma. Valid JSON that looks so is such a list.
_SCALAR = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|null|true|false|0|-?[1-9][0-9]{0,17})'
_ORDERS = [", ?+".join(f'"{n}": ?+{_SCALAR}' for n in names) for names in permutations(("key", "label", "value"))]
_OBJECT = rf"\{{(?:{'|'.join(_ORDERS)})\}}"
_PLAIN = rf"\A\[(?:{_OBJECT}(?:, ?+{_OBJECT})*+)?+\]\z"


def items(text: Column, names: Iterable[str] = _NAMES, mark_values: bool = True) -> Column:
    """JSON text to an array of (key, label, value, has_value).

    A text is read once, as a member of an object whose name tells how. A plain list (as ``_PLAIN`` says) is read
    as texts. Any other is read as a variant: a top-level object is then no list, and an element that is no object
    becomes a NULL without spoiling the others; both ways give the same for a plain list, but a variant takes a cast
    for each value. ``has_value`` tells a missing member from a JSON null.
    The reader stops after a complete value, so a text that is not plain is read inside a list with a mark behind it:
    what follows a list, a second one or a bare NaN makes the whole text unreadable.

    Only members of ``names`` are read besides the value. Without ``mark_values``, ``has_value`` is left out.
    """
    members = ", ".join(f"{name} string" for name in names)
    plain, value = f"array<struct<{members}, value string>>", "variant" if mark_values else "string"
    as_plain = F.concat(F.lit('{"plain_5d1e":'), text, F.lit("}"))
    as_other = F.concat(F.lit('{"other_5d1e":['), text, F.lit(f',"{_END}"]}}'))
    read = F.from_json(
        F.when(text.rlike(_PLAIN), as_plain).otherwise(as_other),
        f"struct<plain_5d1e {plain}, other_5d1e variant, invalid_5d1e string>",
        {"allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "invalid_5d1e"},
    )

    def element(x: Column, value: Column, has_value: Column) -> Column:
        return F.struct(*[x[name].alias(name) for name in names], value.alias("value"), has_value.alias("has_value"))

    def marked(x: Column) -> Column:
        return element(x, x["value"].try_cast("string"), x["value"].isNotNull())

    def of_other(both: Column) -> Column:
        is_whole = (F.size(both) == 2) & (both[1].try_cast("string") == _END)
        found = F.when(is_whole, both[0].try_cast(f"array<struct<{members}, value {value}>>"))
        return F.transform(found, marked) if mark_values else found

    def of_either(r: Column) -> Column:
        of_plain = F.when(r["invalid_5d1e"].isNull(), r["plain_5d1e"])
        if mark_values:
            of_plain = F.transform(of_plain, lambda x: element(x, x["value"], F.lit(True)))
        others = F.transform(F.array(r["other_5d1e"].try_cast("array<variant>")), of_other)
        return F.coalesce(of_plain, F.get(others, 0))

    return F.get(F.transform(F.array(read), of_either), 0)


def only_with_value(elements: Column) -> Column:
    return F.filter(elements, lambda x: x["has_value"])


def lookup(names: Column, values: Column, name: str) -> Column:
    """The value that stands where ``name`` first stands."""
    return F.get(values, F.array_position(names, name).cast("int") - 1)


def _names_and_values(elements: Column, by: str, keep: str) -> list[Column]:
    if keep == "first":
        return [elements[by], elements["value"]]
    if keep == "last":
        return [F.reverse(elements[by]), F.reverse(elements["value"])]
    raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")


def first_value(text: Column, name: str, by: str = "key") -> Column:
    """One attribute straight from the JSON text; ``extract`` gives several from one parse."""
    return lookup(*_names_and_values(items(text, [by], False), by, "first"), name)


def last_value(text: Column, name: str, by: str = "key") -> Column:
    return lookup(*_names_and_values(items(text, [by], False), by, "last"), name)


def equals_flag(value: Column, wanted: str) -> Column:
    """True or false, never NULL."""
    return value.eqNullSafe(F.lit(wanted))


def _per_row(df: DataFrame, drop: list[str], **made: Column) -> DataFrame:
    """``df`` without ``drop`` but with columns that are made once per row, however often they are used."""
    generator = F.inline(F.array(F.struct(*[column.alias(name) for name, column in made.items()])))
    return df.select(*[quoted(c) for c in df.columns if c not in drop], generator)


def parse_once(
    df: DataFrame, text: str = "field_values", names: Iterable[str] = _NAMES, mark_values: bool = True
) -> DataFrame:
    """``df`` with the parsed list as ``items`` in place of the text; ``names`` and ``mark_values`` as there.

    The list comes out of a one-row generator. Filters on attributes stay above it; with a plain projection
    they would be pushed below it and parse the text a second time.
    """
    return _per_row(df, [text], items=items(F.col(text), names, mark_values))


def _lookup_in(names: str, values: str):
    return lambda wanted: lookup(F.col(names), F.col(values), wanted)


def _codes(wanted: list[str], by: str, keep: str, require_value: bool) -> Column:
    """For each element the hash of its name, NULL where it is not wanted or has no value that it must have."""
    asked = lambda x: x[by].isin(wanted) & x["has_value"] if require_value else x[by].isin(wanted)
    codes = F.transform("items", lambda x: F.when(asked(x), F.xxhash64(x[by])))
    return F.reverse(codes) if keep == "last" else codes


def _bit(code: str) -> str:
    return f"shiftleft(1L, CAST({code} & 63L AS INT))"


def _bits(codes: Column) -> Column:
    """A bit for each code of a row, by its last six binary digits."""
    one = F.lit(1).cast("long")
    put = lambda bits, code: bits.bitwiseOR(F.call_function("shiftleft", one, code.bitwiseAND(63).cast("int")))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda bits, code: F.coalesce(put(bits, code), bits))


# A group of more wanted names than this is looked up by codes of the names, one compiled expression for each. Spark
# does not put a table of more than a hundred fields into one method, which would be too long to be compiled.
_MANY = 100


def _searched(names: str, values: str, bits: str, code: str) -> str:
    found = f"get({values}, CAST(array_position({names}, {code}) AS INT) - 1)"
    return f"CASE WHEN ({bits} & {_bit(code)}) <> 0 THEN {found} END"


def _pick(df: DataFrame, groups: Mapping[str, tuple[list[str], str, str, bool]]) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """``df`` with ``items`` replaced by what lookups need, and the lookups of each group as SQL.

    A group is its wanted names, by what and of which match they are looked up, and whether only elements with a
    value count. Each step is made once per row: the names and values of a group first, then the lookups of a small
    group as one expression. For a large group the names become numbers: a wanted name its hash, any other NULL, so
    that names no one asks for match nothing. The bits of a row's numbers tell most names that it lacks, unsearched.
    """
    if any(require_value and len(wanted) <= _MANY for wanted, _, _, require_value in groups.values()):
        df = _per_row(df, [], __valued=only_with_value(F.col("items")))
    sides, picked, lookups, many = {}, {}, {}, {}
    for group, (wanted, by, keep, require_value) in groups.items():
        names, values = f"__{group}_names", f"__{group}_values"
        is_many = len(wanted) > _MANY
        elements = F.col("__valued" if require_value and not is_many else "items")
        sides[names], sides[values] = _names_and_values(elements, by, keep)
        if is_many:
            sides[names] = _codes(wanted, by, keep, require_value)
            many[f"__{group}_bits"] = _bits(F.coalesce(F.col(names), F.array().cast("array<bigint>")))
            lookups[group] = {w: _searched(names, values, f"__{group}_bits", f"xxhash64({literal(w)})") for w in wanted}
        else:
            wanted_list = F.expr(f"array({', '.join(literal(w) for w in wanted)})")
            picked[f"__{group}"] = F.transform(wanted_list, _lookup_in(names, values))
            lookups[group] = {w: f"get(__{group}, {i})" for i, w in enumerate(wanted)}
    df = _per_row(df, ["items", "__valued"], **sides)
    if many:
        df = _per_row(df, [], **many)
    if picked:
        df = _per_row(df, [f"{group}_{side}" for group in picked for side in ("names", "values")], **picked)
    return df, lookups


def extract(
    df: DataFrame,
    attributes: Mapping[str, str] | Iterable[str],
    by: str = "key",
    keep: str = "first",
    require_value: bool = False,
    text: str = "field_values",
) -> DataFrame:
    """``df`` with one text column per attribute in place of the JSON text; NULL where a row lacks it.

    ``attributes`` maps attribute names to column names, or just lists names.
    """
    return _extracted(parse_once(df, text, [by], require_value), attributes, by, keep, require_value)


def _extracted(
    parsed: DataFrame, attributes: Mapping[str, str] | Iterable[str], by: str, keep: str, require_value: bool
) -> DataFrame:
    renames = dict(attributes) if isinstance(attributes, Mapping) else {a: a for a in attributes}
    found, lookups = _pick(parsed, {"picked": (list(renames), by, keep, require_value)})
    return found.selectExpr(
        *[quoted(c) for c in parsed.columns if c != "items"],
        *[f"{lookups['picked'][name]} AS {quoted(column)}" for name, column in renames.items()],
    )


@dataclass(frozen=True)
class FlatSpec:
    """Which attributes the flat table holds: by key or by label, first or last match.

    Keys in ``key_dates`` become timestamps, NULL where the text is no date; all else stays text. Their days
    are kept in ``days`` too: Parquet skips row groups by dates, but not by timestamps without a zone.
    """

    keys: list[str] = field(default_factory=list)
    keys_last: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    labels_last: list[str] = field(default_factory=list)
    key_dates: list[str] = field(default_factory=list)


def flatten(df: DataFrame, spec: FlatSpec, text: str = "field_values") -> DataFrame:
    """The flat table: the fixed columns plus one struct per kind of lookup, from a single parse.

    Write it once as Parquet; every report then reads only the struct fields it names.
    """
    groups = {
        "keys": (spec.keys, "key", "first", False),
        "keys_last": (spec.keys_last, "key", "last", False),
        "labels": (spec.labels, "label", "first", False),
        "labels_last": (spec.labels_last, "label", "last", True),
    }
    groups = {group: parts for group, parts in groups.items() if parts[0]}
    names = [name for name in _NAMES if any(by == name for _, by, _, _ in groups.values())] or _NAMES
    mark_values = any(require_value for _, _, _, require_value in groups.values())
    found, lookups = _pick(parse_once(df, text, names, mark_values), groups)

    def structs(group: str, values: dict[str, str]) -> list[str]:
        dates = {n: date_sql(v) for n, v in values.items() if group.startswith("keys") and n in spec.key_dates}
        made = [_struct({**values, **dates}, group)]
        if dates:
            days = {n: f"CAST({v} AS DATE)" for n, v in dates.items()}
            made.append(_struct(days, group.replace("keys", "days")))
        return made

    return found.selectExpr(
        *[quoted(c) for c in df.columns if c != text],
        *[made for group, values in lookups.items() for made in structs(group, values)],
    )


def _struct(fields: Mapping[str, str], name: str) -> str:
    return f"named_struct({', '.join(f'{literal(n)}, {v}' for n, v in fields.items())}) AS {name}"


def labels_in(parsed: DataFrame) -> DataFrame:
    """The distinct labels of a parsed table that stand with a value: (label)."""
    found = parsed.select(F.explode(only_with_value(F.col("items"))["label"]).alias("label"))
    return found.where("label IS NOT NULL").distinct()


def label_names(parsed: DataFrame, most: int | None = None) -> list[str]:
    """The labels in alphabetical order, for columns. They come to the driver; ``most`` refuses more than so many."""
    found = labels_in(parsed)
    rows = (found if most is None else found.limit(most + 1)).collect()
    if most is not None and len(rows) > most:
        raise ValueError(f"more than {most} distinct labels")
    return sorted(r["label"] for r in rows)


def wide_discovered(df: DataFrame, text: str = "field_values", most: int | None = None) -> DataFrame:
    """All labels of the data as columns, last match per row.

    The lists are parsed once and written; one pass over them finds the labels and one projects them. No row is
    shuffled, as a pivot would do.
    """
    parsed = written(parse_once(df, text, ["label"]), "parsed")
    return _extracted(parsed, label_names(parsed, most), "label", "last", True)


def unreadable(df: DataFrame, text: str = "field_values") -> DataFrame:
    """How many rows have text that is no JSON list: (rejected)."""
    has_text = df.select(text, F.col(text).isNotNull().alias("has_text"))
    return parse_once(has_text, text, ["key"], False).agg(F.count_if(F.col("has_text") & F.col("items").isNull()).alias("rejected"))
