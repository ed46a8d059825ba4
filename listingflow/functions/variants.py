"""Reading loosely typed JSON held in VARIANT columns.

A JSON value has three states that must stay apart: missing (SQL NULL), null
(a variant null) and present. "Truthy" is what a dynamic language takes for
true: not null, not zero, not an empty text, list or object.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the number texts accepted in payloads. Digits may be grouped
# by single underscores; the words for infinity and not-a-number are numbers.
DIGITS = r"\d(?:_?\d)*"
FLOAT_TEXT = (
    rf"(?iU)^\s*[+-]?(?:(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:e[+-]?{DIGITS})?"
    r"|inf|infinity|nan)\s*$"
)
INT_TEXT = rf"(?U)^\s*[+-]?{DIGITS}\s*$"
# The usual texts, tested first: they need no cleaning.
PLAIN_NUMBER = r"^-?[0-9]+(?:\.[0-9]+)?$"
PLAIN_DIGITS = r"^-?[0-9]+$"
# What a number, boolean, list or object (or a null in a list, marked NULL_MARK)
# looks like as text. A text that looks like none of them was one in the payload.
NULL_MARK = "\x00"
TYPED = r"(?:-?[0-9]|-?Infinity|NaN|true|false|[\[{\x00])"

MAYBE_EMPTY = r"^(?:-?0+(?:\.0+)?(?:[eE].*)?|false|\[\]|\{\})$"
TYPED_IN_LINE = rf"\|{TYPED}"

STRINGS = "ARRAY<STRING>"
# Values that count as empty, as JSON. Zero is normalised when JSON is parsed.
EMPTY_JSON = ["null", '""', "false", "[]", "{}", "0", "0.0", "-0.0"]


def get(value: Column, path: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, path, as_type)


def struct(**types: str) -> str:
    """Type text of a struct, for reading JSON."""
    return "struct<" + ", ".join(f"`{name}`: {kind}" for name, kind in types.items()) + ">"


def texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


def held(column: Column) -> Column:
    """The column as the output of a one-element explode.

    Catalyst pushes a filter below the projections it stands on and repeats
    their expressions in it, but not below a generator. Columns are still pruned.
    """
    return F.explode(F.array(column))


def held_if_read(column: Column) -> Column:
    """As `held`, but left out with all its work where nothing reads the column.

    A generator is never left out. A filter is not pushed below a projection that is not
    deterministic either, which the condition makes it, though it always holds.
    """
    return F.when(F.rand(0) != 2, column)


def kind(value: Column) -> Column:
    """Type of a value: STRING, BOOLEAN, VOID (null), ARRAY<...>, OBJECT<...>, a number type."""
    return F.schema_of_variant(value)


def truthy(value: Column) -> Column:
    return F.coalesce(~F.to_json(value).isin(EMPTY_JSON), F.lit(False))


def float_text(text: Column) -> Column:
    """A text as double under the payload's number grammar, else NULL."""
    plain = F.regexp_replace(text, r"(?U)[_\s]", "")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).when(
        text.rlike(FLOAT_TEXT), plain.try_cast("double")
    )


def int_text(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?U)[_\s]", "")
    return F.when(text.rlike(PLAIN_DIGITS), text.try_cast("bigint")).when(
        text.rlike(INT_TEXT), plain.try_cast("bigint")
    )


class Leaf(NamedTuple):
    """A scalar of the payload: as text, and as the VARIANT it was.

    Nearly every decision can be made on the text, which is read for all fields
    of an item at once. `value` is looked up, so it stands only in
    branches for the rest, where the type matters: is a `0` a number or a text?
    It must not stand in a condition, not even behind an `&`: Spark may evaluate
    a common part of conditions ahead of them.
    """

    text: Column
    value: Column


def is_text(scalar: Leaf) -> Column:
    typed = scalar.text.rlike("^" + TYPED)
    return F.when(~typed, True).when(typed, kind(scalar.value) == "STRING").otherwise(False)


def given(scalar: Leaf) -> Column:
    """`truthy` of a scalar. Only a few texts count as empty if they were no text."""
    return (
        F.when(scalar.text.isNull(), False)
        .when(scalar.text.rlike(MAYBE_EMPTY), truthy(scalar.value))
        .otherwise(scalar.text != "")
    )


def to_double(scalar: Leaf) -> Column:
    """Number, numeric text or boolean as double; NULL if it is none of these."""
    return (
        F.when(scalar.text.rlike(PLAIN_NUMBER), scalar.text.try_cast("double"))
        .when(scalar.text.isNull(), None)
        .when(kind(scalar.value) == "STRING", float_text(scalar.text))
        .otherwise(get(scalar.value, "$", "double"))
    )


def given_double(scalar: Leaf) -> Column:
    """`to_double` of a scalar that is given, so not of a zero that is a number."""
    number = scalar.text.try_cast("double")
    plain = F.when(number != 0, number).otherwise(F.when(truthy(scalar.value), number))
    other = F.when(kind(scalar.value) == "STRING", float_text(scalar.text)).otherwise(
        get(scalar.value, "$", "double")
    )
    return (
        F.when(scalar.text.rlike(PLAIN_NUMBER), plain)
        .when(scalar.text.isNull(), None)
        .otherwise(F.when(truthy(scalar.value), other))
    )


def to_int(scalar: Leaf) -> Column:
    """As `to_double`, to whole numbers: a number is cut, a text must be whole."""
    return (
        F.when(scalar.text.rlike(PLAIN_DIGITS), scalar.text.try_cast("bigint"))
        .when(scalar.text.isNull(), None)
        .when(kind(scalar.value) == "STRING", int_text(scalar.text))
        .otherwise(get(scalar.value, "$", "bigint"))
    )


def to_text(scalar: Leaf) -> Column:
    """A scalar as text; booleans are capitalised, lists and objects stay JSON."""
    as_bool = F.when(kind(scalar.value) == "BOOLEAN", F.initcap(scalar.text)).otherwise(scalar.text)
    return F.when(scalar.text.isin("true", "false"), as_bool).otherwise(scalar.text)


def maybe_typed(line: Column) -> Column:
    """True if a part of a `|`-joined line may have been something else than a text."""
    return F.concat(F.lit("|"), line).rlike(TYPED_IN_LINE)


def joined(items: Column, value: Column) -> Column:
    """A JSON array of texts joined by `|`; NULL if it is empty or holds anything else."""
    line = F.array_join(items, "|", NULL_MARK)
    only_text = (kind(value) == STRINGS) & ~F.exists(items, lambda item: item.isNull())
    return (
        F.when(items.isNull() | (F.size(items) == 0), None)
        .when(~maybe_typed(line), line)
        .when(only_text, line)
    )
