"""String helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def business_key(prefix: str, number: Column, width: int) -> Column:
    """Prefix + zero-padded number.

    lpad cuts strings that are longer than the width, which would merge keys once the
    numbers outgrow it, so the width grows with the number.
    """
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix),
        F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")),
    )


def decode(code: Column, names: Mapping[str, str], default: str | None = None) -> Column:
    """Look a code up in a small fixed mapping."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, F.lit(default))


def pick(values: list[str], index: Column) -> Column:
    """values[index mod len(values)]"""
    slot = F.pmod(index, F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), slot + 1)


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
