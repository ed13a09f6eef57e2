"""Casts: strict ones fail the job on a bad value, lenient ones set it aside."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def strict(value: Column, ty: str) -> Column:
    """Cast that fails on malformed text and on NULL, whatever the session's ANSI mode."""
    cast = value.try_cast(ty)
    shown = F.coalesce(value.cast("string"), F.lit("NULL"))
    message = F.concat(F.lit(f"not a valid {ty}: "), shown)
    return F.when(cast.isNull(), F.raise_error(message).cast(ty)).otherwise(cast)


def lenient(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every column cast, rows with a NULL or malformed one, left as text)."""
    tried = {c: F.col(c).try_cast(ty) for c, ty in types.items()}
    bad = F.lit(False)
    for column in tried.values():
        bad = bad | column.isNull()
    good = df.where(~bad).withColumns(tried)
    return good, df.where(bad)


def _seldom(text: Column, rest: Callable[[Column], Column]) -> Column:
    """``rest`` of a text that is not NULL, out of line.

    A lambda is not inlined into the generated code. Two dozen casts with all their branches
    inlined make a method too long to be compiled, which then runs three times as long.
    """
    return F.when(text.isNotNull(), F.element_at(F.transform(F.array(text), rest), 1))


def _fraction_free(text: Column, ty: str) -> Column:
    number = text.try_cast("decimal(25, 6)")
    return F.when(number == F.floor(number), number.try_cast(ty))


def try_whole_number(text: Column, ty: str = "int") -> Column:
    """Text as a whole number; ``7.0`` counts as 7, anything else that is none is NULL."""
    return F.coalesce(text.try_cast(ty), _seldom(text, lambda t: _fraction_free(t, ty)))


def _or_fail(text: Column, what: str, ty: str, rest: Callable[[Column], Column]) -> Column:
    failed = lambda t: F.raise_error(F.concat(F.lit(f"{what}: "), t)).cast(ty)
    return F.coalesce(text.try_cast(ty), _seldom(text, lambda t: F.coalesce(rest(t), failed(t))))


def whole_number(text: Column, ty: str = "int") -> Column:
    """Text as a whole number, failing on malformed text; NULL stays NULL."""
    return _or_fail(text, "not a whole number", ty, lambda t: _fraction_free(t, ty))


def try_typed(text: Column, ty: str) -> Column:
    """Text of a payload field as a stored type, NULL where it is none."""
    if ty in ("int", "bigint"):
        return try_whole_number(text, ty)
    return text if ty == "string" else text.try_cast(ty)


def typed(text: Column, ty: str) -> Column:
    """The same, failing on malformed text; NULL stays NULL."""
    if ty in ("int", "bigint"):
        return whole_number(text, ty)
    return text if ty == "string" else _or_fail(text, f"not a valid {ty}", ty, lambda t: t.try_cast(ty))


def mistyped(text: Column, ty: str) -> Column:
    """Whether text is there that is no value of the type; for text, a nested value."""
    if ty == "string":
        return text.rlike(r"^\s*[\[{]") & F.try_parse_json(text).isNotNull()
    return text.isNotNull() & try_typed(text, ty).isNull()


def text_key(value: Column) -> Column:
    """Key as text; NULL stays NULL."""
    return value.cast("string")


def naive_timestamp(text: Column) -> Column:
    """Timestamp without zone; a trailing ``Z`` is ignored."""
    return text.cast("timestamp_ntz")


def or_default(value: Column, default: object) -> Column:
    """The value, or a default where it is NULL."""
    return F.coalesce(value, F.lit(default))
