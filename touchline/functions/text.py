"""Text: names, seasons, dates, embedded JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline.schemas import MATCH_INFO

# Fixed value: the script assignment that carries the match data of a page.
MATCH_INFO_PATTERN = r"var\s+match_info\s*=\s*JSON\.parse\('([^']+)'\);"


def full_name(first: Column, last: Column) -> Column:
    """``first last``; NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def season_label(day: Column) -> Column:
    """Season of a date, ``2024/25`` style; a season starts in July."""
    start = F.year(day) - F.when(F.month(day) >= 7, 0).otherwise(1)
    return F.concat(
        start.cast("string"), F.lit("/"), F.right((start + 1).cast("string"), F.lit(2))
    )


def regex_capture(text: Column, pattern: str, group: int = 1) -> Column:
    """Captured text, NULL when the pattern is not found."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def decode_escapes(raw: Column) -> Column:
    r"""Decode ``\xHH``, ``\uHHHH``, ``\n`` and the like; other text is left as it is.

    The text is read as a JSON string: bare quotes are escaped and ``\xHH`` is written
    as ``\u00HH``. An escaped backslash does not start an escape of its own.
    """
    quoted = F.regexp_replace(raw, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
    widened = F.regexp_replace(quoted, r"(?<!\\)((?:\\\\)*)\\x([0-9A-Fa-f]{2})", r"$1\\u00$2")
    options = {"allowBackslashEscapingAnyCharacter": "true", "allowUnquotedControlChars": "true"}
    parsed = F.from_json(F.concat(F.lit('{"v":"'), widened, F.lit('"}')), "v string", options)
    return parsed["v"]


def match_info_text(html: Column) -> Column:
    """JSON text embedded in a match page, NULL when the page has none."""
    return decode_escapes(regex_capture(html, MATCH_INFO_PATTERN))


def match_info(text: Column) -> Column:
    """Parsed match data; NULL when missing, malformed or an empty object."""
    usable = F.json_object_keys(text).isNotNull() & ~text.rlike(r"^\s*\{\s*\}\s*$")
    return F.when(usable, F.from_json(text, MATCH_INFO))


def parse_month_day_year(text: Column, strict: bool = True) -> Column:
    """``Aug 17 2024`` as a date. Strict raises on other text, lenient gives NULL."""
    return F.to_date(text, "MMM d yyyy") if strict else F.try_to_date(text, "MMM d yyyy")


def iso_date(text: Column, strict: bool = True) -> Column:
    """``Aug 17 2024`` as ``2024-08-17``."""
    return F.date_format(parse_month_day_year(text, strict), "yyyy-MM-dd")


def normalise_name(name: Column) -> Column:
    """Form in which names are compared.

    Characters U+0080 to U+00FF are dropped, everything that is no letter, digit or
    underscore becomes a space, then lower case, then trimmed.
    """
    narrowed = F.regexp_replace(name, "[\u0080-ÿ]", "")
    return F.trim(F.lower(F.regexp_replace(narrowed, r"[^\p{L}\p{N}_]", " ")))
