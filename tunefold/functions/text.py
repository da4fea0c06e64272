"""Scalar expressions with the warehouse dialect's semantics, all JVM-side.

Spark and the warehouse disagree on a few scalar rules; each helper spells the
warehouse rule out with built-in functions so it stays inside codegen:

* ``concat`` skips NULL arguments (Spark's ``concat`` returns NULL);
* ``int / int`` truncates (Spark's ``/`` returns a fraction);
* splitting an empty string yields no elements (Spark yields ``['']``);
* ``ORDER BY ... DESC`` puts NULLs first (Spark puts them last).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse's array text format: an element is written in
# double quotes when it is empty, spells NULL, or holds one of these
# characters: { } , " \ or white space; inside quotes " and \ get a backslash.
ARRAY_TEXT_SPECIALS = r'[{},"\\\s]'
# Characters stripped before splitting array text back into elements.
ARRAY_TEXT_STRIP = r'[{}"]'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_skipping_concat(*parts) -> Column:
    """``concat`` that treats NULL arguments as absent."""
    return F.concat_ws("", *[_c(p) for p in parts])


def format_duration(ms) -> Column:
    """Milliseconds to ``m:ss`` (whole minutes, zero-padded seconds); NULL gives ``':'``."""
    ms = _c(ms)
    return null_skipping_concat(
        int_div(ms, 60000).cast("string"),
        F.lit(":"),
        F.lpad(int_div(ms % 60000, 1000).cast("string"), 2, "0"),
    )


def int_div(x, d) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", _c(x), d if isinstance(d, Column) else F.lit(d))


def year_month(date_text) -> Column:
    """First seven characters of a date string (``YYYY-MM``); shorter text is kept, NULL stays NULL."""
    return F.left(_c(date_text), F.lit(7))


def split_list(text, sep: str = ", ") -> Column:
    """Split a separator-joined list; NULL or empty text gives NULL (so ``explode`` emits no row)."""
    return F.split(F.nullif(_c(text), F.lit("")), _quote_regex(sep))


def explode_list(text, sep: str = ", ") -> Column:
    return F.explode(split_list(text, sep))


def array_text_elements(text) -> Column:
    """Parse array text such as ``{a,"b c"}`` the way the views do: strip ``{ } "`` and split on ``,``."""
    return split_list(F.regexp_replace(_c(text), ARRAY_TEXT_STRIP, ""), ",")


def array_to_text(arr) -> Column:
    """Render ``ARRAY<STRING>`` as the warehouse's array text (``{a,"b c"}``); NULL array gives NULL."""
    arr = _c(arr)

    def element(g: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.regexp_replace(g, r'(["\\])', r"\\$1"), F.lit('"'))
        needs_quotes = (g == "") | (F.upper(g) == "NULL") | g.rlike(ARRAY_TEXT_SPECIALS)
        return F.when(g.isNull(), F.lit("NULL")).when(needs_quotes, quoted).otherwise(g)

    return F.when(arr.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(arr, element), ","), F.lit("}")))


def round_half_away_int(x) -> Column:
    """``cast(round(x, 0) as int)``: half away from zero, like numeric rounding."""
    return F.round(_c(x), 0).cast("int")


def _quote_regex(sep: str) -> str:
    out = []
    for ch in sep:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)
