"""Casting, standardising and classifying single columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar import fixed_values as fv

_DATE_LIKE = r"^\d{4}-\d{1,2}-\d{1,2}"
_LOCAL_TIME = _DATE_LIKE + r"([Tt ][0-9:.]*)?\s*$"
_FLOAT_SUFFIX = r"[0-9.][dDfF]\s*$"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_timestamp(c: Column | str) -> Column:
    """Text to a zone-less UTC timestamp, NULL when malformed.

    A text with an explicit zone is moved to UTC; the result never depends on the session zone.
    """
    c = _column(c)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = F.timestamp_add("MICROSECOND", F.unix_micros(c.try_cast("timestamp")), epoch)
    local = c.try_cast("timestamp_ntz")
    return F.when(c.rlike(_LOCAL_TIME), local).when(c.rlike(_DATE_LIKE), zoned)


def safe_cast(c: Column | str, to: str) -> Column:
    """Text to ``to``, NULL when malformed."""
    c = _column(c)
    if to in ("timestamp", "timestamp_ntz"):
        return safe_timestamp(c)
    if to in ("double", "float"):
        # Java's number parser also takes a type suffix such as "1.5f"; that is no number here.
        return F.when(~c.rlike(_FLOAT_SUFFIX), c.try_cast(to))
    return c.try_cast(to)


def safe_cast_sql(text: str, to: str) -> str:
    """``safe_cast`` as SQL text, for views."""
    if to in ("timestamp", "timestamp_ntz"):
        zoned = f"unix_micros(try_cast({text} AS timestamp))"
        return (
            f"CASE WHEN {text} RLIKE r'{_LOCAL_TIME}' THEN try_cast({text} AS timestamp_ntz) "
            f"WHEN {text} RLIKE r'{_DATE_LIKE}' "
            f"THEN timestampadd(MICROSECOND, {zoned}, timestamp_ntz'1970-01-01 00:00:00') END"
        )
    if to in ("double", "float"):
        return f"CASE WHEN NOT {text} RLIKE r'{_FLOAT_SUFFIX}' THEN try_cast({text} AS {to}) END"
    return f"try_cast({text} AS {to})"


def strict_cast(c: Column | str, to: str) -> Column:
    """Cast that fails the job on malformed text, whatever the session's ANSI setting is."""
    c = _column(c)
    if to == "string":
        return c.cast("string")
    message = F.concat(F.lit(f"cannot cast to {to}: "), c.cast("string"))
    return F.coalesce(safe_cast(c, to), F.when(c.isNotNull(), F.raise_error(message)).cast(_type(to)))


def _type(to: str) -> str:
    return "timestamp_ntz" if to == "timestamp" else to


def trim_all(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(_column(c), F.lit(fv.WHITE_SPACE))


def classify_prefix(
    c: Column | str, rules: Sequence[tuple[Sequence[str], str]], default: str
) -> Column:
    """First rule with a matching (upper-cased) prefix wins."""
    text = F.upper(_column(c))
    return _first_match(
        [(_any(text.startswith(p) for p in prefixes), label) for prefixes, label in rules], default
    )


def standardize(c: Column | str, synonyms: Mapping[str, Sequence[str]], default: str) -> Column:
    """Map spellings (compared trimmed and upper-cased) to their standard label."""
    text = F.upper(trim_all(c))
    return _first_match([(text.isin(list(s)), label) for label, s in synonyms.items()], default)


def categorize(c: Column | str, keywords: Sequence[tuple[str, str]], default: str) -> Column:
    """First keyword contained in the lower-cased text wins."""
    text = F.lower(_column(c))
    return _first_match([(text.contains(word), label) for word, label in keywords], default)


def clean_zip(c: Column | str) -> Column:
    """Keep 5- and 9-character codes and ZIP+4; map the missing and anonymous spellings."""
    c = _column(c)
    text, size = F.upper(trim_all(c)), F.length(c)
    plus_four = (size == 10) & c.rlike(fv.ZIP_PLUS_FOUR)
    return (
        F.when(text.isin(fv.ZIP_MISSING), F.lit(None).cast("string"))
        .when(text == fv.ZIP_ANONYMOUS.upper(), F.lit(fv.ZIP_ANONYMOUS))
        .when(size.isin(5, 9) | plus_four, c)
    )


def flag_eq(c: Column | str, value: str) -> Column:
    """TRUE where equal, FALSE everywhere else (NULL included)."""
    return F.coalesce(_column(c) == value, F.lit(False))


def flag_in(c: Column | str, values: Iterable[str]) -> Column:
    """TRUE where the value is listed, FALSE everywhere else (NULL included)."""
    return F.coalesce(_column(c).isin(list(values)), F.lit(False))


def round_to_long(c: Column | str) -> Column:
    """Exact numeric to a whole number, halves away from zero."""
    return F.round(_column(c), 0).cast("bigint")


def within_years(c: Column | str, years: int, as_of: Column) -> Column:
    """TRUE for days on or after ``as_of`` minus ``years`` years."""
    return F.to_date(_column(c)) >= F.add_months(as_of, -12 * years)


def _any(tests: Iterable[Column]) -> Column:
    result = None
    for test in tests:
        result = test if result is None else result | test
    return result


def _first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    result = F
    for test, label in rules:
        result = result.when(test, F.lit(label))
    return result.otherwise(F.lit(default))
