"""Text and date expressions used by the file readers and the writers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ticker_from_path(path: Column) -> Column:
    """Last path segment without its ``.csv`` ending, or the ticker of a folder
    ``ticker=...``, whose odd characters stand percent-encoded."""
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.url_decode(F.replace(F.substr(name, F.lit(8)), F.lit("+"), F.lit("%2B")))
    return F.when(name.startswith("ticker="), folder).otherwise(F.regexp_replace(name, r"\.csv$", ""))


def field(line: Column, position: int) -> Column:
    """Field of a comma-separated line; NULL when the line is too short."""
    return F.get(F.split(line, ","), position)


def unquoted(text: Column) -> Column:
    """Trim blanks, then drop one leading and one trailing double quote."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), '^"', ""), '"$', "")


def slash_day(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def compact_day(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def checked(columns: dict[str, Column], complete: Column, message: Column) -> list[Column]:
    """The columns of rows that are ``complete``; any use of any of them fails
    the job on a row that is not. A check that hung on one column, or on a filter,
    would vanish where the planner prunes or filters before it."""
    return [F.when(complete, column).otherwise(F.raise_error(message)).alias(name)
            for name, column in columns.items()]


def is_csv_payload(payload: Column) -> Column:
    """A vendor answer holding a brace is an error message, not data; no answer
    at all is no data either."""
    return F.coalesce(~payload.contains("{"), F.lit(False))
