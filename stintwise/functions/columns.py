"""Small column builders.  Each returns a ``Column``; none runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_active(flag: str = "tookPart") -> Column:
    """``tookPart = True``: a null flag is not active (SQL three-valued logic).

    The bare boolean column is used so that a derived flag is pushed into the scan.
    """
    return F.col(flag)


def took_part(rounds: Column | str = "rounds") -> Column:
    """An entry took part when it names rounds; an empty list still counts."""
    c = F.col(rounds) if isinstance(rounds, str) else rounds
    return c.isNotNull()


def flag_or_false(flag: Column | str) -> Column:
    """Optional boolean that defaults to false when absent."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(c, F.lit(False))


def year_from_path(path: Column | str) -> Column:
    """Integer year of the folder that holds a file: ``.../<year>/f`` or ``.../year=<year>/f``.

    Null for any other path (``try_cast``: under ANSI mode a plain cast of the
    empty match would fail the job).
    """
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(c, r"/(?:year=)?(\d+)/[^/]*$", 1).try_cast("int")
