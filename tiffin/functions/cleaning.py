"""Typing and tidying of all-text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters after which title casing starts a new word.
WORD_BREAKS = r"""[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""

_NULL_MARK = "\u0000"
_FIELD_MARK = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Decimal from text, rounded half up; NULL when it does not parse or fit."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_number(c: Column | str) -> Column:
    """Whole number from text. ``'4.5'`` rounds to 5, so the cast goes through
    a decimal: a direct integer cast would give NULL."""
    return to_decimal(c, 38, 0).try_cast("bigint")


def strict_number(c: Column | str) -> Column:
    """Whole number from text; text that does not parse fails the job."""
    return _col(c).cast("decimal(38,0)").cast("bigint")


def strict_timestamp(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def strict_date(c: Column | str) -> Column:
    return _col(c).cast("date")


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter after blanks and punctuation alike."""
    words = F.split(F.lower(_col(c)), f"(?<={WORD_BREAKS})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), ""
    )


def last_part(c: Column | str) -> Column:
    """Text after the last comma, trimmed; the whole text when nothing follows."""
    c = _col(c)
    return F.trim(F.coalesce(F.regexp_substr(c, F.lit("[^,]+$")), c))


def first_digits(c: Column | str) -> Column:
    """The first run of digits as a number."""
    return to_number(F.regexp_substr(_col(c), F.lit("[0-9]+")))


def record_hash(columns: Sequence[str], compat: bool = False) -> Column:
    """MD5 over the fields of a row.

    NULL and empty text hash differently. With ``compat`` the fields are joined
    by ``|`` and any NULL makes the hash NULL.
    """
    if compat:
        parts: list[Column] = []
        for i, name in enumerate(columns):
            parts += ([F.lit("|")] if i else []) + [F.col(name)]
        return F.md5(F.concat(*parts))
    return F.md5(F.concat_ws(_FIELD_MARK, *[F.coalesce(F.col(c), F.lit(_NULL_MARK)) for c in columns]))


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b``; 0 when ``b`` is 0, NULL when ``a`` is NULL."""
    return F.when(a.isNull(), None).when(b == 0, F.lit(0)).otherwise(F.try_divide(a, b))
