"""Validity dates written as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPENSSL = r"(?i)^([a-z]{3} \d{1,2} \d{1,2}:\d{1,2}:\d{1,2} \d{4}) (?:GMT|UTC)$"
_SQL = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_ISO = r"^(\d{4}-\d\d-\d\d)T(\d\d:\d\d:\d\d)(?:\+00:00|Z)$"


def squeezed(c: Column) -> Column:
    """Single spaces, as both text forms need: days may be padded."""
    return F.regexp_replace(c, r"\s+", " ")


def openssl_time(text: Column) -> Column:
    """``Jan 1 00:00:00 2024 GMT`` as a timestamp, NULL for anything else."""
    body = F.nullif(F.regexp_extract(text, _OPENSSL, 1), F.lit(""))
    return F.try_to_timestamp(F.concat(body, F.lit(" UTC")), F.lit("MMM d H:m:s yyyy z"))


def sql_time(text: Column) -> Column:
    """``2024-01-01 00:00:00`` read as UTC."""
    return F.when(F.rlike(text, F.lit(_SQL)), F.try_to_timestamp(
        F.concat(text, F.lit(" UTC")), F.lit("yyyy-M-d H:m:s z")))


def iso_time(text: Column) -> Column:
    """``2024-01-01T00:00:00+00:00``, the form the X.509 decoder writes."""
    return F.when(F.rlike(text, F.lit(_ISO)), F.try_to_timestamp(
        F.regexp_replace(text, _ISO, "$1 $2 UTC"), F.lit("yyyy-MM-dd HH:mm:ss z")))


def whole_days(start: Column, end: Column) -> Column:
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    return F.floor(seconds / F.lit(86400)).cast("int")


def with_validity(df: DataFrame, not_before: str, not_after: str) -> DataFrame:
    """Add ``not_before_ts, not_after_ts`` and ``text_days``, the days between two text
    dates, which must be written the same way."""
    helpers = [f"_{end}_{form}" for end in ("nb", "na") for form in ("text", "openssl", "sql")]
    df = df.withColumns({
        "_nb_text": squeezed(F.col(not_before)), "_na_text": squeezed(F.col(not_after))})
    df = df.withColumns({
        f"_{end}_{form}": read(F.col(f"_{end}_text"))
        for end in ("nb", "na") for form, read in (("openssl", openssl_time), ("sql", sql_time))})

    def moment(end: str) -> Column:
        return F.coalesce(f"_{end}_openssl", f"_{end}_sql", iso_time(F.col(f"_{end}_text")))

    return df.withColumns({
        "not_before_ts": moment("nb"), "not_after_ts": moment("na"),
        "text_days": F.coalesce(
            whole_days(F.col("_nb_openssl"), F.col("_na_openssl")),
            whole_days(F.col("_nb_sql"), F.col("_na_sql")))}).drop(*helpers)
