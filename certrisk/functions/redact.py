"""Masking of addresses in text and in parsed certificates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk import constants as k


def redact_ips(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)" + k.IP_ADDRESS, k.IP_MASK)


def redact_emails(c: Column) -> Column:
    # Texts without an "@" cannot match, and skipping them avoids the slow search.
    return F.when(F.contains(c, F.lit("@")),
                  F.regexp_replace(c, "(?U)" + k.EMAIL, k.EMAIL_MASK)).otherwise(c)


def redact_text(c: Column) -> Column:
    return redact_emails(redact_ips(c))


def redact_certificates(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Mask IPs and e-mails in ``raw_text`` and e-mails in the name maps."""
    if not enabled:
        return df
    masked = {"raw_text": redact_text(F.col("raw_text"))}
    for name in ("subject", "issuer"):
        masked[name] = F.transform_values(name, lambda _, v: redact_emails(v))
    return df.withColumns({n: c for n, c in masked.items() if n in df.columns})
