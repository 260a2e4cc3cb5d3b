"""Captures to one typed row per certificate.

Input columns: ``path, file_name, label, file_type, text`` and, for binary files,
``content``. All text fields are built-in expressions; only the X.509 decoder is
a batch function, and it sees certificate bytes alone, never the capture text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.functions import dates
from certrisk.functions.names import ENTRIES, computed_once, dn_entries, entries_to_map
from certrisk.functions.text import found
from certrisk.functions.x509 import X509_TYPE, decode_x509

PEM_BLOCK = f"(?s){k.PEM_BEGIN}.*?{k.PEM_END}"
NAME_KEYS = ("CN", "O", "OU", "C", "ST", "L")
PARSED_COLUMNS = (
    "path", "file_name", "label", "pem", "subject", "issuer", "san", "not_before", "not_after",
    "not_before_ts", "not_after_ts", "validity_days", "pubkey_type", "pubkey_bits",
    "signature_algorithm", "raw_text", "handshake", "chain_length", "parse_warnings")


def _pem_bytes(block: Column) -> Column:
    body = F.regexp_replace(block, rf"{k.PEM_BEGIN}|{k.PEM_END}|\s", "")
    return F.try_to_binary(body, F.lit("base64"))


def _as_pem(der: Column) -> Column:
    body = F.regexp_replace(F.regexp_replace(F.base64(der), r"\s", ""), "(.{64})(?=.)", "$1\n")
    return F.concat(F.lit(k.PEM_BEGIN + "\n"), body, F.lit("\n" + k.PEM_END + "\n"))


def _name_entries(prefix: str) -> Column:
    pairs = F.array(*[
        F.struct(F.lit(key).alias("key"), F.col(f"_x.{prefix}{key}").alias("value"))
        for key in NAME_KEYS])
    return F.coalesce(F.filter(pairs, lambda e: e["value"].isNotNull()), F.array().cast(ENTRIES))


def after(word: str, searched: Column | None = None) -> Column:
    """The capture text from the first occurrence of a word on; NULL without one.

    A pattern that starts with the word cannot match earlier, and finding a word is
    several times faster than trying a pattern at every character.
    """
    searched = F.col("_low") if searched is None else searched
    return F.substr(F.col("_t"), F.nullif(F.instr(searched, word), F.lit(0)))


def _or_else(first: Column, second: Column) -> Column:
    """``second`` where ``first`` is NULL or zero."""
    return F.coalesce(F.nullif(first, F.lit(0)), second, first)


def parse(df: DataFrame, decode: bool = True) -> DataFrame:
    """Parse captures of any type.

    ``decode=False`` leaves out the X.509 step for corpora known to hold only
    text dumps, so that no row crosses to Python.
    """
    columns = df.columns
    if decode:
        df = computed_once(df, {"file_type": F.col("file_type"), "text": F.col("text")})
    kind, text = F.col("file_type"), F.col("text")
    is_der = kind == "der"
    wants_pem = (kind == "pem") | (
        ~kind.isin("pem", "der", "openssl_text") & F.contains(text, F.lit(k.PEM_BEGIN)))
    blocks = F.when(wants_pem, F.regexp_extract_all(text, F.lit(PEM_BLOCK), F.lit(0)))
    found_blocks = {"_wants_pem": F.coalesce(wants_pem, F.lit(False)), "_blocks": blocks}
    df = computed_once(df, found_blocks) if decode else df.withColumns(found_blocks)
    df = (
        df.withColumn("_block", F.get("_blocks", F.lit(0)))
        .withColumn("_n_blocks", F.coalesce(F.size("_blocks"), F.lit(0))))
    if decode:
        content = F.col("content") if "content" in columns else F.lit(None).cast("binary")
        df = computed_once(df, {"_der": F.when(is_der, content).otherwise(_pem_bytes(F.col("_block")))})
        df = df.withColumn("_x", decode_x509("_der"))
    else:
        df = df.withColumn("_der", F.lit(None).cast("binary"))
        df = df.withColumn("_x", F.lit(None).cast(X509_TYPE))

    # A PEM-typed file without a complete block, and a DER file, give no text fields.
    t = F.when(~is_der & ~((kind == "pem") & (F.col("_n_blocks") == 0)), text)
    df = df.withColumn("_t", t)
    # Lower case keeps every position once the one letter that grows is out of the way.
    df = df.withColumn("_low", F.lower(F.replace("_t", F.lit("\u0130"), F.lit("i"))))
    t = F.col("_t")
    not_before = F.coalesce(
        F.col("_x.not_before"), found(after("notbefore"), k.NOT_BEFORE_LINE))
    not_after = F.coalesce(F.col("_x.not_after"), found(after("notafter"), k.NOT_AFTER_LINE))
    loaded = F.coalesce(F.col("_x.loaded"), F.lit(False))
    chain = F.greatest(
        F.when(is_der, (F.col("_x.signature_algorithm").isNotNull()).cast("int"))
        .otherwise(F.col("_n_blocks")),
        F.coalesce(F.regexp_count(t, F.lit(k.CHAIN_LINE)), F.lit(0)))
    bits = found(after("public"), k.KEY_BITS).try_cast("int")
    warnings = [F.when(F.col("_wants_pem") & (F.col("_n_blocks") == 0), F.lit("No PEM blocks found"))]
    if decode:
        problem = F.coalesce(F.col("_x.error"),
                             F.when(F.col("_der").isNull(), F.lit("invalid base64")))
        warnings += [
            F.when(is_der, F.concat(F.lit("DER parsing error: "), problem)),
            F.when(F.col("_n_blocks") > 0, F.concat(F.lit("PEM parsing error: "), problem))]

    def names(prefix: str, word: str, pattern: str) -> Column:
        """Text values come last and so win over those of the certificate."""
        from_text = dn_entries(found_line(after(word), pattern))
        return F.concat(_name_entries(prefix), from_text) if decode else from_text

    df = df.withColumns({
        "pem": F.when(loaded, F.when(is_der, _as_pem(F.col("_der"))).otherwise(F.col("_block"))),
        "subject": entries_to_map(names("", "subject", k.SUBJECT_LINE)),
        "issuer": entries_to_map(names("issuer_", "issuer", k.ISSUER_LINE)),
        "san": F.coalesce(F.col("_x.san"), F.array().cast("array<string>")),
        "not_before": not_before,
        "not_after": not_after,
        "_bits": bits,
        "pubkey_type": F.coalesce(
            F.col("_x.pubkey_type"), found(after("public key algorithm:"), k.KEY_TYPE)),
        "signature_algorithm": F.coalesce(
            F.col("_x.signature_algorithm"), found(after("signature algorithm:"), k.SIGNATURE)),
        "handshake": F.struct(
            found(after("Cipher", t), k.CIPHER).alias("cipher"),
            found(after("Protocol", t), k.PROTOCOL).alias("protocol"),
            F.nullif(F.regexp_extract(after("http", t), "(?U)" + k.URL, 0), F.lit("")).alias("url")),
        "chain_length": chain,
        "parse_warnings": F.array_compact(F.array(*warnings)),
        "raw_text": F.when(is_der, F.lit("")).otherwise(F.coalesce(text, F.lit(""))),
    })
    df = dates.with_validity(df, "not_before", "not_after").withColumns({
        "validity_days": _or_else(F.col("_x.validity_days"), F.col("text_days")),
        "pubkey_bits": _or_else(F.col("_x.pubkey_bits"), F.col("_bits")),
    })
    extra = [c for c in columns if c not in PARSED_COLUMNS and c not in ("text", "content")]
    return df.select(*PARSED_COLUMNS, *extra)


def found_line(t: Column, pattern: str) -> Column:
    """The matched line, NULL when there is none (an empty name has no parts either)."""
    return F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))


def parse_certificate(spark, raw_content: str | bytes, file_type: str, file_name: str) -> DataFrame:
    """One capture held by the caller; the same expressions as for a corpus."""
    binary = isinstance(raw_content, bytes)
    kind = "der" if binary else file_type
    row = [(file_name, file_name, "unknown", kind,
            None if binary else raw_content, raw_content if binary else None)]
    df = spark.createDataFrame(
        row, "path string, file_name string, label string, file_type string, "
             "text string, content binary")
    return parse(df)
