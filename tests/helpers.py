"""Small frames for the tests."""

from pyspark.sql import functions as F

RAW = "path string, file_name string, label string, file_type string, text string, content binary"


def raw(spark, *texts, kind="openssl_text"):
    rows = [(f"p/{i}", f"f{i}", "unknown", kind, t, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, RAW)


PARSED = (
    "path string, file_name string, label string, pem string, subject map<string,string>, "
    "issuer map<string,string>, san array<string>, not_before string, not_after string, "
    "validity_days int, pubkey_type string, pubkey_bits int, signature_algorithm string, "
    "raw_text string, chain_length int, parse_warnings array<string>")


def parsed(spark, **over):
    """A clean certificate with some fields replaced."""
    row = dict(
        path="p/0", file_name="f", label="benign", pem=None, subject={"CN": "www.example.org"},
        issuer={"CN": "DigiCert TLS"}, san=["www.example.org"], not_before=None, not_after=None,
        validity_days=90, pubkey_type="RSA", pubkey_bits=2048,
        signature_algorithm="sha256WithRSAEncryption", raw_text="plain", chain_length=2,
        parse_warnings=[])
    row.update(over)
    return spark.createDataFrame([tuple(row.values())], PARSED)


def one(df, *columns):
    row = df.select(*columns).collect()
    assert len(row) == 1
    return row[0] if len(columns) != 1 else row[0][0]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


__all__ = ["F", "RAW", "raw", "parsed", "one", "value", "rows_of"]
