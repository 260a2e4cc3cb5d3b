import glob
import shutil
import subprocess
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from certrisk.functions import x509
from certrisk.functions.dates import with_validity
from certrisk.functions.names import parse_dn
from certrisk.functions.x509 import moment
from certrisk.operators.parse import parse, parse_certificate
from certrisk.sources.captures import file_type
from certrisk.sources.derived import make_der
from helpers import one, raw, value

DUMP = """CONNECTED(00000005)
Certificate chain
 0 s:C = NO, O = Fjord Verksted, CN = verksted.example
   i:C = NO, O = Nordic Root, CN = N7
---
subject=C = NO, O = Fjord Verksted, CN = verksted.example
issuer=C = NO, O = Nordic Root, CN = N7
"""
# Bytes that are no certificate.
BROKEN_PEM = """-----BEGIN CERTIFICATE-----
bm8gY2VydGlmaWNhdGUgYXQgYWxs
!!!
-----END CERTIFICATE-----"""


def test_text_dump(spark):
    row = parse(raw(spark, DUMP)).first()
    assert row.subject == {"C": "NO", "O": "Fjord Verksted", "CN": "verksted.example"}
    assert row.issuer["CN"] == "N7"
    assert row.chain_length == 1 and row.san == [] and row.validity_days is None
    assert row.parse_warnings == []


def test_broken_pem_keeps_the_row(spark):
    row = parse(raw(spark, BROKEN_PEM, kind="pem")).first()
    assert row.file_name == "f0" and row.chain_length == 1 and row.pem is None
    assert row.parse_warnings[0].startswith("PEM parsing error")


def test_pem_without_block_gives_no_text_fields(spark):
    row = parse(raw(spark, "-----BEGIN CERTIFICATE-----\nsubject=CN = a\n", kind="pem")).first()
    assert row.parse_warnings == ["No PEM blocks found"] and row.subject == {}


def test_unknown_type_falls_back(spark):
    text = "-----BEGIN CERTIFICATE-----\nsubject=CN = a\n"
    row = parse(raw(spark, text, kind="unknown")).first()
    assert row.parse_warnings == ["No PEM blocks found"] and row.subject == {"CN": "a"}
    row = parse(raw(spark, "words that mean nothing here", kind="unknown")).first()
    assert row.parse_warnings == [] and row.raw_text == "words that mean nothing here"


def test_convenience(spark):
    row = parse_certificate(spark, "plain words", "unknown", "one.capture").first()
    assert (row.file_name, row.raw_text) == ("one.capture", "plain words")


def test_names_without_line_end_do_not_match(spark):
    assert one(parse(raw(spark, "subject=CN = a")), "subject") == {}


@pytest.mark.parametrize("dn, expected", [
    ("C=US, O=Company", {"C": "US", "O": "Company"}),
    ('O = "A, B", CN = x', {"O": '"A, B"', "CN": "x"}),
    ("CN=a,CN=b,O=c", {"CN": "b", "O": "c"}),
    ("nothing here", {}),
    ("/C=US/O=Old/CN=style", {"/C": "US/O=Old/CN=style"}),
    ("CN=a=b", {"CN": "a=b"}),
    ('O=x" , CN=y', {"O": 'x"', "CN": "y"}),
    ('A=1, B="2, C=3', {"A": '1, B="2', "C": "3"}),
    ("", {}),
])
def test_dn(spark, dn, expected):
    assert value(spark, parse_dn(F.lit(dn))) == expected


def test_dn_with_very_many_quotes(spark):
    dn = "CN=a, O=" + '"x,y",' * 20_000 + "L=z"
    got = value(spark, parse_dn(F.lit(dn)))
    assert got["CN"] == "a" and got["L"] == "z"


@pytest.mark.parametrize("start, end, days", [
    ("Jan  1 00:00:00 2024 GMT", "Jan 31 00:00:00 2024 GMT", 30),
    ("jan 1 00:00:00 2024 UTC", "Jan  1 12:00:00 2024 GMT", 0),
    ("Jan  2 00:00:00 2024 GMT", "Jan  1 12:00:00 2024 GMT", -1),
    ("2024-01-01 00:00:00", "2024-03-01 00:00:00", 60),
    ("2024-01-01 00:00:00", "Jan  1 00:00:00 2024 GMT", None),
    ("Jan  1 00:00:00 2024 PST", "Jan  1 00:00:00 2024 GMT", None),
    ("Feb 30 00:00:00 2024 GMT", "Mar  1 00:00:00 2024 GMT", None),
    ("soon", None, None),
])
def test_validity(spark, start, end, days):
    df = spark.createDataFrame([(start, end)], "nb string, na string")
    assert one(with_validity(df, "nb", "na"), "text_days") == days


def test_validity_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame(
        [("Mar 30 12:00:00 2024 GMT", "Mar 31 12:00:00 2024 GMT")], "nb string, na string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert one(with_validity(df, "nb", "na"), "text_days") == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_handshake_and_keys(spark):
    text = ("    Protocol  : TLSv1.3 \n    Cipher    : AES\nPublic Key Algorithm: id-ecPublicKey\n"
            "Public-Key: (256 bit)\nSignature Algorithm: ecdsa-with-SHA256\nsee https://a.example/x y\n"
            "notBefore=Jan  1 00:00:00 2024 GMT\nNot Before: Jan  2 00:00:00 2024 GMT\n")
    row = parse(raw(spark, text)).first()
    assert tuple(row.handshake) == ("AES", "TLSv1.3", "https://a.example/x")
    assert (row.pubkey_bits, row.pubkey_type) == (256, "id-ecPublicKey")
    assert row.signature_algorithm == "ecdsa-with-SHA256"
    assert row.not_before == "Jan  1 00:00:00 2024 GMT" and row.not_after is None


def test_first_match_not_first_word(spark):
    text = ("the subject of İstanbul notes SUBJECT:CN = a\nissuer unknown, Issuer=CN = b\n"
            "publicly seen, public KEY: (512 bit)\nno Protocol, Protocol : TLS\n")
    row = parse(raw(spark, text)).first()
    assert (row.subject, row.issuer) == ({"CN": "a"}, {"CN": "b"})
    assert row.pubkey_bits == 512 and row.handshake.protocol == "TLS"


def der(**over):
    args = dict(cn="a.example", org="Org", country="DE", issuer_cn="CA", start=date(2020, 1, 1),
                end=date(2020, 3, 31), bits=2048, key_type="RSA",
                signature="sha256WithRSAEncryption", san=["a.example"])
    args.update(over)
    return make_der(**args)


def test_der(spark):
    row = parse_certificate(spark, der(), "der", "c").first()
    assert row.subject == {"CN": "a.example", "O": "Org", "C": "DE"}
    assert row.not_before == "2020-01-01T00:00:00+00:00" and row.validity_days == 90
    assert row.not_before_ts is not None and row.raw_text == "" and row.chain_length == 1
    assert (row.pubkey_type, row.pubkey_bits, row.san) == ("RSA", 2048, ["a.example"])
    assert row.pem.startswith("-----BEGIN CERTIFICATE-----\n") and row.parse_warnings == []
    assert max(map(len, row.pem.splitlines())) == 64


def test_text_wins_over_certificate_in_names(spark):
    import base64
    block = ("-----BEGIN CERTIFICATE-----\n" + base64.encodebytes(der()).decode()
             + "-----END CERTIFICATE-----\n")
    df = parse(raw(spark, block + block + "subject=O = Text Org, X = y\n", kind="pem"))
    row = df.withColumn("keys", F.map_keys("subject")).first()
    assert row.subject == {"CN": "a.example", "O": "Text Org", "C": "DE", "X": "y"}
    assert row["keys"] == ["CN", "O", "C", "X"] and row.chain_length == 2
    assert row.pem + "\n" == block


def test_damaged_der_is_a_warning(spark):
    data = der()
    for cut in (1, 10, 50, 120, len(data) - 1):
        row = parse_certificate(spark, data[:cut], "der", "c").first()
        assert row.parse_warnings and row.parse_warnings[0].startswith("DER parsing error")


def test_walker_never_raises():
    import random
    rng = random.Random(7)
    data = bytearray(der())
    for _ in range(3000):
        bad = bytearray(data)
        for _ in range(rng.randint(1, 6)):
            bad[rng.randrange(len(bad))] = rng.randrange(256)
        assert isinstance(x509.decode(bytes(bad)), dict)


def test_times_after_2049():
    got = x509.decode(der(start=date(2049, 12, 31), end=date(2050, 1, 2)))
    assert got["validity_days"] == 2 and got["not_after"].startswith("2050-01-02")


def test_curves():
    for bits in (256, 384, 521):
        got = x509.decode(der(bits=bits, key_type="EC"))
        assert (got["pubkey_type"], got["pubkey_bits"]) == ("EC", bits)


@pytest.mark.skipif(shutil.which("openssl") is None, reason="needs the openssl command")
def test_against_openssl(spark):
    files = sorted(glob.glob("/etc/ssl/certs/*.pem"))[:40]
    if not files:
        pytest.skip("no certificates here")
    texts = [open(f, encoding="utf-8").read() for f in files]
    rows = {r.path: r for r in parse(raw(spark, *texts, kind="pem")).collect()}
    for i, f in enumerate(files):
        out = subprocess.run(
            ["openssl", "x509", "-in", f, "-noout", "-text", "-dates", "-nameopt", "multiline,utf8"],
            capture_output=True, text=True, check=True).stdout
        row = rows[f"p/{i}"]
        assert row.parse_warnings == [], f
        dates = dict(line.split("=", 1) for line in out.splitlines() if line.startswith("not"))
        for key, ours in (("notBefore", row.not_before), ("notAfter", row.not_after)):
            t = datetime.strptime(dates[key], "%b %d %H:%M:%S %Y GMT").replace(tzinfo=timezone.utc)
            assert ours == t.isoformat(), f
        assert f"({row.pubkey_bits} bit)" in out, f
        assert row.signature_algorithm.lower() in out.lower(), f
        for name, long_name in (("CN", "commonName"), ("O", "organizationName")):
            if name in row.subject:
                assert f"{long_name}" in out and row.subject[name] in out, f


def test_each_step_of_a_certificate_is_computed_once(spark):
    """Text and type given as expressions are not written into every place that reads them."""
    block = F.concat(F.lit("-----BEGIN CERTIFICATE-----\n"), F.base64("der"), F.lit("\n-----END CERTIFICATE-----\n"))
    rows = spark.createDataFrame([(bytearray(b"0"),)], "der binary").withColumn("text", F.concat(block, block)).select(
        F.lit("p").alias("path"), F.lit("f").alias("file_name"), F.lit("benign").alias("label"),
        file_type(F.col("text").cast("binary")).alias("file_type"), "text")
    plan = parse(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("BEGIN CERTIFICATE") < 20


def test_moments_out_of_the_common_form():
    assert moment(0x17, b"240229000000Z").isoformat() == "2024-02-29T00:00:00+00:00"
    assert moment(0x17, b"490101000000Z").year == 2049 and moment(0x17, b"500101000000Z").year == 1950
    for bad in (b"230229000000Z", b"2301010000Z00Z", b"23010100000000"):
        with pytest.raises(ValueError, match="does not match format|day is out of range|unconverted"):
            moment(0x17, bad)
