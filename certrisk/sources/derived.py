"""Certificate captures derived by Spark from relational tables.

The given tables hold no certificates, so each order becomes one: its customer is
the subject, its date the start of validity, and its key picks the properties,
so that every rule fires on some rows. Expected values follow from the same
columns, which is what the oracle SQL computes, without parsing any text.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certrisk import constants as k
from certrisk.sources.captures import in_few_tasks

# The properties of capture k, in SQL that Spark and DuckDB read alike.
PROPERTIES = """
  SELECT o_orderkey AS k, o_orderdate, c_custkey, c_name, n_name,
    CASE WHEN o_orderkey % 23 = 22 THEN NULL
         WHEN o_orderkey % 10 = 0 THEN 'paypa1'
         WHEN o_orderkey % 10 = 1 THEN 'microsott'
         WHEN o_orderkey % 10 = 2 THEN 'xn--pypal-4ve.com'
         WHEN o_orderkey % 10 = 3 THEN 'pаypal.com'
         WHEN o_orderkey % 10 = 4 THEN 'paypal.com'
         WHEN o_orderkey % 10 = 5 THEN concat('*.shop', CAST(o_orderkey AS VARCHAR(20)), '.example')
         ELSE concat('host', CAST(o_orderkey AS VARCHAR(20)), '.example') END AS cn,
    concat('"', c_name, ', Ltd"') AS org,
    o_orderkey % 9 = 0 AS self_signed,
    CASE WHEN o_orderkey = 11 THEN 'Lonely CA'
         WHEN o_orderkey % 4 = 0 THEN 'R3'
         WHEN o_orderkey % 4 = 1 THEN 'DigiCert Inc'
         WHEN o_orderkey % 4 = 2 THEN 'nazwaSSL'
         ELSE 'GlobalSign' END AS ca,
    CASE WHEN o_orderkey = 11 THEN 45
         WHEN o_orderkey % 97 = 96 THEN 0
         WHEN o_orderkey % 101 = 100 THEN -3
         WHEN o_orderkey % 12 = 0 THEN 5
         WHEN o_orderkey % 12 = 1 THEN 45
         WHEN o_orderkey % 12 = 2 THEN 364
         WHEN o_orderkey % 12 = 3 THEN 800
         WHEN o_orderkey % 12 = 4 THEN 90
         WHEN o_orderkey % 12 = 5 THEN 6
         WHEN o_orderkey % 12 = 6 THEN 7
         WHEN o_orderkey % 12 = 7 THEN 29
         WHEN o_orderkey % 12 = 8 THEN 30
         WHEN o_orderkey % 12 = 9 THEN 89
         WHEN o_orderkey % 12 = 10 THEN 398
         ELSE 399 END AS days,
    CASE WHEN o_orderkey % 13 = 12 THEN 'sql'
         WHEN o_orderkey % 17 = 16 THEN 'mixed' ELSE 'openssl' END AS date_form,
    CASE WHEN o_orderkey % 6 = 0 THEN 2048
         WHEN o_orderkey % 6 = 1 THEN 1024
         WHEN o_orderkey % 6 = 2 THEN 4096
         WHEN o_orderkey % 6 = 3 THEN 256
         WHEN o_orderkey % 6 = 4 THEN 2047 END AS bits,
    CASE WHEN o_orderkey % 6 = 3 THEN 'id-ecPublicKey' ELSE 'rsaEncryption' END AS key_type,
    CASE WHEN o_orderkey % 7 % 3 = 0 THEN 'sha256WithRSAEncryption'
         WHEN o_orderkey % 7 % 3 = 1 THEN 'sha1WithRSAEncryption'
         ELSE 'md5WithRSAEncryption' END AS sig,
    CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 + o_orderkey % 3 END AS chain,
    CASE WHEN o_orderkey % 2 = 0 THEN 'TLSv1.3' ELSE 'TLSv1.2' END AS protocol,
    o_orderkey % 6 = 0 AS has_link,
    o_orderkey % 7 = 0 AS has_alarm,
    o_orderkey % 8 = 0 AS has_peer,
    CASE WHEN o_orderkey % 10 IN (0, 1, 2, 3, 5) THEN 'phishing' ELSE 'benign' END AS label
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
"""
TABLES = ("orders", "customer", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan of too few files one partition per core; leave any other scan alone.

    For work that costs far more than reading, such as counting characters.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of certificate properties per order."""
    sql = PROPERTIES
    for name in TABLES:
        sql = sql.replace(f"FROM {name}\n", f"FROM {{{name}}}\n").replace(
            f"JOIN {name} ON", f"JOIN {{{name}}} ON")
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    # Text is made and parsed after this point, about a thousand bytes per row, so
    # the partition count follows from the row count (read from the file footers).
    rows = tables["orders"].count()
    n = max(spark.sparkContext.defaultParallelism, rows // 100_000)
    return spark.sql(sql, **tables).repartition(n, "k")


def _openssl_date(day: Column) -> Column:
    return F.concat(
        F.date_format(day, "MMM"), F.lit(" "), F.lpad(F.dayofmonth(day).cast("string"), 2, " "),
        F.lit(" 00:00:00 "), F.date_format(day, "yyyy"), F.lit(" GMT"))


def _sql_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd 00:00:00")


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def cert_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handshake dumps as text: ``path, file_name, label, file_type, text``."""
    c = F.col
    subject = F.concat(
        F.lit("C = "), c("n_name"), F.lit(", O = "), c("org"),
        F.when(c("cn").isNotNull(), F.concat(F.lit(", CN = "), c("cn"))).otherwise(""))
    # A self-signed issuer repeats the subject in another order.
    issuer = F.when(c("self_signed"), F.concat(
        F.when(c("cn").isNotNull(), F.concat(F.lit("CN = "), c("cn"), F.lit(", "))).otherwise(""),
        F.lit("O = "), c("org"), F.lit(", C = "), c("n_name"))).otherwise(
        F.concat(F.lit("C = US, O = Issuing Org, CN = "), c("ca")))
    start, end = c("o_orderdate").cast("date"), F.date_add(c("o_orderdate").cast("date"), c("days").cast("int"))
    chain_lines = F.array_join(F.transform(
        F.when(c("chain") > 0, F.sequence(F.lit(0), c("chain").cast("int") - 1)),
        lambda i: F.concat(F.lit(" "), i.cast("string"), F.lit(" s:entry\n   i:parent"))), "\n")
    host = F.concat(F.lit("host"), c("k").cast("string"), F.lit(".example"))
    df = properties(spark, sf_dir).withColumns({
        "_subject": subject, "_issuer": issuer, "_chain": chain_lines, "_host": host,
        "_nb": F.when(c("date_form") == "sql", _sql_date(start)).otherwise(_openssl_date(start)),
        "_na": F.when(c("date_form") == "openssl", _openssl_date(end)).otherwise(_sql_date(end))})
    text = F.concat(_lines(
        "CONNECTED(00000003)", "---",
        F.when(c("chain") > 0, F.concat(F.lit("Certificate chain\n"), c("_chain"))),
        "---", "Server certificate",
        F.concat(F.lit("subject="), c("_subject")),
        F.concat(F.lit("issuer="), c("_issuer")),
        F.concat(F.lit("notBefore="), c("_nb")),
        F.concat(F.lit("notAfter="), c("_na")),
        F.concat(F.lit("    Signature Algorithm: "), c("sig")),
        F.concat(F.lit("    Public Key Algorithm: "), c("key_type")),
        F.when(c("bits").isNotNull(), F.concat(
            F.lit("        Public-Key: ("), c("bits").cast("string"), F.lit(" bit)"))),
        "---",
        F.concat(F.lit("New, "), c("protocol"), F.lit(", Cipher is DEMO-AES256")),
        F.concat(F.lit("    Protocol  : "), c("protocol")),
        F.concat(F.lit("    Cipher    : DEMO-AES256-"), (c("k") % 5).cast("string")),
        F.when(c("has_link"), F.concat(
            F.lit("https://"), c("_host"), F.lit("/login?id="), c("k").cast("string"),
            F.lit("\nPlease verify and confirm your account"))),
        F.when(c("has_alarm"), F.lit("URGENT: renew your update channel")),
        F.when(c("has_peer"), F.concat(
            F.lit("peer 10.0."), (c("k") % 256).cast("string"), F.lit(".7 admin@"), c("_host")))),
        F.lit("\n---\n"))
    return df.select(
        F.concat(F.lit("captures/"), c("label"), F.lit("/"), c("k").cast("string")).alias("path"),
        F.concat(F.lit("capture-"), c("k").cast("string")).alias("file_name"),
        "label", F.lit("openssl_text").alias("file_type"), text.alias("text"), "k")


def is_mounted(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is a folder of the machines' own file system."""
    if "://" not in root and not root.startswith("file:"):
        root = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return root.startswith("file:")


def write_files(rows: DataFrame, root: str, name: str = "") -> None:
    """The ``text`` of each row and a line end, as a file of its own below ``root/label/name``.

    In a mounted folder tasks write the files themselves: without native code, Hadoop's local file system starts a process
    for the mode of each file and one for that of its checksum, which costs far more than the files. A task that is tried again writes the
    same files. In any other folder Spark's writer makes them.
    """
    places = {label: f"{root}/{label}/{name}".rstrip("/") for label in ("benign", "phishing")}
    if not is_mounted(rows.sparkSession, root):
        for label, place in places.items():
            rows.filter(F.col("label") == label).select("text").write.option("maxRecordsPerFile", 1).text(place)
        return
    places = {label: place.removeprefix("file://").removeprefix("file:") for label, place in places.items()}
    for place in places.values():
        os.makedirs(place)

    def write(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for label, text in zip(*(batch.column(c).to_pylist() for c in ("label", "text"))):
                with open(f"{places[label]}/part-{part:05}-{n:07}.txt", "wb") as file:
                    file.write(f"{text or ''}\n".encode("utf-8", "surrogatepass"))
                n += 1
            yield batch.select(["label"])

    rows.select("label", "text").sortWithinPartitions("label", "text").mapInArrow(write, "label string").count()


def checksums(data: bytes) -> bytes:
    """What Hadoop's local file system keeps beside a file: a header and the CRC-32 of each 512 bytes."""
    return b"crc\0" + struct.pack(">I", 512) + b"".join(
        struct.pack(">I", zlib.crc32(data[at:at + 512])) for at in range(0, len(data), 512))


def spoil(spark: SparkSession, root: str, chosen: Column) -> None:
    """Add a byte to the files below ``root`` whose ``text`` is ``chosen``, and leave the checksums of what they were beside them.

    Tasks write to the files themselves, which needs the checksums of a local file system.
    """
    files = in_few_tasks(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "content"))

    def add(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                folder, name = os.path.split(path.removeprefix("file://").removeprefix("file:"))
                with open(f"{folder}/.{name}.crc", "wb") as file:
                    file.write(checksums(bytes(content)))
                with open(f"{folder}/{name}", "wb") as file:
                    file.write(content + b"!")
            yield batch[["path"]]

    rows = files.withColumn("text", F.col("content").cast("string")).filter(chosen).select("path", "content")
    rows.mapInPandas(add, "path string").count()


def element(tag: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    size = len(body)
    if size < 0x80:
        return bytes([tag, size]) + body
    raw = size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag, 0x80 | len(raw)]) + raw + body


NAME_IDS = {v: n for n, v in k.NAME_OIDS.items()}
SIGNATURE_IDS = {v: n for n, v in k.SIGNATURE_OIDS.items()}
CURVE_IDS = {v: n for n, v in k.CURVE_BITS.items()}


@lru_cache
def object_id(dotted: str) -> bytes:
    first, second, *rest = map(int, dotted.split("."))
    out = bytearray()
    for value in [first * 40 + second, *rest]:
        chunk = [value & 0x7F]
        while value := value >> 7:
            chunk.append(value & 0x7F | 0x80)
        out += bytes(reversed(chunk))
    return element(0x06, bytes(out))


def make_der(cn, org, country, issuer_cn, start, end, bits, key_type, signature, san) -> bytes:
    """An unsigned test certificate with the given fields."""
    sig_oid = SIGNATURE_IDS[signature]

    def name(**fields):
        return element(0x30, *[
            element(0x31, element(0x30, object_id(NAME_IDS[key]), element(0x0C, value.encode())))
            for key, value in fields.items() if value is not None])

    def time(day):
        year = day.year
        if 1950 <= year < 2050:
            return element(0x17, day.strftime("%y%m%d000000Z").encode())
        return element(0x18, day.strftime("%Y%m%d000000Z").encode())

    if key_type == "EC":
        curve = CURVE_IDS[bits]
        key = element(0x30, element(0x30, object_id("1.2.840.10045.2.1"), object_id(curve)),
                      element(0x03, b"\0\4" + bytes(2 * ((bits + 7) // 8))))
    else:
        modulus = (1 << bits - 1 | 1).to_bytes(bits // 8 + 1, "big")
        key = element(0x30, element(0x30, object_id("1.2.840.113549.1.1.1"), b"\x05\0"),
                      element(0x03, b"\0" + element(
                          0x30, element(0x02, modulus), element(0x02, b"\1\0\1"))))
    extensions = element(0xA3, element(0x30, element(
        0x30, object_id(k.SAN_OID), element(0x04, element(
            0x30, *[element(0x82, s.encode()) for s in san]))))) if len(san) else b""
    algorithm = element(0x30, object_id(sig_oid), b"\x05\0")
    body = element(
        0x30, element(0xA0, b"\2\1\2"), element(0x02, b"\1"), algorithm, name(CN=issuer_cn, O="Issuing Org"),
        element(0x30, time(start), time(end)), name(C=country, O=org, CN=cn), key, extensions)
    return element(0x30, body, algorithm, element(0x03, b"\0" + bytes(64)))


@F.pandas_udf(T.BinaryType())
def der_column(cn: pd.Series, org: pd.Series, country: pd.Series, ca: pd.Series, start: pd.Series,
               end: pd.Series, bits: pd.Series, key_type: pd.Series, sig: pd.Series,
               san: pd.Series) -> pd.Series:
    return pd.Series([make_der(*row) for row in zip(
        cn, org, country, ca, start, end, bits, key_type, sig, san)])


def cert_ders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary certificates: ``k, label, der``."""
    c = F.col
    host = F.concat(F.lit("host"), c("k").cast("string"), F.lit(".example"))
    df = properties(spark, sf_dir).withColumns({
        "_start": c("o_orderdate").cast("date"),
        "_end": F.date_add(c("o_orderdate").cast("date"), c("days").cast("int")),
        "_bits": F.when(c("bits") == 256, 256).otherwise(
            F.when(c("bits") == 2047, 2048).otherwise(F.coalesce("bits", F.lit(4096)))).cast("int"),
        "_kind": F.when(c("bits") == 256, "EC").otherwise("RSA"),
        "_san": F.when(c("k") % 3 == 0, F.array().cast("array<string>")).otherwise(
            F.array(host, F.concat(F.lit("www."), host)))})
    return df.select("k", "label", der_column(
        "cn", "c_name", "n_name", "ca", "_start", "_end", "_bits", "_kind", "sig", "_san").alias("der"))
