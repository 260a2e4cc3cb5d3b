"""X.509 fields from DER bytes, as an Arrow batch function.

Spark has no ASN.1 function, so this small walker over tag-length-value triples
runs inside a pandas UDF. It reads the fields the scorer needs and no more:
no signature or chain is checked. Every length is checked against its parent,
nothing recurses, and an error becomes a message beside the fields read so far.
"""

from __future__ import annotations

import ipaddress
from datetime import datetime, timezone
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certrisk import constants as k

_TEXT = ("CN", "O", "OU", "C", "ST", "L")
X509_TYPE = T.StructType([
    T.StructField("loaded", T.BooleanType()),
    *[T.StructField(n, T.StringType()) for n in _TEXT],
    *[T.StructField(f"issuer_{n}", T.StringType()) for n in _TEXT],
    T.StructField("san", T.ArrayType(T.StringType())),
    T.StructField("not_before", T.StringType()),
    T.StructField("not_after", T.StringType()),
    T.StructField("validity_days", T.IntegerType()),
    T.StructField("pubkey_type", T.StringType()),
    T.StructField("pubkey_bits", T.IntegerType()),
    T.StructField("signature_algorithm", T.StringType()),
    T.StructField("error", T.StringType()),
])
FIELD_NAMES = X509_TYPE.fieldNames()
INT_FIELDS = ("validity_days", "pubkey_bits")
_MOMENT_PARTS = ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14))


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]]:
    """(tag, body start, body end) of the elements between two offsets."""
    out = []
    while start < end:
        if start + 2 > end:
            raise ValueError("truncated element")
        tag, length, body = data[start], data[start + 1], start + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or body + size > end:
                raise ValueError("bad length")
            length = int.from_bytes(data[body:body + size], "big")
            body += size
        if body + length > end:
            raise ValueError("element exceeds its parent")
        out.append((tag, body, body + length))
        start = body + length
    return out


def oid(data: bytes, start: int, end: int) -> str:
    return _dotted(data[start:end])


@lru_cache(10_000)
def _dotted(raw: bytes) -> str:
    arcs, value = [], 0
    for byte in raw:
        value = value << 7 | byte & 0x7F
        if not byte & 0x80:
            arcs.append(value)
            value = 0
    if not arcs:
        raise ValueError("empty object identifier")
    first = min(arcs[0] // 40, 2)
    return ".".join(map(str, [first, arcs[0] - 40 * first, *arcs[1:]]))


def text_value(tag: int, raw: bytes) -> str:
    codec = {0x1E: "utf-16-be", 0x1C: "utf-32-be", 0x14: "latin-1"}.get(tag, "utf-8")
    return raw.decode(codec, "replace")


def name_fields(data: bytes, start: int, end: int) -> dict[str, str]:
    """First value of each known attribute."""
    fields: dict[str, str] = {}
    for _, set_start, set_end in children(data, start, end):
        for _, pair_start, pair_end in children(data, set_start, set_end):
            (_, a, b), (tag, c, d) = children(data, pair_start, pair_end)[:2]
            name = k.NAME_OIDS.get(oid(data, a, b))
            if name:
                fields.setdefault(name, text_value(tag, data[c:d]))
    return fields


def moment(tag: int, raw: bytes) -> datetime:
    text = raw.decode("ascii")
    if tag == 0x17:
        text = ("19" if int(text[:2]) >= 50 else "20") + text
    if len(text) == 15 and text[:14].isdigit() and text[14] == "Z":
        # The common form, without the slow general parser, which tells what is wrong with any other.
        try:
            return datetime(*[int(text[i:j]) for i, j in _MOMENT_PARTS], tzinfo=timezone.utc)
        except ValueError:
            pass
    return datetime.strptime(text, "%Y%m%d%H%M%SZ").replace(tzinfo=timezone.utc)


def alt_names(data: bytes, start: int, end: int) -> list[str]:
    (_, seq_start, seq_end), = children(data, start, end)
    names = []
    for tag, a, b in children(data, seq_start, seq_end):
        raw = data[a:b]
        if tag in (0x81, 0x82, 0x86):
            names.append(raw.decode("utf-8", "replace"))
        elif tag == 0x87 and len(raw) in (4, 16):
            names.append(str(ipaddress.ip_address(raw)))
        elif tag == 0x88:
            names.append(oid(data, a, b))
        elif tag == 0xA4:
            (_, c, d), = children(data, a, b)
            names.append(",".join(f"{n}={v}" for n, v in name_fields(data, c, d).items()))
    return names


def bit_length(data: bytes, start: int, end: int) -> int:
    return int.from_bytes(data[start:end], "big").bit_length()


def key_info(data: bytes, start: int, end: int) -> tuple[str | None, int | None]:
    (_, alg_start, alg_end), (_, key_start, key_end) = children(data, start, end)[:2]
    algorithm = children(data, alg_start, alg_end)
    kind = k.KEY_OIDS.get(oid(data, *algorithm[0][1:]))
    if kind == "RSA":
        (_, a, b), = children(data, key_start + 1, key_end)
        return kind, bit_length(data, *children(data, a, b)[0][1:])
    if kind == "EC" and algorithm[1][0] == 0x06:
        return kind, k.CURVE_BITS.get(oid(data, *algorithm[1][1:]))
    if kind == "DSA":
        return kind, bit_length(data, *children(data, *algorithm[1][1:])[0][1:])
    return kind, None


def decode(data: bytes) -> dict:
    """The fields of one certificate; ``error`` tells why reading stopped."""
    out: dict = {"san": []}
    try:
        tag, start, end = children(data, 0, len(data))[0]
        if tag != 0x30:
            raise ValueError("not a certificate")
        (tbs_tag, tbs_start, tbs_end), (_, sig_start, sig_end) = children(data, start, end)[:2]
        parts = children(data, tbs_start, tbs_end)
        if parts[0][0] == 0xA0:
            parts = parts[1:]
        if tbs_tag != 0x30 or len(parts) < 6:
            raise ValueError("not a certificate")
        _, _, issuer, validity, subject, key = parts[:6]
        out["loaded"] = True
        out.update(name_fields(data, *subject[1:]))
        out.update({f"issuer_{n}": v for n, v in name_fields(data, *issuer[1:]).items()})
        for tag, a, b in parts[6:]:
            if tag != 0xA3:
                continue
            (_, list_start, list_end), = children(data, a, b)
            for _, ext_start, ext_end in children(data, list_start, list_end):
                fields = children(data, ext_start, ext_end)
                if oid(data, *fields[0][1:]) == k.SAN_OID:
                    out["san"] = alt_names(data, *fields[-1][1:])
        first, last = (moment(t, data[a:b]) for t, a, b in children(data, *validity[1:])[:2])
        out["not_before"], out["not_after"] = first.isoformat(), last.isoformat()
        out["validity_days"] = (last - first).days
        out["pubkey_type"], out["pubkey_bits"] = key_info(data, *key[1:])
        signature = oid(data, *children(data, sig_start, sig_end)[0][1:])
        out["signature_algorithm"] = k.SIGNATURE_OIDS.get(signature, "Unknown OID")
    except (ValueError, IndexError) as problem:
        out["error"] = str(problem)
    return out


@F.pandas_udf(X509_TYPE)
def decode_x509(der: pd.Series) -> pd.DataFrame:
    rows = [{} if data is None else decode(bytes(data)) for data in der]
    columns = {name: [row.get(name) for row in rows] for name in FIELD_NAMES}
    return pd.DataFrame({
        name: pd.Series(values, dtype="Int32" if name in INT_FIELDS else object)
        for name, values in columns.items()})
