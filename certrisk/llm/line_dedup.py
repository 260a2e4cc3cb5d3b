"""Removing repeated lines or paragraphs across documents.

Every unit (a line, or a paragraph with ``separator="\\n\\n"``) is normalised to its lower-case
letters and digits with single spaces and hashed to 16 bytes. Of all units with the same digest
the one with the lowest rank stays: rank is ``doc_id``, then a hash of the text, then the place.
The others are removed together with the separator that follows them, and their places in the
original text are kept in ``removed``. Units of fewer than ``min_words`` words are left alone, as
they repeat by chance.

Digests are counted before the shuffle, and a digest held by many documents is a skewed key of
one plain join, which adaptive execution splits. Texts are shuffled once, to meet their spans.

Units see a passage only as whole lines. With ``passage_words`` the passages of that many words
that another document has too, inside lines or across them, are reported as well (``passages``); they stay. With
``cut_passages`` the passages are those that a document before has, in the same order, and they are removed like units, from the
first character of their first word to the last one of their last: each text keeps what no earlier one has.

Defined results: a null text stays null; documents equal in ``doc_id`` and text are one
document, and all its rows are treated alike; a null ``doc_id`` ranks first; an empty table
gives no rows; further columns are kept, except ``removed`` and, if asked for, ``passages``, which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, unused
from certrisk.llm.passages import PASSAGES, shared_passages

SPANS = "array<struct<start:long,end:long>>"
_UNITS = pa.schema([("u_id", pa.int64()), ("u_hash", pa.int64()), ("start", pa.int64()),
                    ("end", pa.int64()), ("digest", pa.binary())])
_NOT_WORD = re.compile(r"[\W_]+")
#: The words of ``passages``.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
FLUSH_ROWS = 20_000


def unit_places(text: str, separator: str) -> Iterator[tuple[int, int, int]]:
    """Start and end of each unit, and the end with its separator."""
    at = 0
    while at < len(text):
        end = text.find(separator, at)
        end = len(text) if end < 0 else end
        after = min(len(text), end + len(separator))
        if end > at:
            yield at, end, after
        at = after


def normalised(unit: str) -> str:
    return _NOT_WORD.sub(" ", unit.lower()).strip()


def unit_digests(docs: DataFrame, separator: str, min_words: int) -> DataFrame:
    """``u_id, u_hash, start, end, digest`` of all units with enough words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _UNITS)], _UNITS)
            rows.clear()
            return out

        for batch in batches:
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("u_id", "u_hash", "text"))):
                for start, end, after in unit_places(text, separator):
                    plain = normalised(text[start:end])
                    if plain.count(" ") + 1 >= min_words:
                        rows.append((doc_id, key, start, after, hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest()))
                if len(rows) >= FLUSH_ROWS:
                    yield flushed()
        if rows:
            yield flushed()

    rows = docs.filter("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("u_id"), F.xxhash64("text").alias("u_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(find, "u_id long, u_hash long, start long, end long, digest binary")


def repeated_spans(units: DataFrame) -> DataFrame:
    """``u_id, u_hash, removed``: the spans of all units that another one with their digest precedes."""
    rank = F.struct("u_id", "u_hash", "start")
    first = (units.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
             .filter(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"))
    return (units.join(first.hint("merge"), "digest").filter(~rank.eqNullSafe(F.col("first")))
            .groupBy("u_id", "u_hash")
            .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed")))


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the given spans (code points, sorted, disjoint)."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for body, places in zip(texts, removed):
            body, at, kept = body.as_py(), 0, []
            if body is None:  # functions run on every row, whatever condition they stand in
                out.append(None)
                continue
            for p in places.as_py() or ():
                kept.append(body[at:p["start"]])
                at = p["end"]
            out.append("".join([*kept, body[at:]]))
        return pa.array(out, pa.string())

    return F.when(spans.isNotNull() & (F.size(spans) > 0), cut(text, spans)).otherwise(text)


def with_passages(text: Column, spans: Column, passages: Column) -> Column:
    """``spans`` (code points) and the places of the passages in ``text``, joined where they meet, in order."""

    @F.arrow_udf(SPANS)
    def joined(texts: pa.Array, units: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for body, cuts, words in zip(texts, units, runs):
            places = [(s["start"], s["end"]) for s in cuts.as_py() or ()]
            if words := words.as_py():
                at = [m.span() for m in _WORD.finditer(body.as_py())]
                places += [(at[w["first"]][0], at[w["last"]][1]) for w in words]
            merged: list[dict] = []
            for start, end in sorted(places):
                if merged and start <= merged[-1]["end"]:
                    merged[-1]["end"] = max(end, merged[-1]["end"])
                else:
                    merged.append({"start": start, "end": end})
            out.append(merged)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return joined(text, spans, passages)


def dedup_units(docs: DataFrame, separator: str = "\n", min_words: int = 10, passage_words: int | None = None,
                cut_passages: bool = False) -> DataFrame:
    """``docs`` with repeated units cut from ``text``, and ``removed``: their original places.

    With ``passage_words`` also ``passages``: first and last word (counted from 0, before the cuts) of each shared passage.
    With ``cut_passages`` as well, passages that an earlier document has are cut too, and ``removed`` joins them with the units.
    """
    bounded_batches(docs.sparkSession)
    extra = {} if passage_words is None else {"passages": PASSAGES}
    docs = docs.drop("removed", *extra)
    u_id, u_hash = unused(docs, "unit_id"), unused(docs, "unit_hash")
    spans = repeated_spans(unit_digests(docs, separator, min_words))
    if passage_words is not None:
        both = spans.unionByName(shared_passages(docs, passage_words, later=cut_passages), allowMissingColumns=True)
        spans = both.groupBy("u_id", "u_hash").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("removed", *extra)])
    spans = spans.select(F.col("u_id").alias(u_id), F.col("u_hash").alias(u_hash), "removed", *extra)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(u_id)) & (F.xxhash64("text") == F.col(u_hash))
    joined = docs.join(spans, same, "left").drop(u_id, u_hash)
    if passage_words is not None and cut_passages:
        joined = joined.withColumn("removed", with_passages(F.col("text"), F.col("removed"), F.col("passages")))
    return joined.withColumns({
        "text": without_spans(F.col("text"), F.col("removed")),
        "removed": F.coalesce("removed", F.array().cast(SPANS)),
        **{c: F.coalesce(c, F.array().cast(kind)) for c, kind in extra.items()}})
