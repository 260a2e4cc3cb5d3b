"""Passages of many words that stand in more than one document, wherever lines begin and end.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A window is ``words`` words in a row; it is
shared if another document has the same words in a row. Shared windows are found exactly, up to 128-bit digests:

1. Each window chooses one of its ``gram``-word strings, the leftmost with the least hash, so that
   equal windows choose equal ones. The windows of one choice form a stretch of text, told by the hash
   of what was chosen and a hash of the stretch.
2. A stretch that two documents have is shared as a whole. Among the rest, stretches that
   chose the same words as another stretch are compared window by window, by digests with
   partial sums before the shuffle. Copies and common passages thus move one row for each stretch.

Defined results: documents equal in ``doc_id`` and text are one document; a null, empty or short text has
no passages; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, lowered, mixed, prefix_hashes, slices, span_hashes, text_hashes, utf8, word_spans
from certrisk.session import staged

#: Windows looked at together.
STRIDE = 1 << 15
_STRETCH = "u_id long, u_hash long, gram long, kind long, first long, size int"
_WINDOW = "u_id long, u_hash long, first long, whole boolean, low long, high long"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    data, starts = utf8(texts)
    data = lowered(data)
    first, last, row = word_spans(data, starts)
    return text_hashes(data, first, last), row


def stretches(hashes: np.ndarray, row: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, hash of the chosen words and hash of all words, of each stretch."""
    n = len(hashes) - words + 1
    whole = np.flatnonzero(row[words - 1:] == row[:n]) if n > 0 else np.zeros(0, np.int64)
    if not len(whole):
        return whole, whole, whole.astype(np.uint64), whole.astype(np.uint64)
    prefix = prefix_hashes(hashes)
    at = np.arange(len(hashes) - gram + 1)
    grams = span_hashes(prefix, at, at + gram)
    choices = words - gram + 1
    nearest = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(grams[low:low + STRIDE + choices - 1], choices).argmin(axis=1)
        for low in range(0, n, STRIDE)])
    chosen = whole + nearest[whole]
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(whole) > 1), [True]]))
    first, size, place = whole[cuts[:-1]], np.diff(cuts), chosen[cuts[:-1]]
    text = span_hashes(prefix, first, first + size + words - 1)
    return first, size, grams[place], mixed(text + (place - first).astype(np.uint64))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("u_id"), F.xxhash64("text").alias("u_hash"), F.col("text").cast("string"))


def stretch_table(docs: DataFrame, words: int, gram: int) -> DataFrame:
    """One row per stretch; ``first`` counts the words of its text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, row = word_hashes(part.column("text"))
                first, size, chosen, kind = stretches(hashes, row, words, gram)
                rows = row[first]
                yield pa.record_batch({
                    "u_id": part.column("u_id").take(pa.array(rows)), "u_hash": part.column("u_hash").take(pa.array(rows)),
                    "gram": pa.array(chosen.view(np.int64)), "kind": pa.array(kind.view(np.int64)),
                    "first": pa.array(first - np.searchsorted(row, rows)), "size": pa.array(size.astype(np.int32))})

    return _texts(docs).mapInArrow(find, _STRETCH)


def window_digests(wanted: DataFrame, words: int) -> DataFrame:
    """128-bit digests of all windows of the ``wanted`` stretches (``first, size, whole``) of each text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, row = word_hashes(part.column("text"))
                lists = part.column("wanted")
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                first, size, whole = (lists.flatten().field(c).to_numpy(zero_copy_only=False) for c in range(3))
                inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                start = np.repeat(first, size) + inside
                owner, whole = np.repeat(owner, size), np.repeat(whole, size)
                begin = start + np.searchsorted(row, owner)
                low, high = (span_hashes(prefix_hashes(h), begin, begin + words).view(np.int64) for h in (hashes, mixed(hashes)))
                yield pa.record_batch({
                    "u_id": part.column("u_id").take(pa.array(owner)), "u_hash": part.column("u_hash").take(pa.array(owner)),
                    "first": pa.array(start), "whole": pa.array(whole), "low": pa.array(low), "high": pa.array(high)})

    return wanted.mapInArrow(find, _WINDOW)


def shared_windows(docs: DataFrame, words: int = 50, gram: int = 10, later: bool = False) -> DataFrame:
    """``u_id, u_hash, first, last``: runs of windows, by number of their first word, that another document has too.

    ``u_id`` is ``doc_id`` and ``u_hash`` the xxhash64 of the text. With ``later`` only the windows that a document
    before has, in the order of (``u_id``, ``u_hash``), so that one document keeps each window.
    """
    bounded_batches(docs.sparkSession)
    table = staged(stretch_table(docs, words, gram), "word-stretches")
    holder = F.struct("u_id", "u_hash")
    kinds = staged(table.groupBy("gram", "kind").agg(F.min(holder).alias("holder"), F.max(holder).alias("other")).select(
        "gram", "kind", "holder", (~F.col("holder").eqNullSafe(F.col("other"))).alias("whole")), "word-kinds")
    disputed = kinds.groupBy(F.col("gram").alias("_g")).agg((F.count("*") > 1).alias("disputed"))
    met = (kinds.join(disputed.hint("merge"), F.col("gram") == F.col("_g")).filter("whole OR disputed")
           .select(F.col("gram").alias("_gram"), F.col("kind").alias("_kind"), "holder", "whole", "disputed"))
    own = holder.eqNullSafe(F.col("holder"))
    marked = staged(table.join(met.hint("merge"), (F.col("gram") == F.col("_gram")) & (F.col("kind") == F.col("_kind"))).select(
        "u_id", "u_hash", "first", "size", "whole", own.alias("own"),
        (F.col("disputed") & (~F.col("whole") | own)).alias("compared")), "word-marked")
    runs = marked.filter("whole AND NOT own" if later else "whole").select("u_id", "u_hash", "first", (F.col("first") + F.col("size") - 1).alias("last"))
    per_text = marked.filter("compared").groupBy(F.col("u_id").alias("w_id"), F.col("u_hash").alias("w_hash")).agg(
        F.collect_set(F.struct("first", "size", "whole")).alias("wanted"))
    same = F.col("u_id").eqNullSafe(F.col("w_id")) & (F.col("u_hash") == F.col("w_hash"))
    windows = staged(window_digests(_texts(docs).join(per_text, same).select("u_id", "u_hash", "text", "wanted"), words),
                     "word-windows")
    repeated = (windows.groupBy(F.col("low").alias("_l"), F.col("high").alias("_h"))
                .agg(F.min(holder).alias("a"), F.max(holder).alias("b"), F.max("whole").alias("whole_too"))
                .filter("NOT (a <=> b)" if later else "whole_too OR NOT (a <=> b)").select("_l", "_h", "a"))
    # Of a whole stretch its first holder alone is compared: ``a`` is the first of all documents with the window.
    single = (windows.filter("true" if later else "NOT whole").join(repeated.hint("merge"), (F.col("low") == F.col("_l")) & (F.col("high") == F.col("_h")))
              .filter(~holder.eqNullSafe(F.col("a")) if later else F.lit(True))
              .select("u_id", "u_hash", "first", F.col("first").alias("last")))
    return runs.unionByName(single)


def shared_passages(docs: DataFrame, words: int = 50, gram: int = 10, later: bool = False) -> DataFrame:
    """``u_id, u_hash, passages``: runs of words (first, last) that shared windows cover, of each text that has any.

    ``later``: see ``shared_windows``.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for runs in batch.column("runs").to_pylist():
                merged: list[dict] = []
                for first, last in sorted((r["first"], r["last"] + words - 1) for r in runs):
                    if merged and first <= merged[-1]["last"] + 1:
                        merged[-1]["last"] = max(last, merged[-1]["last"])
                    else:
                        merged.append({"first": first, "last": last})
                out.append(merged)
            yield pa.record_batch({
                "u_id": batch.column("u_id"), "u_hash": batch.column("u_hash"),
                "passages": pa.array(out, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))})

    return (shared_windows(docs, words, gram, later).groupBy("u_id", "u_hash")
            .agg(F.collect_set(F.struct("first", "last")).alias("runs"))
            .mapInArrow(joined, f"u_id long, u_hash long, passages {PASSAGES}"))


PASSAGES = "array<struct<first:long,last:long>>"
