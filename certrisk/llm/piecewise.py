"""Context-triggered piecewise hashes of texts, and how alike two of them are.

A hash rolling over ``WINDOW`` bytes ends a piece where its low bits are all ones; each piece gives one of
64 signs. The block size is the smallest of 4, 8, 16, ... that leaves about ``SIGNS`` * 3/4 pieces at most, and the
fingerprint ``size:signature:signature at twice the size`` can be compared with those of the same, half or
twice the block size: 1 - edit distance / longer signature. Other sizes are not alike (0).
An insertion or change moves only the pieces around it. From the 64th piece on, the rest of a text is one piece.

Defined results: a null or empty text has the fingerprint ``4::``; equal texts have equal fingerprints, and
equal fingerprints are alike by 1; rows without ``doc_id`` come first in the order; among rows of one
``doc_id`` a hash of the text decides; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, prefix_hashes, span_hashes, utf8

WINDOW = 7
LEAST_BLOCK = 4
SIGNS = 64
_SIGN = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Characters of text handled together.
CHUNK_CHARS = 1 << 20

Parts = tuple[int, bytes, bytes]


def block_sizes(lengths: np.ndarray) -> np.ndarray:
    least = np.maximum(1, lengths / (LEAST_BLOCK * SIGNS * 3 / 4))
    return LEAST_BLOCK << np.ceil(np.log2(least)).astype(np.int64)


def fingerprints(data: np.ndarray, starts: np.ndarray) -> list[Parts]:
    """Block size and both signatures of every row."""
    rows = len(starts) - 1
    sizes = block_sizes(np.diff(starts))
    prefix = prefix_hashes(data)
    at = np.arange(len(data))
    row_of = np.repeat(np.arange(rows), np.diff(starts))
    rolling = span_hashes(prefix, np.maximum(at - WINDOW + 1, starts[:-1][row_of]), at + 1)
    signatures = []
    for factor in (1, 2):
        mask = (sizes * factor - 1).astype(np.uint64)[row_of]
        last = np.flatnonzero((rolling & mask) == mask)
        row = row_of[last]
        rank = np.arange(len(last)) - np.searchsorted(row, row)
        last, row = last[rank < SIGNS - 1], row[rank < SIGNS - 1]
        # Pieces begin where a row does and after every trigger, unless the row ends there.
        begins = np.concatenate([starts[:-1][np.diff(starts) > 0], last[last + 1 < starts[row + 1]] + 1])
        begins.sort()
        piece_row = np.searchsorted(starts, begins, "right") - 1
        ends = np.minimum(np.append(begins[1:], len(data)), starts[piece_row + 1])
        signs = _SIGN[(span_hashes(prefix, begins, ends) >> np.uint64(58)).astype(np.int64)].tobytes()
        bounds = np.searchsorted(piece_row, np.arange(rows + 1))
        signatures.append([signs[a:b] for a, b in zip(bounds[:-1], bounds[1:])])
    return list(zip(sizes.tolist(), *signatures))


def written(parts: Parts) -> str:
    return f"{parts[0]}:{parts[1].decode()}:{parts[2].decode()}"


def edit_distances(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Edit distance of each pair of signatures of at most 64 signs, all pairs side by side in 64-bit words."""
    n = len(pairs)
    number = np.zeros(256, np.int64)
    number[_SIGN] = np.arange(64)
    lane, one = np.arange(n), np.uint64(1)
    size_a, size_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
    padded = [np.frombuffer(b"".join(p[k].ljust(SIGNS, b"A") for p in pairs), np.uint8).reshape(n, SIGNS) for k in (0, 1)]
    a, b = number[padded[0]], number[padded[1]]
    where = np.zeros((n, 64), np.uint64)
    for i in range(SIGNS):
        where[lane, a[:, i]] |= np.where(i < size_a, one << np.uint64(i), np.uint64(0))
    up, down = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.uint64)
    score, top = size_a.copy(), np.maximum(size_a - 1, 0).astype(np.uint64)
    for j in range(int(size_b.max(initial=0))):
        equal = where[lane, b[:, j]]
        x = equal | down
        h = (((equal & up) + up) ^ up) | equal
        plus, minus = down | ~(h | up), up & h
        live = j < size_b
        score += live * (((plus >> top) & one).astype(np.int64) - ((minus >> top) & one).astype(np.int64))
        plus, minus = (plus << one) | one, minus << one
        up, down = np.where(live, minus | ~(x | plus), up), np.where(live, plus & x, down)
    return np.where(size_a == 0, size_b, score)


def likeness(pairs: list[tuple[Parts, Parts]]) -> np.ndarray:
    """How alike the fingerprints of each pair are, 0 to 1."""
    out = np.zeros(len(pairs))
    which, signatures = [], []
    for k, ((size, one, two), (other, o_one, o_two)) in enumerate(pairs):
        if size == other:
            which += [k, k]
            signatures += [(one, o_one), (two, o_two)]
        elif size == 2 * other or other == 2 * size:
            which.append(k)
            signatures.append((one, o_two) if size == 2 * other else (two, o_one))
    if which:
        longest = np.array([max(len(a), len(b)) for a, b in signatures])
        alike = np.where(longest > 0, 1 - edit_distances(signatures) / np.maximum(longest, 1), 1.0)
        np.maximum.at(out, which, alike)
    return out


def of_texts(texts: list[str]) -> list[Parts]:
    return fingerprints(*utf8(pa.array(texts, pa.string())))


def fingerprint_column(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text."""

    @F.arrow_udf("string")
    def describe(column: pa.Array) -> pa.Array:
        return pa.array([written(p) for p in fingerprints(*utf8(column))], pa.string())

    return docs.withColumn(column, describe(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def in_order(docs: DataFrame) -> DataFrame:
    """``bucket, extra, place, doc_id, text``: documents dealt by ranges of ``doc_id``, in order within a task.

    Every range ends with a copy (``extra``) of the first document of the next one, and the last with the
    very first, so that each document has its successor at hand. Only bounds and first ids, a few for each
    shuffle partition, reach the driver.
    """
    spark = docs.sparkSession
    least = -(1 << 63)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(least))
    ids = docs.select(place.alias("place"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.arrow_udf("int")
    def bucket_of(column: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, column.to_numpy(zero_copy_only=False), "right"), pa.int32())

    firsts = sorted((r["b"], r["first"]) for r in ids.withColumn("b", bucket_of("place")).groupBy("b").agg(
        F.min("place").alias("first")).collect())
    # The range before each one that holds a document; before the first comes the last.
    before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}

    @F.arrow_udf("array<int>")
    def buckets_of(column: pa.Array) -> pa.Array:
        places = column.to_numpy(zero_copy_only=False)
        own = np.searchsorted(bounds, places, "right")
        return pa.array([[int(b), before[p]] if p in before else [int(b)] for b, p in zip(own, places.tolist())], pa.list_(pa.int32()))

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), place.alias("place"))
    dealt = rows.withColumn("_buckets", buckets_of("place")).select(
        "doc_id", "text", "place", F.posexplode("_buckets").alias("extra", "bucket"))
    return (dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
            .sortWithinPartitions("bucket", "extra", "place", F.xxhash64("text"))
            .select("bucket", "extra", "doc_id", "text"))


def compared_with_next(docs: DataFrame, share: int = 4) -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    ``edited`` is the text with the last ``1 / share`` of its code points replaced by as many of the first of
    the next document.
    """
    bounded_batches(docs.sparkSession)

    def compared(rows: list[tuple]) -> pa.RecordBatch | None:
        own = of_texts([r[3] for r in rows])
        out, edited = [], []
        for k in range(len(rows) - 1):
            if not rows[k][1] and rows[k][0] == rows[k + 1][0]:
                text = rows[k][3]
                moved = len(text) // share
                out.append(k)
                edited.append(text[:len(text) - moved] + rows[k + 1][3][:moved])
        if not out:
            return None
        changed = of_texts(edited)
        return pa.record_batch({
            "doc_id": pa.array([rows[k][2] for k in out], pa.int64()), "n_chars": pa.array([len(rows[k][3]) for k in out], pa.int64()),
            "edited": pa.array(edited, pa.string()), "fingerprint": pa.array([written(own[k]) for k in out], pa.string()),
            "edited_fingerprint": pa.array([written(p) for p in changed], pa.string()),
            "near_edited": pa.array(likeness([(own[k], p) for k, p in zip(out, changed)])),
            "near_next": pa.array(likeness([(own[k], own[k + 1]) for k in out]))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "text"))):
                rows.append(row)
                held += len(row[3])
                if held >= CHUNK_CHARS and len(rows) > 1:
                    found = compared(rows)
                    if found is not None:
                        yield found
                    rows, held = rows[-1:], len(row[3])
        if len(rows) > 1:
            found = compared(rows)
            if found is not None:
                yield found

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited string, fingerprint string, "
                                          "edited_fingerprint string, near_edited double, near_next double")
