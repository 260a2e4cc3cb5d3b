"""Removing every byte covered by a string of ``length`` bytes that also starts elsewhere.

Such strings are found exactly, with one pass over all texts and little moved:

1. Each window of ``length`` bytes has an anchor, the leftmost of the ``gram``-byte strings in it with
   the smallest hash. Equal windows have equal anchors at the same distance, and the
   windows of one anchor form a stretch of text. A stretch is told by two hashes: of its
   anchor and of itself.
2. Stretches that occur twice are repeated as a whole. What is left are stretches that share an
   anchor but differ; one of each kind is fetched from its text.
3. For these, a suffix order (``suffix_order``) is built over blocks of ``BLOCK`` bytes, cut at
   equal distances from the anchor. Neighbours in that order that share all blocks a
   window is sure to hold are candidates, and windows around them are compared byte by byte.
4. An anchor with more than ``most_kinds`` different stretches (a passage that very many texts share) is
   not brought into one task: its windows are counted by 128-bit digests instead, with
   partial sums before the shuffle.

A passage shorter than ``length`` bytes is not seen this way. With ``passage_words`` passages of that many words that another
document has too are reported beside the spans (``passages.py``); they are not removed.

Defined results: a null or empty text has no bytes and nothing is removed; rows equal in
``doc_id`` and text count as different rows, so each of them repeats in the other; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, mixed, powers, prefix_hashes, shuffles_removed, slices, span_hashes, utf8
from certrisk.llm.passages import PASSAGES, shared_passages
from certrisk.llm.suffix_order import suffix_order
from certrisk.session import staged

BLOCK = 32
#: Bytes of stretches that one task orders at a time, about.
BUCKET_BYTES = 3 << 20
#: Window starts worked on at a time within a very long text.
STRIDE = 4 << 20
_PLACE_BITS = np.uint64(24)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    ahead = np.minimum.accumulate(padded.reshape(-1, width), axis=1).ravel()
    behind = np.minimum.accumulate(padded.reshape(-1, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def stretches(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, anchor hash, first window, number of windows and anchor of each stretch."""
    for low in range(0, max(0, len(data) - length + 1), STRIDE):
        part = data[low:low + STRIDE + length - 1]
        prefix = prefix_hashes(part)
        at = np.arange(len(part) - gram + 1)
        grams = mixed((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][:len(at)])
        ranked = (grams & ~((np.uint64(1) << _PLACE_BITS) - np.uint64(1))) | at.astype(np.uint64)
        anchors = (_sliding_least(ranked, length - gram + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        window = np.arange(len(anchors))
        row = np.searchsorted(starts, window + low, "right") - 1
        whole = np.flatnonzero(window + low + length <= starts[row + 1])
        if not len(whole):
            continue
        begins = np.concatenate([[True], (anchors[whole[1:]] != anchors[whole[:-1]]) | (np.diff(whole) > 1) | (np.diff(row[whole]) > 0)])
        first = whole[begins]
        size = np.diff(np.append(np.flatnonzero(begins), len(whole)))
        yield row[first], grams[anchors[first]], first + low, size, anchors[first] + low


_STRETCH = "u_id long, u_hash long, anchor long, kind binary, start long, size int, offset int"


def stretch_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per stretch of every text (offsets in bytes of the text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, starts = utf8(part.column("text"))
                raw = memoryview(data)
                for row, anchor, first, size, place in stretches(data, starts, length, gram):
                    offset = place - first
                    kinds = [xxhash.xxh3_128_digest(raw[a:b], seed=o) for a, b, o in zip(
                        first.tolist(), (first + size + length - 1).tolist(), offset.tolist())]
                    rows = pa.array(row)
                    yield pa.record_batch({
                        "u_id": part.column("u_id").take(rows), "u_hash": part.column("u_hash").take(rows),
                        "anchor": pa.array(anchor.view(np.int64)), "kind": pa.array(kinds, pa.binary()),
                        "start": pa.array(first - starts[row]), "size": pa.array(size, pa.int32()),
                        "offset": pa.array(offset, pa.int32())})

    return _keyed(docs).mapInArrow(find, _STRETCH)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("u_id"), F.xxhash64("text").alias("u_hash"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def equal_windows(kinds: list[tuple[int, int, bytes]], length: int) -> list[list[int]]:
    """Window starts, for each stretch (anchor, anchor's offset, bytes), that another stretch of the same
    anchor has too at the same distance from it."""
    texts = np.frombuffer(b"".join(k[2] for k in kinds), np.uint8)
    sizes = np.array([len(k[2]) for k in kinds])
    ends = np.cumsum(sizes)
    offset = np.array([k[1] for k in kinds])
    low, high = -(offset // BLOCK), (sizes - offset) // BLOCK
    blocks = high - low
    owner = np.repeat(np.arange(len(kinds)), blocks)
    number = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks) + low[owner]
    place = offset[owner] + BLOCK * number  # in its stretch
    begin = (ends - sizes)[owner] + place
    anchor = np.array([k[0] for k in kinds], np.int64).view(np.uint64)
    symbol = span_hashes(prefix_hashes(texts), begin, begin + BLOCK) + mixed(anchor[owner] + number.astype(np.uint64))
    symbol = np.unique(symbol, return_inverse=True)[1] + 1
    # A zero between stretches ends every comparison there.
    slot = np.arange(len(symbol)) + owner
    text = np.zeros(len(symbol) + len(kinds), np.int64)
    text[slot] = symbol
    source = np.full(len(text), -1)
    source[slot] = np.arange(len(symbol))
    order = suffix_order(text)
    need = (length - BLOCK + 1) // BLOCK
    padded = np.concatenate([text, np.zeros(need, np.int64)])
    shared = np.ones(max(0, len(order) - 1), bool)
    for d in range(need):
        left, right = padded[order[:-1] + d], padded[order[1:] + d]
        shared &= (left == right) & (left > 0)
    found: list[set[int]] = [set() for _ in kinds]
    run_ends = np.flatnonzero(np.concatenate([[True], ~shared, [True]]))
    for a, b in zip(run_ends[:-1], run_ends[1:]):
        if b - a < 2:
            continue
        met: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        for s in order[a:b].tolist():
            k, q = int(owner[source[s]]), int(place[source[s]])
            _, shift, body = kinds[k]
            for p in range(max(0, q - BLOCK + 1), min(q, len(body) - length) + 1):
                if p not in found[k]:
                    met[p - shift, body[p:p + length]].append(k)
                else:
                    met[p - shift, body[p:p + length]].append(-1 - k)
        for (shift, _), who in met.items():
            if len(who) > 1:
                for k in who:
                    if k >= 0:
                        found[k].add(shift + kinds[k][1])
    return [sorted(f) for f in found]


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """Ascending places as first and last of each run."""
    at = np.array(places, np.int64)
    cuts = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.concatenate([[0], cuts + 1])].tolist(), at[np.append(cuts, len(at) - 1)].tolist()))


_RUN = pa.schema([("u_id", pa.int64()), ("u_hash", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def repeated_windows(docs: DataFrame, length: int, gram: int, most_kinds: int) -> DataFrame:
    """``u_id, u_hash, first, last``: runs of window starts whose windows also start elsewhere."""
    table = staged(stretch_table(docs, length, gram), "stretches")
    kinds = staged(table.groupBy("anchor", "kind").agg(
        F.count("*").alias("n"), F.min(F.struct("u_id", "u_hash", "start", "size", "offset")).alias("at")), "kinds")
    twice = kinds.filter("n > 1").select(F.col("anchor").alias("_a"), F.col("kind").alias("_k"))
    runs = table.join(twice.hint("merge"), (F.col("anchor") == F.col("_a")) & (F.col("kind") == F.col("_k"))).select(
        "u_id", "u_hash", F.col("start").alias("first"), (F.col("start") + F.col("size") - 1).alias("last"))
    disputed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").withColumnRenamed("anchor", "_a")
    left = (kinds.join(disputed.hint("merge"), F.col("anchor") == F.col("_a"))
            .select("at.*", "anchor", "n", (F.col("kinds") > most_kinds).alias("crowded")))
    per_text = left.groupBy("u_id", "u_hash").agg(F.collect_list(
        F.struct("start", "size", "offset", "anchor", "n", "crowded")).alias("wanted")).select(
        F.col("u_id").alias("w_id"), F.col("u_hash").alias("w_hash"), "wanted")
    same = F.col("u_id").eqNullSafe(F.col("w_id")) & (F.col("u_hash") == F.col("w_hash"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = defaultdict(list)
            for r in batch.to_pylist():
                body = r["text"].encode("utf-8", "surrogatepass")
                for w in r["wanted"]:
                    for c in ("u_id", "u_hash"):
                        rows[c].append(r[c])
                    for c in ("start", "offset", "anchor", "n", "crowded"):
                        rows[c].append(w[c])
                    rows["body"].append(body[w["start"]:w["start"] + w["size"] + length - 1])
            if rows:
                yield pa.record_batch({c: pa.array(v, types[c]) for c, v in rows.items()})

    types = {"u_id": pa.int64(), "u_hash": pa.int64(), "start": pa.int64(), "offset": pa.int32(), "anchor": pa.int64(),
             "n": pa.int64(), "crowded": pa.bool_(), "body": pa.binary()}
    fetched = staged(_keyed(docs).dropDuplicates(["u_id", "u_hash"]).join(per_text, same).select("u_id", "u_hash", "text", "wanted").mapInArrow(
        fetch, "u_id long, u_hash long, start long, offset int, anchor long, n long, crowded boolean, body binary"), "disputed")
    total = fetched.filter("NOT crowded").agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(12, int(total / BUCKET_BYTES))

    def ordered(rows: pa.Table) -> pa.Table:
        anchors, offsets, bodies, counts = (rows.column(c).to_pylist() for c in ("anchor", "offset", "body", "n"))
        out = []
        for k, places in enumerate(equal_windows(list(zip(anchors, offsets, bodies)), length)):
            if places and counts[k] == 1:
                doc, key, start = (rows.column(c)[k].as_py() for c in ("u_id", "u_hash", "start"))
                out += [(doc, key, start + a, start + b) for a, b in _runs(places)]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], _RUN)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = defaultdict(list)
            for r in batch.to_pylist():
                for p in range(len(r["body"]) - length + 1):
                    rows["u_id"].append(r["u_id"])
                    rows["u_hash"].append(r["u_hash"])
                    rows["first"].append(r["start"] + p)
                    rows["n"].append(r["n"])
                    rows["digest"].append(xxhash.xxh3_128_digest(r["body"][p:p + length]))
            if rows:
                yield pa.record_batch({c: pa.array(v, pa.binary() if c == "digest" else pa.int64()) for c, v in rows.items()})

    in_order = (fetched.filter("NOT crowded").withColumn("bucket", F.pmod("anchor", F.lit(buckets)))
                .groupBy("bucket").applyInArrow(ordered, "u_id long, u_hash long, first long, last long"))
    windows = fetched.filter("crowded").mapInArrow(digests, "u_id long, u_hash long, first long, n long, digest binary")
    known = windows.groupBy("digest").agg(F.sum("n").alias("all")).filter("all > 1").withColumnRenamed("digest", "_d")
    counted = windows.join(known.hint("merge"), F.col("digest") == F.col("_d")).select(
        "u_id", "u_hash", "first", F.col("first").alias("last"))
    return runs.unionByName(in_order).unionByName(counted)


def dedup_substrings(docs: DataFrame, length: int = 400, gram: int = 64, most_kinds: int = 2_000,
                     passage_words: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: removed byte spans (array of start, end) and the bytes left.

    With ``passage_words`` also ``passages``: first and last word (counted from 0, in the text as given) of each passage of that many words
    that another document has too.
    """
    bounded_batches(docs.sparkSession)
    # What was found is staged, so that the shuffles that found it are gone before the texts are shuffled.
    with shuffles_removed(docs.sparkSession):
        found = staged(repeated_windows(docs, length, gram, most_kinds).groupBy("u_id", "u_hash").agg(
            F.collect_set(F.struct("first", "last")).alias("runs")), "repeated-runs")
        if passage_words is not None:
            found = found.unionByName(staged(shared_passages(docs, passage_words), "passages"), allowMissingColumns=True)
    extra = [] if passage_words is None else ["passages"]
    if extra:
        found = found.groupBy("u_id", "u_hash").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("runs", *extra)])
    per_text = found.select(F.col("u_id").alias("w_id"), F.col("u_hash").alias("w_hash"), "runs", *extra)
    same = F.col("u_id").eqNullSafe(F.col("w_id")) & (F.col("u_hash") == F.col("w_hash"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                body, merged = (text.as_py() or "").encode("utf-8", "surrogatepass"), []
                for a, b in sorted((r["first"], r["last"] + length) for r in runs.as_py() or ()):
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(b, merged[-1]["end"])
                    else:
                        merged.append({"start": a, "end": b})
                at, parts = 0, []
                for s in merged:
                    parts.append(body[at:s["start"]])
                    at = s["end"]
                sizes.append(len(body))
                spans.append(merged)
                kept.append(b"".join([*parts, body[at:]]))
            yield pa.record_batch({
                "doc_id": batch.column("u_id"), "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()), **{c: batch.column(c) for c in extra}})

    kinds = "".join(f", {c} {PASSAGES}" for c in extra)
    return _keyed(docs).join(per_text, same, "left").select(
        "u_id", "text", "runs", *[F.coalesce(c, F.array().cast(PASSAGES)).alias(c) for c in extra]).mapInArrow(
        cut, f"doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary{kinds}")
