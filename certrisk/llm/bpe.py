"""Byte-pair encoding and decoding by a table of distinct words.

Texts are cut into words (``units.cut``), the distinct words are gathered with their counts,
each is encoded once, and its ids are put back at every place it stands at. Decoding gathers
the pieces of ids from the vocabulary in the same way.

Words are known by 64-bit hashes, and compared by bytes where they are gathered: words that share a hash stay out
of the table and are encoded where they stand.
The encoded table is sent to all tasks when its size, known by then, is at most
``table_bytes``. Beyond that, only its ``frequent`` most common words are, and every document gets
the ids of its rarer words through a join: one row per document and rare word, keyed by the
word, so no key is hot.

Defined results: a null or empty text has no ids and decodes to the empty text; rows with
equal ids are encoded each on its own; an empty table gives no rows; columns of ``docs``
other than ``doc_id`` and ``text`` are ignored. Ids are little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, same_bytes, slices, text_hashes, utf8
from certrisk.llm.units import cut, encoder
from certrisk.session import staged

#: Distinct words gathered by a task before it sends them on.
FLUSH_WORDS = 200_000


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and row of each unit; the space before a word is not part of it."""
    at, row = cut(data, starts)
    ends = np.append(at[1:], len(data))
    at = at + ((data[np.minimum(at, len(data) - 1)] == 32) & (ends > at)) if len(data) else at
    return text_hashes(data, at, ends), at, ends, row


def distinct_words(docs: DataFrame) -> DataFrame:
    """``hash, word, other, n`` of all words; ``other`` differs from ``word`` where two share a hash."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, words, counts = np.zeros(0, np.uint64), np.zeros(0, object), np.zeros(0, np.int64)
        odd: list[tuple[int, bytes]] = []  # words whose hash another one has

        def found() -> pa.RecordBatch:
            more = np.array([h for h, _ in odd], np.uint64)
            out = pa.record_batch({
                "hash": pa.array(np.concatenate([keys, more]).view(np.int64)),
                "word": pa.array([*words, *(w for _, w in odd)], pa.binary()),
                "n": pa.array(np.concatenate([counts, np.zeros(len(odd), np.int64)]))})
            odd.clear()
            return out

        for batch in batches:
            for part in slices(batch):
                data, starts = utf8(part.column("text"))
                hashes, at, ends, _ = words_of(data, starts)
                new, first, back, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                raw, sizes = data.tobytes(), ends - at
                place = np.searchsorted(keys, new)
                known = np.zeros(len(new), bool)
                inside = place < len(keys)
                known[inside] = keys[place[inside]] == new[inside]
                counts[place[known]] += n[known]
                own = np.empty(len(new), object)
                own[:] = [raw[a:b] for a, b in zip(at[first].tolist(), ends[first].tolist())]
                alike = sizes == sizes[first][back]
                alike &= same_bytes(data, at, data, at[first][back], np.where(alike, sizes, 0))
                odd += [(int(hashes[k]), raw[at[k]:ends[k]]) for k in np.flatnonzero(~alike)]
                other = np.flatnonzero(known)[own[known] != words[place[known]]]
                odd += [(int(new[k]), own[k]) for k in other]
                texts = own[~known]
                keys = np.insert(keys, place[~known], new[~known])
                words = np.insert(words, place[~known], texts)
                counts = np.insert(counts, place[~known], n[~known])
            if len(keys) + len(odd) >= FLUSH_WORDS:
                yield found()
                keys, words, counts = keys[:0], words[:0], counts[:0]
        if len(keys):
            yield found()

    return (docs.select("text").mapInArrow(gather, "hash long, word binary, n long").groupBy("hash")
            .agg(F.min("word").alias("word"), F.max("word").alias("other"), F.sum("n").alias("n")))


def encoded_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """Add ``ids`` of each word, encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(tokenizer)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            ids = []
            for k in range(0, len(texts), 5_000):
                ids += [np.array(x, "<u4").tobytes() for x in run(texts[k:k + 5_000])]
            yield pa.record_batch({"hash": batch.column("hash"), "n": batch.column("n"), "ids": pa.array(ids, pa.binary())})

    return words.filter("word = other").select("hash", "word", "n").mapInArrow(encode, "hash long, n long, ids binary")


class WordIds:
    """Ids by word hash, as sorted arrays; every Python worker holds one, so numbers are short."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, bounds: np.ndarray):
        self.keys, self.ids, self.bounds = keys, ids, bounds

    @classmethod
    def of(cls, hashes: pa.Array, ids: pa.Array) -> WordIds:
        keys = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        flat, starts = utf8(ids)
        order = np.argsort(keys)
        ids_of = flat.view("<u4") if len(flat) else np.zeros(0, "<u4")
        sizes = (np.diff(starts) // 4)[order]
        ids_in_order = gathered(ids_of, starts[:-1][order] // 4, sizes)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return cls(keys[order], ids_in_order.astype(np.uint16 if ids_in_order.max(initial=0) < 1 << 16 else np.uint32),
                   bounds.astype(np.uint32 if bounds[-1] < 1 << 32 else np.int64))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        place = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        return place, self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), bool)

    def runs(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the words at these places start, and how many they are."""
        starts = self.bounds[place].astype(np.int64)
        return starts, self.bounds[place + 1].astype(np.int64) - starts


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` one after another."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Pieces:
    """The vocabulary: the bytes of each id, with a space behind it."""

    def __init__(self, tokenizer: str):
        with open(tokenizer, encoding="utf-8") as file:
            known = json.load(file)
        names = {i: w for w, i in known["model"]["vocab"].items()} | {t["id"]: t["content"] for t in known["added_tokens"]}
        parts = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Pieces of each row's ids, joined by spaces."""
        sizes = self.sizes[ids]
        text = gathered(self.flat, self.starts[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[starts]
        return [text[a:max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode_decode(
    docs: DataFrame, tokenizer: str, table_bytes: int = 160 << 20, frequent: int = 100_000,
) -> DataFrame:
    """``doc_id, ids, decoded`` of every row."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    docs = _keyed(docs)
    words = staged(encoded_words(distinct_words(docs), tokenizer), "words")
    n, size = words.agg(F.count("*"), F.sum(F.length("ids"))).first()
    whole = n * 8 + (size or 0) <= table_bytes
    sent = words if whole else words.orderBy(F.desc("n"), "hash").limit(frequent)
    arrow = sent.select("hash", "ids").toArrow()
    table = WordIds.of(*(
        pa.concat_arrays([pa.array([], t), *arrow.column(c).chunks])
        for c, t in (("hash", pa.int64()), ("ids", pa.binary()))))
    shared = spark.sparkContext.broadcast((table.keys, table.ids, table.bounds))
    del arrow, table

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, _, _, row = words_of(*utf8(part.column("text")))
                missing = ~WordIds(*shared.value).find(hashes)[1]
                pairs = np.unique(np.stack([row[missing].astype(np.uint64), hashes[missing]]), axis=1)
                place = pa.array(pairs[0].astype(np.int64))
                yield pa.record_batch({"r_id": part.column("doc_id").take(place), "r_hash": part.column("text_hash").take(place),
                                       "hash": pa.array(pairs[1].view(np.int64))})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pieces = WordIds(*shared.value), Pieces(tokenizer)
        for batch in batches:
            for part in slices(batch):
                data, starts = utf8(part.column("text"))
                hashes, word_at, word_end, row = words_of(data, starts)
                distinct, back = np.unique(hashes, return_inverse=True)
                place, known = table.find(distinct)
                flat, from_, sizes = table.ids, np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
                from_[known], sizes[known] = table.runs(place[known])
                if "own" in part.schema.names and not known.all():
                    own, rest = part.column("own").flatten(), np.flatnonzero(~known)
                    extra = WordIds.of(own.field("hash"), own.field("ids"))
                    place, there = extra.find(distinct[rest])
                    rest, place = rest[there], place[there]
                    from_[rest], sizes[rest] = extra.runs(place)
                    from_[rest] += len(flat)
                    flat, known[rest] = np.concatenate([flat, extra.ids]), True
                odd = np.flatnonzero(~known[back])
                sizes, from_ = sizes[back], from_[back]
                if len(odd):  # words that share a hash, in no table
                    raw = data.tobytes()
                    found = encoder(tokenizer)([raw[a:b].decode("utf-8", "replace") for a, b in zip(word_at[odd], word_end[odd])])
                    sizes[odd] = [len(ids) for ids in found]
                    from_[odd] = len(flat) + np.cumsum(sizes[odd]) - sizes[odd]
                    flat = np.concatenate([flat.astype(np.uint32), np.array([i for ids in found for i in ids], np.uint32)])
                ids = gathered(flat, from_, sizes)
                per_row = np.bincount(row, sizes, part.num_rows).astype(np.int64)
                at = np.concatenate([[0], np.cumsum(per_row)])
                raw = ids.astype("<u4").tobytes()
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "ids": pa.array([raw[4 * a:4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    "decoded": pa.array(pieces.decode(ids, at), pa.binary()).cast(pa.string())})

    if not whole:
        hashed = docs.withColumn("text_hash", F.xxhash64("text"))
        found = hashed.mapInArrow(rare, "r_id long, r_hash long, hash long").join(words.select("hash", "ids").hint("merge"), "hash")
        own = found.groupBy("r_id", "r_hash").agg(F.collect_set(F.struct("hash", "ids")).alias("own"))
        same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash"))
        docs = hashed.join(own, same, "left").select("doc_id", "text", "own")
    return docs.mapInArrow(fill, "doc_id long, ids binary, decoded string")
