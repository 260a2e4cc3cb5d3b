"""Term statistics, an exact vocabulary with a defined order of ties, and tf-idf weights.

Terms are the entries of an array column or, with ``longest`` above 1, also the n-grams of neighbouring entries, joined
by a space. They are counted batch by batch before the shuffle, and n-grams that cannot be wanted are not made:
a bitmap of fixed size, which may hold too much and never too little, says which shorter ones can lead to a wanted one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certrisk.operators.lookup import broadcast_if_small
from certrisk.operators.ranking import first_rows
from certrisk.session import staged

#: Entries counted at a time. A row with more is counted by itself.
SLICE_TERMS = 1 << 20
#: Places of the bitmap, gathered as 512 KB of bits, and those of one row of it, as Spark's bitmap functions cut it.
KEPT_BITS, BITMAP_BITS = 1 << 22, 1 << 15


def bitmap(terms: DataFrame) -> np.ndarray:
    """Whether any ``term`` falls on a place, for ``KEPT_BITS`` places; gathered as at most 128 rows of 4 KB."""
    place = F.crc32("term") % KEPT_BITS + 1  # Spark's buckets count from 1, and hold 1 to 32,768 first
    parts = terms.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    kept = np.zeros((KEPT_BITS // BITMAP_BITS, BITMAP_BITS), bool)
    for r in parts:
        kept[r["part"] - 1] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
    return kept.ravel()


def _places(terms: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32((t or "").encode()) % KEPT_BITS for t in terms.to_pylist()), np.int64, len(terms))


def _slices(lists: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and rows of pieces of about ``SLICE_TERMS`` entries, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(lists):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_TERMS, "right")))
        yield at, lists.slice(at, end - at)
        at = end


def grams(lists: pa.Array, shortest: int, longest: int, kept: np.ndarray | None, wanted_kept: bool) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """For each length: the different terms, and term and row of every one that stands in the lists.

    With ``kept`` only terms in the bitmap are made longer, and with ``wanted_kept`` only these are returned.
    """
    entries = lists.flatten().dictionary_encode(null_encoding="encode")
    words, code = entries.dictionary, entries.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    terms, at, term = words, np.arange(len(code)), code
    for n in range(1, longest + 1):
        if n > 1:
            follows = at[1:] == at[:-1] + 1  # both the term and the one that starts a word later are kept
            first = np.flatnonzero(follows & (row[at[:-1]] == row[np.minimum(at[:-1] + n - 1, len(row) - 1)])
                                   & (at[:-1] + n - 1 < len(row)))
            pair = term[first] * len(words) + code[at[first] + n - 1]
            at = at[first]
            pair, term = np.unique(pair, return_inverse=True)
            terms = pc.binary_join_element_wise(terms.take(pa.array(pair // max(1, len(words)))), words.take(pa.array(pair % max(1, len(words)))), " ")
        known = None
        if kept is not None and (n < longest or wanted_kept):
            known = kept[_places(terms)]
        if n >= shortest:
            chosen = known[term] if known is not None and wanted_kept else slice(None)
            yield terms, term[chosen], row[at[chosen]]
        if known is not None:
            good = known[term]
            at, term = at[good], term[good]
        if not len(at):
            return


def gram_stats(rows: DataFrame, words: str, longest: int = 1, shortest: int = 1, kept: np.ndarray | None = None) -> DataFrame:
    """``term, occurrences, documents`` of the terms of ``shortest`` to ``longest`` entries; see ``grams`` for ``kept``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lists in _slices(batch.column(0)):
                for terms, term, row in grams(lists, shortest, longest, kept, False):
                    n = np.bincount(term, minlength=len(terms))
                    # Terms of one row next to each other: the first of each counts as its document.
                    docs = np.bincount(np.unique(row * max(1, len(terms)) + term) % max(1, len(terms)), minlength=len(terms))
                    yield pa.record_batch({"term": terms.cast(pa.string()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})

    # Counted by batch already: a second partial sum would find little to add up and spill.
    counted = rows.select(words).mapInArrow(count, "term string, n long, docs long").repartition("term")
    return counted.groupBy("term").agg(F.sum("n").alias("occurrences"), F.sum("docs").alias("documents"))


def term_stats(rows: DataFrame, terms: str) -> DataFrame:
    """``term, occurrences, documents`` of the entries of an array column; both counted in one shuffle of partial sums."""
    return gram_stats(rows, terms)


def _bounds(n_documents: int, min_df: float, max_df: float) -> tuple[float, float]:
    return min_df if min_df >= 1 else min_df * n_documents, max_df if max_df > 1 else max_df * n_documents


def vocabulary(stats: DataFrame, n_documents: int, most: int, min_df: float = 1.0, max_df: float = 1.0) -> DataFrame:
    """``term, occurrences, documents, position, idf``, staged: the ``most`` terms occurring most often, ties by term.

    ``min_df`` and ``max_df`` bound a term's documents: a number from 1 on, a share of all documents below; ``max_df`` 1.0
    is the share. ``idf`` is ln((1 + documents of all) / (1 + documents of the term)) + 1.
    """
    least, greatest = _bounds(n_documents, min_df, max_df)
    # Staged, so that the text is read once however many passes the choice takes.
    fit = staged(stats.filter((F.col("documents") >= least) & (F.col("documents") <= greatest)), "term-stats")
    return staged(first_rows(fit, most, "occurrences", "term").withColumn(
        "idf", F.log((1 + n_documents) / (1 + F.col("documents"))) + 1), "vocabulary")


def gram_vocabulary(rows: DataFrame, words: str, n_documents: int, most: int, min_df: float = 1.0, max_df: float = 1.0,
                    longest: int = 3) -> DataFrame:
    """``vocabulary`` of all terms of one to ``longest`` words, length by length.

    A term occurs no more often than the terms within it. So once ``most`` terms that fit are known, a longer term is
    counted only if all terms within it occur as often as the last of these; others cannot be among the chosen.
    """
    least, greatest = _bounds(n_documents, min_df, max_df)
    fits = (F.col("documents") >= least) & (F.col("documents") <= greatest)
    known, kept = None, None
    for n in range(1, longest + 1):
        # The words of the text are read once for each length.
        found = gram_stats(rows, words, n, n, kept)
        if n < longest:
            found = staged(found, f"stats-of-{n}")
        known = found if known is None else known.unionByName(found)
        if n < longest:
            best = known.filter(fits).select("occurrences").orderBy(F.desc("occurrences")).limit(most).agg(
                F.count("*").alias("n"), F.min("occurrences").alias("floor")).first()
            kept = bitmap(known.filter(F.col("occurrences") >= max(least, best["floor"] if best["n"] == most else 1)))
    return vocabulary(known, n_documents, most, min_df, max_df)


def tfidf_weights(rows: DataFrame, key: str, terms: str, words: DataFrame, longest: int = 1) -> DataFrame:
    """``key, term, n, weight`` of every row and every term of the vocabulary it holds; a row's weights have length 1.

    With ``longest`` above 1 the n-grams of the entries of ``terms`` are terms too. Each row is counted where it is
    read, so that one row for each of its terms goes to the shuffle, which brings together those of equal ``key``.
    """
    within = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.size("_w")), lambda a: F.transform(
        F.sequence(a, F.size("_w")), lambda b: F.array_join(F.slice("_w", a, b - a + 1), " ")))))
    parts = words.select("term") if longest == 1 else words.select(F.split("term", " ").alias("_w")).select(F.explode(within).alias("term"))
    kept = bitmap(parts)
    kind = rows.select(F.col(key).alias("key")).schema["key"].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, lists in _slices(batch.column(1)):
                keys = batch.column(0).slice(low, len(lists))
                for names, term, row in grams(lists, 1, longest, kept, True):
                    pair, n = np.unique(row * max(1, len(names)) + term, return_counts=True)
                    yield pa.record_batch({
                        "key": keys.take(pa.array(pair // max(1, len(names)))), "term": names.take(pa.array(pair % max(1, len(names)))).cast(pa.string()),
                        "n": pa.array(n, pa.int64())})

    counted = rows.select(F.col(key).alias("key"), terms).mapInArrow(
        count, T.StructType().add("key", kind).add("term", "string").add("n", "long"))
    words = broadcast_if_small(words.select("term", "idf"))
    # One shuffle, by the key, serves both groupings.
    counts = (counted.join(words, "term").repartition("key").groupBy("key", "term")
              .agg(F.sum("n").alias("n"), F.first("idf").alias("idf")))
    # One row's distinct terms, at most the vocabulary.
    listed = counts.groupBy("key").agg(F.collect_list(F.struct("term", "n", (F.col("n") * F.col("idf")).alias("w"))).alias("terms"))
    norm = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda total, t: total + t["w"] * t["w"]))
    return listed.select("key", norm.alias("norm"), F.inline("terms")).select(
        F.col("key").alias(key), "term", "n", (F.col("w") / F.col("norm")).alias("weight"))
