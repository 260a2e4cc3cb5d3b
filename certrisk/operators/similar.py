"""Nearest vectors by cosine similarity, exact: blocks of queries against blocks of the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from certrisk.config import DEFAULT
from certrisk.operators.lookup import BROADCAST_BYTES
from certrisk.session import staged

#: Rows of a corpus block.
CORPUS_BLOCK = 4_096


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _blocks(rows: DataFrame, row_id: str, vector: str, prefix: str, size: int) -> DataFrame:
    """Rows of unit vectors packed ``size`` at a time into one row: ids, and the vectors as bytes."""
    kind = rows.schema[row_id].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def packed() -> pa.RecordBatch:
            m = np.concatenate(parts)
            names = pa.concat_arrays(ids)
            return pa.record_batch({
                f"{prefix}_ids": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                f"{prefix}_units": pa.array([m.tobytes()], pa.binary())})

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - held)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                ids.append(part.column(0))
                parts.append(_unit(flat.reshape(part.num_rows, -1)))
                at, held = at + part.num_rows, held + part.num_rows
                if held == size:
                    yield packed()
                    ids, parts, held = [], [], 0
        if held:
            yield packed()

    narrow = rows.filter(F.col(vector).isNotNull()).select(row_id, vector)
    return narrow.mapInArrow(pack, f"{prefix}_ids array<{kind}>, {prefix}_units binary")


def similar_top_k(
    corpus: DataFrame, queries: DataFrame, corpus_id: str, query_id: str, vector: str, k: int = DEFAULT.top_k,
    block: int = 1024, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` rows of ``corpus`` most similar to each query, with their rank, ties by the smaller id.

    Queries and corpus are packed into blocks of rows, and every block of queries meets every block of
    the corpus once, in one plan whatever their number. The blocks of queries are sent to all tasks while they stay below
    ``broadcast_bytes``; beyond that, tasks pair parts of both. A task keeps the best ``k`` of each of its queries as it
    reads, so the final ranking sees ``k`` rows per query and task. The corpus is not shuffled. Rows without a vector
    have no neighbours and are none.
    """
    kinds = [f.dataType.simpleString() for f in (queries.schema[query_id], corpus.schema[corpus_id])]
    n = queries.count()
    asked = staged(_blocks(queries.repartition(max(1, -(-n // block)), query_id), query_id, vector, "q", block)
                   .withColumn("q_block", F.monotonically_increasing_id()), "query-blocks")
    size = asked.agg(F.sum(F.length("q_units"))).first()[0] or 0
    stored = _blocks(corpus, corpus_id, vector, "c", CORPUS_BLOCK)
    # A stated set of queries against all rows, in blocks.
    pairs = stored.crossJoin(F.broadcast(asked) if size <= broadcast_bytes else asked)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kept = {}, {}
        for batch in batches:
            for r in range(batch.num_rows):
                found = batch.column("c_ids")[r].values
                block_id, q_ids = batch.column("q_block")[r].as_py(), batch.column("q_ids")[r].values
                q = np.frombuffer(batch.column("q_units")[r].as_buffer(), float).reshape(len(q_ids), -1)
                c = np.frombuffer(batch.column("c_units")[r].as_buffer(), float).reshape(len(found), -1)
                sims = q @ c.T
                # Whatever ties with the k-th best of the block stays in the running.
                floor = np.partition(sims, -k, axis=1)[:, -k] if sims.shape[1] > k else np.full(len(sims), -2.0)
                at, row = np.nonzero(sims >= floor[:, None])
                new = pa.table({"q": pa.array(at), "id": found.take(pa.array(row)), "s": pa.array(sims[at, row])})
                names[block_id] = q_ids
                both = pa.concat_tables([kept[block_id], new]) if block_id in kept else new
                both = both.sort_by([("q", "ascending"), ("s", "descending"), ("id", "ascending")])
                own = both.column("q").to_numpy()
                first = np.searchsorted(own, own)  # where each query's rows begin
                kept[block_id] = both.filter(pa.array(np.arange(len(own)) - first < k))
        for block_id, rows in kept.items():
            yield pa.record_batch({
                query_id: names[block_id].take(rows.column("q").combine_chunks()),
                corpus_id: rows.column("id").combine_chunks(), "similarity": rows.column("s").combine_chunks()})

    out = pairs.mapInArrow(best, f"{query_id} {kinds[0]}, {corpus_id} {kinds[1]}, similarity double")
    order = Window.partitionBy(query_id).orderBy(F.desc("similarity"), corpus_id)
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(query_id, "rank", corpus_id, "similarity"))
