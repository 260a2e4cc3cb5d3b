"""Exact Jaccard self-join of shingle sets, and the components of its links.

Two sets of n shingles in all that reach the threshold differ in at most
``d = n * (100 - t) / (100 + t)`` of them. So when the shingles are dealt by their hash into more than
``d`` parts, some part is equal in both. Spark groups sets by the hashes of their parts, and
sets that share one are joined into clusters, outside of which there is no link
(``part_keys``). Parts with few shingles repeat by chance; with as many parts to spare as there are
of these, they are left out.

Inside a cluster the join skips by set relations (``SetGroup``): index lists, one per shingle,
hold positions in ascending order, so a search passes over whole stretches of a list that
cannot reach the threshold; and the answers of a set are derived from those of a very similar
one by the few shingles in which the two differ.

Equal sets are one set throughout. Keys meet in blocks of a task first, so a part that very
many sets share costs one row per block. A line that many texts share chains sets into one large
cluster though they differ otherwise. A cluster beyond ``block_shingles`` is therefore clustered
anew by the shingles that fewest of its sets hold (``rare_edges``), as long as that makes the
large ones smaller. What is then still beyond ``block_shingles`` is dealt over several tasks. A sample of its sets tells which shingles most of them hold, and the set nearest to
these becomes the cluster's centre, to which all are compared. The sets without a link to the
centre are then compared to each other and to all the rest, by pairs of blocks: a task takes
two blocks, whatever the size of the cluster. No set is left out.

Defined results: null, empty and blank texts have the empty set, are linked with nothing and
are their own component; ``component_id`` is the smallest ``doc_id`` of the component's rows, a
null ``doc_id`` counting only where no other exists; equal rows are one set; an empty table
gives no rows; other columns are ignored. Sets are told apart by 64-bit hashes, and shingles
too; the join stops with an error should two sets share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import (
    bounded_batches, give_back, lowered, mixed, shuffles_removed, slices, text_hashes, unused, utf8, word_spans,
)
from certrisk.llm.components import components
from certrisk.session import staged

#: Shingles of a cluster that one task takes; larger clusters are dealt out.
BLOCK_SHINGLES = 1_200_000
#: Part keys gathered before they are grouped and sent on, and those a bucket should receive.
FLUSH_KEYS = 400_000
BUCKET_KEYS = 500_000
_MULTIPLIERS = (np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64))


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data = lowered(data)
    first, last, row = word_spans(data, starts)
    words = text_hashes(data, first, last)
    n = len(starts) - 1
    counts = np.bincount(row, minlength=n)
    ends = np.cumsum(counts)
    shingles = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        shingles += words[k:len(words) - width + 1 + k] * _MULTIPLIERS[k]
    shingles = mixed(shingles + np.uint64(width))
    out = []
    for size, end in zip(counts.tolist(), ends.tolist()):
        if size >= width:
            found = np.sort(shingles[end - size:end - width + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) > 1 else found)
        elif size:
            whole = words[end - size:end] * _MULTIPLIERS[:size]
            out.append(mixed(whole.sum(keepdims=True, dtype=np.uint64) + np.uint64(size)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def set_check(values: np.ndarray) -> int:
    """A second hash, to notice two sets with one id."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8, key=b"check").digest(), "little", signed=True)


class PartScheme:
    """Size classes, and how many parts the sets of a class are dealt into."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, self.bounds[-1] * 3 // 2))

    def class_of(self, size: int) -> int:
        return int(np.searchsorted(self.bounds, size, "right")) - 1

    def parts(self, c: int) -> int:
        """Parts of class ``c``, a few more than two linked sets of that class can differ in; 0 if they cannot differ."""
        most = self.bounds[c + 1] - 1
        differ = 2 * most * (100 - self.percent) // (100 + self.percent)
        return differ + 1 + (2 + differ // 16 if differ >= 2 else 0) if differ else 0

    def wanted(self, values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Part hashes of a set, for its own class and for those of larger partners, with the class in the last seven
        bits; and for each class how many of them it shares with any set it is linked to."""
        n, out, needs = len(values), [], []
        if not n:
            return np.zeros(0, np.uint64), needs
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
        largest = n * 100 // self.percent
        for c in range(self.class_of(n), self.class_of(largest) + 1):
            parts = self.parts(c)
            if not parts:
                continue
            number = np.arange(parts + 1, dtype=np.float64)
            edges = np.minimum(np.ceil(number * (2.0 ** 32 / parts)), 2.0 ** 32 - 1).astype(np.uint64) << np.uint64(32)
            at = np.searchsorted(values, edges)
            at[0], at[-1] = 0, n
            counts = at[1:] - at[:-1]
            differ = (n + min(largest, self.bounds[c + 1] - 1)) * (100 - self.percent) // (100 + self.percent)
            empty = int((counts == 0).sum())
            # Empty parts tell nothing and are left out while others are sure to be shared.
            need = parts - differ - empty
            own = counts > 0 if need > 0 else np.ones(parts, bool)
            label = (np.uint64(c << 40) + np.arange(parts, dtype=np.uint64)) * _MULTIPLIERS[1]
            found = mixed(sums[at[1:]] - sums[at[:-1]] + counts.astype(np.uint64) * _MULTIPLIERS[2] + mixed(label))
            out.append(found[own] & ~np.uint64(127) | np.uint64(c))
            needs.append((c, max(1, need)))
        return (np.concatenate(out) if out else np.zeros(0, np.uint64)), needs

    def keys(self, values: np.ndarray) -> np.ndarray:
        return self.wanted(values)[0]


def grouped_keys(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the smallest of their ids, and edges from that one to the others."""
    order = np.argsort(ids, kind="stable")
    keys, ids = keys[order], ids[order]
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    begins = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    leaders = ids[begins]
    of = leaders[np.cumsum(begins) - 1] if len(keys) else ids
    differ = of != ids
    a, b = of[differ], ids[differ]
    _, first = np.unique(mixed(a.astype(np.uint64)) * np.uint64(3) + b.astype(np.uint64), return_index=True)
    return keys[begins], leaders, a[first], b[first]


_BLOCK = pa.schema([("bucket", pa.int64()), ("is_count", pa.bool_()), ("x", pa.binary()), ("y", pa.binary())])
_COUNT = pa.schema([("set_id", pa.int64()), ("size_class", pa.int64()), ("need", pa.int64()), ("n", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_LED = pa.schema([("bucket", pa.int64()), ("is_edge", pa.bool_()), ("x", pa.int64()), ("y", pa.int64())])
_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_RETURNED = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary())])


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, set_check`` of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(*utf8(part.column("text")), width)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_id": pa.array([set_id(s) for s in sets], pa.int64()),
                    "set_check": pa.array([set_check(s) for s in sets], pa.int64())})

    return _texts(docs).mapInArrow(
        describe, "doc_id long, text_hash long, n_shingles long, set_id long, set_check long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def first_owners(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the least id of each, and whether it has a second one."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    begins = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    at = np.flatnonzero(begins)
    last = np.append(at[1:], len(keys)) - 1
    return keys[at], ids[at], ids[at] != ids[last]


def shared_parts(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """``set_id`` of all sets that share as many parts with others as a link takes.

    Keys meet in blocks of a task first: a key that two sets of a block share is counted there for all of them and sent on once,
    so a part of very many sets costs one key per block.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, keys, ids, needs, held = PartScheme(percent), [], [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            all_keys, all_ids = np.concatenate(keys), np.concatenate(ids)
            key, first, several = first_owners(all_keys, all_ids)
            mine = several[np.searchsorted(key, all_keys)]
            # Copies of a set in one block have the same keys: each of its keys counts once.
            shared = np.unique(np.stack([all_ids[mine].view(np.uint64), all_keys[mine]]), axis=1)
            code = np.array([(i, c, need, 0) for i, c, need in set(needs)], np.int64).reshape(-1, 4)
            more = np.stack([shared[0].view(np.int64), (shared[1] & np.uint64(127)).astype(np.int64)])
            pairs, n = np.unique(more, axis=1, return_counts=True)
            code = np.concatenate([code, np.stack([pairs[0], pairs[1], np.zeros(len(n), np.int64), n], 1)])
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            # A key known to be shared has no single owner to be counted later.
            owner = np.where(several, np.int64(0), first)
            rows = [(int(bucket[s]), False, key[s:e].tobytes(), np.stack([owner[s:e], several[s:e].astype(np.int64)]).tobytes())
                    for s, e in zip(at, np.append(at[1:], len(key)))]
            for k in range(0, len(code), 4_096):
                to = int(mixed(code[k:k + 1, 0].astype(np.uint64))[0] % np.uint64(buckets))
                rows.append((to, True, code[k:k + 4_096].tobytes(), b""))
            for some in (keys, ids, needs):
                some.clear()
            for k in range(0, len(rows), 2_000):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[k:k + 2_000]), _BLOCK)], _BLOCK)

        for batch in batches:
            for part in slices(batch):
                for values in shingle_sets(*utf8(part.column("text")), width):
                    found, own = scheme.wanted(values)
                    if len(found):
                        name = set_id(values)
                        keys.append(found)
                        ids.append(np.full(len(found), name, np.int64))
                        needs += [(name, c, need) for c, need in own]
                        held += len(found)
                if held >= FLUSH_KEYS:
                    yield from flushed()
                    held = 0
        if held:
            yield from flushed()

    def met(rows: pa.Table) -> pa.Table:
        counts, keys, owners, several = [], [], [], []
        for is_count, x, y in zip(*(rows.column(c).to_pylist() for c in ("is_count", "x", "y"))):
            if is_count:
                counts.append(np.frombuffer(x, np.int64).reshape(-1, 4))
            else:
                keys.append(np.frombuffer(x, np.uint64))
                both = np.frombuffer(y, np.int64).reshape(2, -1)
                owners.append(both[0])
                several.append(both[1] > 0)
        if keys:
            key, owner, many = np.concatenate(keys), np.concatenate(owners), np.concatenate(several)
            distinct, _, differ = first_owners(key[~many], owner[~many])
            known = np.isin(key, key[many])
            place = np.minimum(np.searchsorted(distinct, key), max(0, len(distinct) - 1))
            shared = ~many & (known | (differ[place] & (distinct[place] == key)) if len(distinct) else known)
            pairs = np.unique(np.stack([owner[shared].view(np.uint64), key[shared]]), axis=1)
            counts.append(np.stack([pairs[0].view(np.int64), (pairs[1] & np.uint64(127)).astype(np.int64),
                                    np.zeros(pairs.shape[1], np.int64), np.ones(pairs.shape[1], np.int64)], 1))
        all_ = np.concatenate(counts) if counts else np.zeros((0, 4), np.int64)
        give_back()
        return pa.table([pa.array(all_[:, k]) for k in range(4)], _COUNT)

    blocks = _texts(docs).mapInArrow(keyed, "bucket long, is_count boolean, x binary, y binary")
    counted = blocks.groupBy("bucket").applyInArrow(met, "set_id long, size_class long, need long, n long")
    return counted.groupBy("set_id", "size_class").agg(F.sum("n").alias("n"), F.max("need").alias("need")).filter(
        "n >= need").select("set_id").distinct()


def edge_batches(keys: np.ndarray, ids: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A block's keys with the set that leads each, and edges from that one to the others, for ``met_edges``."""
    key, leader, a, b = grouped_keys(keys, ids)
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    for x, y, to, is_edge in ((key, leader, bucket, False), (a.view(np.uint64), b, mixed(a.view(np.uint64)) % np.uint64(buckets), True)):
        for k in range(0, len(x), 20_000):
            e = k + 20_000
            yield pa.record_batch({
                "bucket": pa.array(to[k:e].astype(np.int64)), "is_edge": pa.array(np.full(len(x[k:e]), is_edge)),
                "x": pa.array(x[k:e].view(np.int64)), "y": pa.array(y[k:e])}, _LED)


def met_edges(blocks: DataFrame) -> DataFrame:
    """``a, b``: pairs of set ids that connect all sets with an equal key, of the ``blocks`` of ``edge_batches``."""

    def met(rows: pa.Table) -> pa.Table:
        x, y = (rows.column(c).to_numpy() for c in ("x", "y"))
        edge = rows.column("is_edge").to_numpy()
        _, _, a, b = grouped_keys(x[~edge].view(np.uint64), y[~edge])
        return pa.table([np.concatenate([x[edge], a]), np.concatenate([y[edge], b])], _EDGE)

    return blocks.groupBy("bucket").applyInArrow(met, "a long, b long").distinct()


def part_edges(sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """``a, b``: pairs of set ids that connect all of ``sets(set_id, values)`` with an equal part."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, keys, ids, held = PartScheme(percent), [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            yield from edge_batches(np.concatenate(keys), np.concatenate(ids), buckets)
            keys.clear()
            ids.clear()

        for batch in batches:
            for values, name in zip(batch.column("values").to_pylist(), batch.column("set_id").to_pylist()):
                found = scheme.keys(np.frombuffer(values, np.uint64))
                if len(found):
                    keys.append(found)
                    ids.append(np.full(len(found), name, np.int64))
                    held += len(found)
                if held >= FLUSH_KEYS:
                    yield from flushed()
                    held = 0
        if held:
            yield from flushed()

    return met_edges(sets.select("set_id", "values").mapInArrow(keyed, "bucket long, is_edge boolean, x long, y long"))


def rare_places(shingles: np.ndarray, holders: np.ndarray, starts: np.ndarray, percent: int) -> np.ndarray:
    """Where the shingles stand by which each set is clustered: of the rarest of its cluster, as many as any set
    linked to it must hold one of, without those that no other set holds; none of a set that cannot have a link.

    ``holders`` tells how many sets hold a shingle; set k has the places from ``starts[k]`` to ``starts[k + 1]``. Linked sets have
    ``percent`` of the shingles of each in common at least, and the rarest of these is among both their rarest.
    """
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    need = -(-percent * sizes // 100)
    shared = np.bincount(owner[holders > 1], minlength=len(sizes))
    order = np.lexsort((shingles, holders, owner))
    place = np.arange(len(order)) - starts[owner]
    return order[(place <= (sizes - need)[owner]) & (shared >= need)[owner] & (holders[order] > 1)]


def rare_edges(sets: DataFrame, percent: int, shingles: int) -> DataFrame:
    """``a, b``: pairs of set ids that connect all of ``sets(cluster, set_id, values)`` that are linked within a cluster, by the
    shingles that fewest sets of the cluster hold. ``shingles`` is how many there are in all.

    Sets are dealt into blocks. A block sends each of its shingles once, to where they are counted, and gets the counts back.
    """
    blocks, buckets = max(16, shingles // FLUSH_KEYS), max(16, shingles // BUCKET_KEYS)

    def flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shingles of all sets of a block, told apart by cluster, the places where sets start, and their ids."""
        values = [np.frombuffer(v, np.uint64) for v in rows.column("values").to_pylist()]
        sizes = np.array([len(v) for v in values], np.int64)
        cluster = mixed(rows.column("cluster").to_numpy().view(np.uint64))
        return (mixed(np.concatenate(values) ^ np.repeat(cluster, sizes)), np.concatenate([[0], np.cumsum(sizes)]),
                rows.column("set_id").to_numpy())

    def bucket_starts(keys: np.ndarray) -> np.ndarray:
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def sent(rows: pa.Table) -> pa.Table:
        keys, counts = np.unique(flat(rows)[0], return_counts=True)
        at, counts = bucket_starts(keys), counts.astype(np.int32)
        some = np.flatnonzero(at[1:] > at[:-1])
        give_back()
        return pa.table([pa.array(some), pa.array([rows.column("block")[0].as_py()] * len(some), pa.int64()),
                         pa.array([keys[at[k]:at[k + 1]].tobytes() for k in some], pa.binary()),
                         pa.array([counts[at[k]:at[k + 1]].tobytes() for k in some], pa.binary())], _SENT)

    def counted(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(v, np.uint64) for v in rows.column("keys").to_pylist()]
        every, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, back, np.concatenate([np.frombuffer(v, np.int32) for v in rows.column("counts").to_pylist()]))
        # More than an int32 can tell are as many as it can: an order all the same.
        total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)[back]
        ends = np.cumsum([len(k) for k in keys])
        give_back()
        return pa.table([rows.column("block").combine_chunks(), rows.column("bucket").combine_chunks(),
                         pa.array([total[e - len(k):e].tobytes() for k, e in zip(keys, ends)], pa.binary())], _RETURNED)

    def led(rows: pa.Table, returned: pa.Table) -> pa.Table:
        values, starts, ids = flat(rows)
        keys, back = np.unique(values, return_inverse=True)
        returned = returned.sort_by("bucket")
        holders = np.concatenate([np.frombuffer(v, np.int32) for v in returned.column("counts").to_pylist()])
        assert len(holders) == len(keys)
        place = rare_places(values, holders[back], starts, percent)
        owner = np.searchsorted(starts, place, "right") - 1
        out = pa.Table.from_batches(list(edge_batches(values[place], ids[owner], buckets)), _LED)
        give_back()
        return out

    dealt = sets.select("cluster", "set_id", "values", F.pmod(F.xxhash64("set_id", F.lit(3)), F.lit(blocks)).alias("block"))
    shingled = dealt.groupBy("block").applyInArrow(sent, "bucket long, block long, keys binary, counts binary")
    returned = shingled.groupBy("bucket").applyInArrow(counted, "block long, bucket long, counts binary")
    return met_edges(dealt.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(
        led, "bucket long, is_edge boolean, x long, y long"))


def loosened(sets: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """``sets(cluster, set_id, n_shingles, values)`` with the clusters beyond ``block_shingles`` clustered anew by their rare
    shingles, as long as a tenth of what is in such clusters leaves them. Sets that cannot have a link are left out.
    """
    out, before = [], None
    while True:
        large = staged(sets.groupBy("cluster").agg(F.sum("n_shingles").alias("weight")).filter(F.col("weight") > block_shingles).select(
            F.col("cluster").alias("_c"), "weight"), "chained-clusters")
        many, total = large.agg(F.count("*"), F.sum("weight")).first()
        if not many or before is not None and 10 * total > 9 * before:
            break
        large = (F.broadcast(large) if many <= 100_000 else large).select("_c")
        inside = F.col("cluster") == F.col("_c")
        out.append(sets.join(large, inside, "left_anti"))
        chained = sets.join(large, inside, "left_semi")
        anew = components(rare_edges(chained, percent, total)).withColumnRenamed("component", "_anew")
        sets = staged(chained.join(anew, F.col("set_id") == F.col("node")).select(
            F.col("_anew").alias("cluster"), "set_id", "n_shingles", "values"), "loosened-sets")
        before = total
    for other in out:
        sets = sets.unionByName(other)
    return sets


class SetGroup:
    """Exact links among a few sets, as far as they are needed to connect what is linked.

    Shingles are numbered by how many sets hold them, rarest first, and sets are kept in
    that order. ``search`` finds all sets whose similarity to one reaches a lower,
    *relaxed* threshold; for a set linked to it (a follower), answers follow from these.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.n = percent, len(sets)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        _, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(counts, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        owner = np.repeat(np.arange(self.n, dtype=np.int32), self.sizes)
        token = rank[back]
        by_set = np.lexsort((token, owner))
        self.tokens = token[by_set]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        position = (np.arange(len(flat)) - np.repeat(self.starts[:-1], self.sizes)).astype(np.int32)
        # Index lists: of each shingle, its sets by ascending position.
        listed = np.lexsort((position, self.tokens))
        self.list_owner, self.list_position = owner[listed], position[listed]
        self.list_starts = np.concatenate([[0], np.cumsum(counts[order])])
        self.mark = np.zeros(len(order), bool)
        self.parent = np.arange(self.n)

    def members(self, k: int) -> np.ndarray:
        return self.tokens[self.starts[k]:self.starts[k + 1]]

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = int(self.parent[k])
        return k

    def linked(self, overlap: np.ndarray, a: int | np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (self.sizes[a] + self.sizes[b] - overlap)

    def overlaps(self, k: int, others: np.ndarray) -> np.ndarray:
        self.mark[self.members(k)] = True
        out = np.fromiter((np.count_nonzero(self.mark[self.members(z)]) for z in others), np.int64, len(others))
        self.mark[self.members(k)] = False
        return out

    def search(self, k: int, relaxed: float) -> tuple[np.ndarray, np.ndarray]:
        """Sets that may reach the relaxed similarity to ``k``, with their overlaps."""
        own, size, found = self.members(k), len(self.members(k)), []
        for i in range(size - int(np.ceil(relaxed * size)) + 1):
            s, e = self.list_starts[own[i]], self.list_starts[own[i] + 1]
            # Past this position too few shingles are left in any set of a fitting size.
            e = s + np.searchsorted(self.list_position[s:e], (1 - relaxed) * size / relaxed, "right")
            z, j = self.list_owner[s:e], self.list_position[s:e]
            need = relaxed / (1 + relaxed) * (size + self.sizes[z])
            found.append(z[np.minimum(size - i, self.sizes[z] - j) >= need - 1e-6])
        others = np.unique(np.concatenate(found))
        others = others[others != k]
        return others, self.overlaps(k, others)

    def links(self, settled: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that connect every two sets that links connect; the ``settled`` are known to be one component."""
        out: list[tuple[int, int]] = []

        def join(a: int, b: int) -> None:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[y] = x
                out.append((a, b))

        # If x is linked to the leader and z to x, distances add up: 1 - J(leader, z) <= 2 * (1 - t).
        relaxed = max(0.01, 2 * self.percent / 100 - 1)
        done = np.zeros(self.n, bool) if settled is None else settled.copy()
        if done.any():
            self.parent[done] = np.flatnonzero(done)[0]
        for leader in range(self.n):
            if done[leader]:
                continue
            done[leader] = True
            others, overlap = self.search(leader, relaxed)
            direct = self.linked(overlap, leader, others)
            for z in others[direct]:
                join(leader, int(z))
            home = self.root(leader)
            outside = np.array([self.root(int(z)) != home for z in others], bool)
            far, far_overlap = others[outside], overlap[outside]
            for x, shared in zip(others[direct], overlap[direct]):
                if done[x]:
                    continue
                done[x] = True
                if not len(far):
                    continue
                more = self.sizes[x] - shared
                possible = self.linked(np.minimum(far_overlap + more, self.sizes[far]), int(x), far)
                if possible.any():
                    # Only the shingles in which x and the leader differ change an overlap.
                    self.mark[self.members(leader)] = True
                    gained = self.members(x)[~self.mark[self.members(x)]]
                    self.mark[self.members(leader)] = False
                    self.mark[self.members(x)] = True
                    lost = self.members(leader)[~self.mark[self.members(leader)]]
                    self.mark[self.members(x)] = False
                    change = np.zeros(self.n, np.int64)
                    for tokens, sign in ((gained, 1), (lost, -1)):
                        for t in tokens:
                            change[self.list_owner[self.list_starts[t]:self.list_starts[t + 1]]] += sign
                    near = far[possible]
                    exact = far_overlap[possible] + change[near]
                    for z in near[self.linked(exact, int(x), near)]:
                        join(int(x), int(z))
                    outside = np.array([self.root(int(z)) != home for z in far], bool)
                    far, far_overlap = far[outside], far_overlap[outside]
        return out


_SCORE = pa.schema([("cluster", pa.int64()), ("set_id", pa.int64()), ("nearness", pa.float64())])


def cluster_links(sets: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """``a, b``: links that connect what is linked, within ``sets(cluster, set_id, n_shingles, values)``."""

    def decoded(rows: pa.Table) -> dict[int, np.ndarray]:
        return {i: np.frombuffer(v, np.uint64) for i, v in zip(rows.column("set_id").to_pylist(), rows.column("values").to_pylist())}

    def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return shared, len(a) + len(b) - shared

    def within(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("set_id")
        own = decoded(rows)
        ids, settled = list(own), np.zeros(len(own), bool)
        if "settled" in rows.column_names:
            known = dict(zip(rows.column("set_id").to_pylist(), rows.column("settled").to_pylist()))
            settled = np.array([known[i] for i in ids], bool)
        found = SetGroup(list(own.values()), percent).links(settled) if len(ids) > 1 else []
        del own, rows
        give_back()
        return pa.table([pa.array([ids[x] for x, _ in found], pa.int64()),
                         pa.array([ids[y] for _, y in found], pa.int64())], _EDGE)

    def nearness(rows: pa.Table) -> pa.Table:
        """How similar each set of a share is to what most sets of the sample hold."""
        sample = decoded(rows.filter(rows.column("sampled")))
        own = decoded(rows.filter(pa.compute.invert(rows.column("sampled"))))
        held, counts = np.unique(np.concatenate(list(sample.values())), return_counts=True)
        common = held[2 * counts >= len(sample)]
        scores = [shared / max(1, total) for shared, total in (similarity(common, v) for v in own.values())]
        cluster = rows.column("cluster")[0].as_py()
        give_back()
        return pa.table([pa.array([cluster] * len(own), pa.int64()), pa.array(list(own), pa.int64()), pa.array(scores, pa.float64())], _SCORE)

    def to_centre(rows: pa.Table) -> pa.Table:
        """Links to the cluster's centre; a set without one as an edge to itself."""
        centre = rows.column("centre")[0].as_py()
        own, a, b = decoded(rows), [], []
        for i, v in own.items():
            if i != centre:
                shared, total = similarity(own[centre], v)
                a.append(centre if 100 * shared >= percent * total else i)
                b.append(i)
        give_back()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], _EDGE)

    weight = sets.groupBy("cluster").agg(F.sum("n_shingles").alias("weight")).withColumn(
        "blocks", F.ceil(F.col("weight") / block_shingles)).select(F.col("cluster").alias("_c"), "blocks")
    # Few clusters are large: there are at most all shingles / block_shingles of them.
    large = staged(weight.filter("blocks > 1"), "large-clusters")
    many = large.count()
    if not many:
        return sets.groupBy("cluster").applyInArrow(within, "a long, b long")

    def per_cluster(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if many <= 100_000 else table

    dealt = sets.join(per_cluster(large), F.col("cluster") == F.col("_c"), "left").drop("_c")
    small = dealt.filter("blocks IS NULL").drop("blocks").groupBy("cluster").applyInArrow(within, "a long, b long")
    big = dealt.filter("blocks IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    # About half a block of each cluster, its first set in any case.
    sampled = (F.col("set_id") == F.col("cluster")) | (F.pmod(F.xxhash64("set_id", F.lit(1)), 2 * F.col("blocks")) == 0)
    share = big.withColumn("sampled", F.lit(False))
    scores = share.unionByName(big.filter(sampled).withColumn("block", everywhere).withColumn("sampled", F.lit(True))).groupBy(
        "cluster", "block").applyInArrow(nearness, "cluster long, set_id long, nearness double")
    centres = staged(scores.groupBy("cluster").agg(F.max_by("set_id", F.struct("nearness", "set_id")).alias("centre")), "centres")
    big = big.join(per_cluster(centres.withColumnRenamed("cluster", "_c")), F.col("cluster") == F.col("_c")).drop("_c")
    centre = big.filter("set_id = centre").withColumn("block", everywhere)
    first = staged(big.filter("set_id <> centre").unionByName(centre).groupBy("cluster", "block").applyInArrow(
        to_centre, "a long, b long"), "first-links")
    alone = first.filter("a = b").select(F.col("a").alias("_alone"))
    left = staged(big.join(alone, F.col("set_id") == F.col("_alone"), "left_semi").drop("block"), "unlinked-sets")
    # The others but the centre, which all have met already; of these, no two need a look.
    settled = big.filter("set_id <> centre").join(alone, F.col("set_id") == F.col("_alone"), "left_anti").drop("block")

    def counted(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / block_shingles).alias(name))

    dealing = per_cluster(staged(counted(left, "chunks").join(counted(settled, "shares"), "cluster", "left"), "dealing").withColumnRenamed("cluster", "_c"))

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    def dealt_out(table: DataFrame, mark: bool) -> DataFrame:
        return table.join(dealing, F.col("cluster") == F.col("_c")).drop("_c").withColumn("settled", F.lit(mark)).withColumn(
            "own", F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("shares" if mark else "chunks")))

    # Each two blocks of unlinked sets meet once, and each block meets each share of the others.
    left, settled = dealt_out(left, False), dealt_out(settled, True)
    pairs = left.withColumn("other", numbers("chunks")).withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    against = settled.withColumn("x", F.col("own")).withColumn("y", numbers("chunks")).withColumn("y", -1 - F.col("y"))
    chunks = left.filter("shares IS NOT NULL").withColumn("x", numbers("shares")).withColumn("y", -1 - F.col("own"))
    met = pairs.drop("other").unionByName(against).unionByName(chunks).select("cluster", "x", "y", "set_id", "values", "settled")
    second = met.groupBy("cluster", "x", "y").applyInArrow(within, "a long, b long")
    return small.unionByName(first.filter("a <> b")).unionByName(second)


def jaccard_components(
    docs: DataFrame, width: int = 4, percent: int = 85, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with shuffles_removed(spark):
        table = staged(set_table(docs, width), "sets")
        sets = table.filter("n_shingles > 0").groupBy("set_id").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("sample"), F.min("doc_id").alias("least"), F.min("n_shingles").alias("n_shingles"),
            F.min("set_check").alias("low"), F.max("set_check").alias("high"))
        sets = staged(sets, "distinct-sets")
        total, clash = sets.agg(F.sum("n_shingles"), F.count(F.when(F.col("low") != F.col("high"), 1))).first()
        if clash:
            raise ValueError("two sets share a 64-bit id")
        own = table.select("doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id"))
        buckets = max(64, int((total or 0) * 0.35 / BUCKET_KEYS))
        hopeful = staged(shared_parts(docs, width, percent, buckets).withColumnRenamed("set_id", "hopeful"), "hopeful-sets")
        wanted = sets.join(hopeful, F.col("set_id") == F.col("hopeful")).select(
            F.col("sample.doc_id").alias("w_id"), F.col("sample.text_hash").alias("w_hash"))

        def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    values = shingle_sets(*utf8(part.column("text")), width)
                    yield pa.record_batch({
                        "set_id": pa.array([set_id(v) for v in values], pa.int64()),
                        "n_shingles": pa.array([len(v) for v in values], pa.int64()),
                        "values": pa.array([v.tobytes() for v in values], pa.binary())})

        same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))
        found = staged(_texts(docs).join(wanted, same).select("text").mapInArrow(
            valued, "set_id long, n_shingles long, values binary"), "hopeful-values")
        total = found.agg(F.sum("n_shingles")).first()[0] or 0
        clusters = staged(components(part_edges(found, percent, max(64, int(total * 0.35 / BUCKET_KEYS)))).withColumnRenamed(
            "component", "cluster"), "clusters")
        # Equal rows repeat their set.
        candidates = staged(found.dropDuplicates(["set_id"]).join(clusters, F.col("set_id") == F.col("node")).select(
            "cluster", "set_id", "n_shingles", "values"), "cluster-sets")
        linked = components(cluster_links(loosened(candidates, percent, block_shingles), percent, block_shingles))
    # The smallest doc_id of every component, over its distinct sets and then its rows.
    home = sets.join(linked, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("home"))
    least = home.groupBy("home").agg(F.min("least").alias("component_id"))
    named = home.join(least.hint("merge"), "home").select(F.col("set_id").alias("_set"), "component_id")
    return (own.join(named.hint("merge"), F.col("set_id") == F.col("_set"), "left")
            .select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with the smallest ``doc_id`` of their component, once each."""
    first = jaccard_components(docs, **options).filter("doc_id <=> component_id").groupBy("doc_id").agg(
        F.min("text_hash").alias("_hash")).select(F.struct(F.col("doc_id").alias("id"), F.col("_hash").alias("hash")).alias(unused(docs)))
    key = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    return docs.join(first, key.eqNullSafe(F.col(unused(docs))), "left_semi")
