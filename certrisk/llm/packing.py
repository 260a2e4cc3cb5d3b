"""Packing of token sequences into windows with bounded space, online.

Each task keeps ``open_windows`` windows open. A document of at least a window fills whole
windows of its own; what is left of it goes, best fit, into the open window that it leaves
the least room in. When it fits in none, the fullest window is emitted: a gap of at most
``max_gap`` ids is left as padding, a larger one is filled with the head of the piece. At
the end of a task its open windows are leftovers. These are merged by the same rule in
rounds, ``merge_factor`` tasks' leftovers in each task, until one task holds all; every
task of a round reads at most ``merge_factor * open_windows`` windows.

Defined results: a null or empty text is its end id alone; a null ``doc_id`` stays null and
rows with equal ``doc_id`` are packed each on its own; an empty table gives no rows; other
columns of ``docs`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, slices, utf8
from certrisk.llm.units import tokenizer_table
from certrisk.session import staged

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary, open boolean")
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("ids", pa.binary()), ("open", pa.bool_())])
FLUSH_ROWS = 1_000


class Packer:
    """The open windows of one task. ``place`` adds a piece; ``rows`` holds what was emitted."""

    def __init__(self, window: int, open_windows: int, max_gap: int, first_id: int):
        self.window, self.open_windows, self.max_gap = window, open_windows, max_gap
        self.next_id = first_id
        self.used: list[int] = []
        self.held: list[list[tuple]] = []
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple], is_open: bool = False) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), total, self.next_id, at,
                              ids.tobytes(), is_open))
            at += len(ids)
        self.next_id += 1

    def place(self, doc_id: int | None, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.window:
            self._emit([(doc_id, start, ids[:self.window], total)])
            start, ids = start + self.window, ids[self.window:]
        while len(ids):
            room = self.window - len(ids)
            best = max((u for u in self.used if u <= room), default=-1)
            if best >= 0:
                k = self.used.index(best)
                self.held[k].append((doc_id, start, ids, total))
                self.used[k] += len(ids)
                if self.used[k] == self.window:
                    self._emit(self.held.pop(k))
                    self.used.pop(k)
                return
            if len(self.used) < self.open_windows:
                self.used.append(len(ids))
                self.held.append([(doc_id, start, ids, total)])
                return
            k = self.used.index(max(self.used))
            gap = self.window - self.used.pop(k)
            pieces = self.held.pop(k)
            if gap > self.max_gap:
                pieces.append((doc_id, start, ids[:gap], total))
                start, ids = start + gap, ids[gap:]
            self._emit(pieces)

    def finish(self, is_open: bool) -> None:
        for pieces in self.held:
            self._emit(pieces, is_open)
        self.used, self.held = [], []

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = list(zip(*self.rows))
            self.rows = []
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], _SCHEMA)


def _first_id(level: int) -> int:
    """Sequence numbers of one task: 7 bits of round, 24 of task, 32 of window."""
    return level << 56 | TaskContext.get().partitionId() << 32


def encoded_documents(
    docs: DataFrame, tokenizer: str, end_id: int, window: int, open_windows: int, max_gap: int,
) -> DataFrame:
    """Tokenise and pack each partition: final pieces, and those of windows left open."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokenizer_table(tokenizer)
        packer = Packer(window, open_windows, max_gap, _first_id(0))
        for batch in batches:
            for part in slices(batch):
                ids, starts = table.encode_rows(*utf8(part.column("text")))
                for k, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[starts[k]:starts[k + 1]], np.uint32(end_id)).astype("<u4")
                    packer.place(doc_id, 0, own, len(own))
                yield from packer.batches(FLUSH_ROWS)
        packer.finish(True)
        yield from packer.batches()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(pack, PIECES)


def merged_leftovers(
    pieces: DataFrame, level: int, last: bool, window: int, open_windows: int, max_gap: int,
) -> DataFrame:
    """Pack the pieces of each partition anew; windows may stay open unless it is the last round."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, open_windows, max_gap, _first_id(level))
        for batch in batches:
            for r in batch.to_pylist():
                packer.place(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
            yield from packer.batches(FLUSH_ROWS)
        packer.finish(not last)
        yield from packer.batches()

    return pieces.mapInArrow(pack, PIECES)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = 1024, open_windows: int = 64,
    max_gap: int = 8, merge_factor: int = 32,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are little-endian unsigned 32-bit numbers. Every id of a document, its end id
    included, is in one piece. Every round is staged, so that its windows stay the
    same when a task runs again.
    """
    bounded_batches(docs.sparkSession)
    first = encoded_documents(docs, tokenizer, end_id, window, open_windows, max_gap)
    level, done = 0, []
    current = staged(first, "packed")
    while True:
        done.append(current.filter("NOT open"))
        left = current.filter("open")
        tasks = left.select(F.shiftright("sequence_id", 32)).distinct().count()
        if not tasks:
            break
        tasks = -(-tasks // merge_factor)
        level += 1
        task = F.shiftright("sequence_id", 32).bitwiseAND(0xFFFFFF)
        grouped = left.withColumn("_task", F.floor(task / merge_factor)).repartition(
            tasks, "_task").sortWithinPartitions("sequence_id", "offset").drop("_task")
        if tasks == 1:
            done.append(staged(merged_leftovers(
                grouped, level, True, window, open_windows, max_gap), "packed"))
            break
        current = staged(merged_leftovers(
            grouped, level, False, window, open_windows, max_gap), "packed")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open")
