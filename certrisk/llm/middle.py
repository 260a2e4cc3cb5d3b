"""Fill-in-the-middle texts by secondary-sort assembly.

A document is cut into lines, two cuts drawn from a hash of its id part it into prefix, middle and
suffix, and its output joins these in another order, each behind a marker:

    psm   <P>prefix<S>suffix<M>middle        spm   <S>suffix<P>prefix<M>middle

A task cuts its documents into pieces, each a run of whole lines of one part (a line beyond ``PIECE`` bytes is cut within),
keyed by the document and the place in the output. One shuffle deals the pieces by document and sorts them by that key; a task
then streams them into one digest after another. For restoration the same pieces are sorted again
by the parts' first order, without a second shuffle, and streamed once more. So a task holds a batch of pieces, however long a document is.

Documents are dealt by id and text hash together, so neither many rows without an id nor many copies of a text meet in
one task. Rows of one Arrow batch that are equal in both travel as one, with their number.

Defined results: a null or empty text is plain, with no lines and empty output; a null ``doc_id`` is hashed as the empty
string and stays null; repeated rows give repeated results; an empty table gives no rows; columns other than ``doc_id``
and ``text`` are ignored, whatever their names. A text that holds a marker is plain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, slices, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, MIDDLE, SUFFIX)  # in the order of the text
#: Most bytes of a piece.
PIECE = 1 << 17
FLUSH_BYTES, FLUSH_ROWS = 1 << 20, 4_000
_KEY = [("doc_id", pa.int64()), ("digest", pa.int64()), ("row", pa.int64())]
_FACTS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("copies", pa.int64())]
_PIECES = pa.schema([*_KEY, ("place", pa.int64()), ("piece", pa.binary()), *_FACTS])
_PARTS = pa.schema([*_KEY, ("part", pa.int64()), ("place", pa.int64()), ("piece", pa.binary()), *_FACTS])
_RESULTS = pa.schema([("doc_id", pa.int64()), *_FACTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_TEXTS = pa.schema([("doc_id", pa.int64()), *_FACTS, ("output", pa.string())])
_DDL = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


class _Rows:
    """Rows gathered for the next Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (last or self.size >= FLUSH_BYTES or len(self.rows) >= FLUSH_ROWS):
            columns = zip(*self.rows)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema)], self.schema)
            self.rows, self.size = [], 0


def _runs(text: bytes, start: int, end: int, most: int) -> Iterator[bytes]:
    """The stretch in runs of whole lines of at most ``most`` bytes; one empty run if it is empty."""
    while end - start > most:
        stop = text.rfind(b"\n", start, start + most) + 1 or start + most
        yield text[start:stop]
        start = stop
    yield text[start:end]


def pieces(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, most: int = PIECE) -> DataFrame:
    """Pieces of all outputs, keyed by document (``doc_id, digest, row``) and ``place`` in the output.

    The first piece of a document also carries its facts. Out of 100 documents, ``rate`` are
    transformed, and out of 100 of these ``spm_rate`` start with the suffix.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), drawn.alias("_h")).select(
        "doc_id", "text", *numbers)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row = _Rows(_PIECES), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                data, starts = utf8(part.column("text"))
                raw = data.tobytes()
                feeds = np.flatnonzero(data == 10)
                lines = np.searchsorted(feeds, starts)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                ids = part.column("doc_id").to_pylist()
                copies: dict[tuple, list[int]] = {}
                for k, doc_id in enumerate(ids):
                    digest = xxhash.xxh3_128_digest(raw[starts[k]:starts[k + 1]])
                    copies.setdefault((doc_id, digest), []).append(k)
                drawn = [part.column(f"h{i}").to_pylist() for i in range(1, 5)]
                for (doc_id, digest), places in copies.items():
                    k, row = places[0], row + 1
                    a, b = int(starts[k]), int(starts[k + 1])
                    text, feed = raw[a:b], lines[k]
                    n = int(lines[k + 1] - feed) + (b > a and text[-1] != 10)
                    key = (doc_id, int.from_bytes(digest[:8], "little", signed=True), row)
                    h1, h2, h3, h4 = (h[k] for h in drawn)
                    if not text or h3 % 100 >= rate or any(m in text for m in MARKERS):
                        facts, parts = (n, "plain", None, None, len(places)), [(b"", 0, b - a)]
                    else:
                        one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
                        p, q = (0 if u == 0 else b - a if u == n else int(feeds[feed + u - 1]) + 1 - a for u in (one, two))
                        spm = h4 % 100 < spm_rate
                        facts = (n, "spm" if spm else "psm", int(chars[a + p] - chars[a]), int(chars[a + q] - chars[a + p]), len(places))
                        parts = [(PREFIX, 0, p), (SUFFIX, q, b - a), (MIDDLE, p, q)]
                        if spm:
                            parts[:2] = parts[1::-1]
                    place = 0
                    for marker, start, end in parts:
                        for run in _runs(text, start, end, most):
                            out.add(*key, place, marker + run, *(facts if not place else (None,) * 5), size=len(run))
                            marker, place = b"", place + 1
                    yield from out.batches()
        yield from out.batches(True)

    return rows.mapInArrow(emit, _ddl(_PIECES))


def in_output_order(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "row", "place")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Pieces one after the other, each with whether it is its document's first."""
    before = None
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["doc_id"], r["digest"], r["row"])
            yield key != before, r
            before = key


def digests(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every document."""
    bounded_batches(docs.sparkSession)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest outputs, and pass every piece on with the part of the text that the marker before it names."""
        out, first, digest, part = _Rows(_PARTS), None, None, 0

        def finished() -> None:
            out.add(first["doc_id"], first["digest"], first["row"], len(MARKERS), 0, digest.digest(), *(first[f] for f, _ in _FACTS))

        for is_first, r in _documents(batches):
            if is_first:
                if first is not None:
                    finished()
                first, digest, part = r | {"piece": None}, hashlib.sha256(), 0
            piece = r["piece"]
            digest.update(piece)
            if first["form"] != "plain" and piece[:3] in MARKERS:
                part, piece = MARKERS.index(piece[:3]), piece[3:]
            out.add(r["doc_id"], r["digest"], r["row"], part, r["place"], piece, *(None,) * 5, size=len(piece))
            yield from out.batches()
        if first is not None:
            finished()
        yield from out.batches(True)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Rows(_RESULTS), None
        for is_first, r in _documents(batches):
            digest = hashlib.sha256() if is_first else digest
            if r["part"] < len(MARKERS):
                digest.update(r["piece"])
            else:
                out.add(r["doc_id"], *(r[f] for f, _ in _FACTS), r["piece"].hex(), digest.hexdigest())
                yield from out.batches()
        yield from out.batches(True)

    parts = in_output_order(pieces(docs, **options)).mapInArrow(assemble, _ddl(_PARTS))
    found = parts.sortWithinPartitions("doc_id", "digest", "row", "part", "place").mapInArrow(restore, _ddl(_RESULTS))
    return _repeated(found)


def _repeated(found: DataFrame) -> DataFrame:
    """Equal rows that travelled as one, each on its own again."""
    columns = [c for c in found.columns if c != "copies"]
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(columns)


def transformed(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` with the whole output text of every document."""
    bounded_batches(docs.sparkSession)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, held = _Rows(_TEXTS), None, []

        def finished() -> None:
            text = b"".join(held).decode()
            out.add(first["doc_id"], *(first[f] for f, _ in _FACTS), text, size=len(text))

        for is_first, r in _documents(batches):
            if is_first:
                if first is not None:
                    finished()
                first, held = r, []
            held.append(r["piece"])
            yield from out.batches()
        if first is not None:
            finished()
        yield from out.batches(True)

    return _repeated(in_output_order(pieces(docs, **options)).mapInArrow(assemble, _ddl(_TEXTS)))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output of this form was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = (F.lit(x.decode()) for x in (PREFIX, SUFFIX, MIDDLE))

    def behind(mark: Column) -> Column:
        return F.substring(output, F.instr(output, mark) + 3, F.length(output))

    def before(text: Column, mark: Column) -> Column:
        return F.substring(text, F.lit(1), F.instr(text, mark) - 1)

    psm = F.concat(before(behind(p), s), behind(m), before(behind(s), m))
    spm = F.concat(before(behind(p), m), behind(m), before(behind(s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
