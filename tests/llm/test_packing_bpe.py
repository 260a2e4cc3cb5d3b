"""Packing and byte-pair encoding against the tokenizers library."""

import importlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import corpus, empty, table
from tokenizers import Tokenizer

from certrisk.llm import units
from certrisk.llm.bpe import encode_decode
from certrisk.llm.common import utf8
from certrisk.llm.packing import pack
from certrisk.llm.units import UnitTable

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b", "\n\n x", "x\n", " lead", "trail ", "it's we're!'s", "<|endoftext|> a<|endoftext|>b", "nb sp  x", "— dash–", "1 23é4",
       "é combining", "\tt\t", "a \n b", "ΣΑΣ İx", "x!y", "\x1c a"]


def rows():
    return corpus() + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("open_windows, merge_factor", [(64, 32), (3, 2)])
def test_pack(spark, open_windows, merge_factor):
    own = rows()
    out = pack(table(spark, own, 7), BYTES, window=256, open_windows=open_windows, merge_factor=merge_factor).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    want = sorted((-1 if r[0] is None else r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in own)
    by_doc = defaultdict(list)
    for r in out:
        assert len(r.ids) == 4 * r.length
        by_doc[-1 if r.doc_id is None else r.doc_id].append(r)
    got = []
    for doc, pieces in by_doc.items():
        copies = sum(p.start == 0 for p in pieces)
        per_start = defaultdict(list)
        for p in pieces:
            per_start[p.start].append(p)
        if copies == 1:
            ids = b"".join(p.ids for p in sorted(pieces, key=lambda p: p.start))
            assert [p.start for p in sorted(pieces, key=lambda p: p.start)] == list(
                np.cumsum([0] + [p.length for p in sorted(pieces, key=lambda p: p.start)])[:-1])
            got.append((doc, tuple(np.frombuffer(ids, "<u4"))))
        else:  # equal rows: together they hold every id as often
            assert sum(p.length for p in pieces) == sum(len(ids) for d, ids in want if d == doc)
            got += [(d, ids) for d, ids in want if d == doc]
    assert sorted(got) == want
    filled = defaultdict(list)
    for r in out:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in out)
    assert len(filled) <= total / 256 * 1.05 + 2


def colliding(n=2048):
    """Two words of the same letters that all sums of powers modulo 2**64 take for one."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_units_are_told_apart_by_bytes(monkeypatch):
    """With hashes of two bits nearly all units collide, and every id is right all the same."""
    monkeypatch.setattr(units, "text_hashes", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(4))
    tokenizer = Tokenizer.from_file(BYTES)
    made = UnitTable(units.encoder(BYTES), units.word_encoder(BYTES), most=50, recent=10)
    for _ in range(3):
        for r in rows():
            data, starts = utf8(pa.array([r[1], "and more words", r[1]], pa.string()))
            ids, at = made.encode_rows(data, starts)
            for k, text in enumerate((r[1], "and more words", r[1])):
                assert list(ids[at[k]:at[k + 1]]) == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_a_small_table_that_forgets():
    tokenizer = Tokenizer.from_file(BYTES)
    made = UnitTable(units.encoder(BYTES), units.word_encoder(BYTES), most=300, recent=40)
    for _ in range(2):
        for r in rows():
            ids, _ = made.encode_rows(*utf8(pa.array([r[1]], pa.string())))
            assert list(ids) == tokenizer.encode(r[1] or "", add_special_tokens=False).ids
    assert len(made.known.keys) <= 700


def test_colliding_words(spark):
    own = [(i, w, "en", "s", 1) for i, w in enumerate([*colliding(), " ".join(colliding())])]
    tokenizer = Tokenizer.from_file(BYTES)
    for r in pack(table(spark, own, 1), BYTES, window=4096).collect():
        want = tokenizer.encode(own[r.doc_id][1], add_special_tokens=False).ids + [0]
        assert list(np.frombuffer(r.ids, "<u4")) == want[r.start:r.start + r.length]
    tokenizer = Tokenizer.from_file(WORDS)
    for r in encode_decode(table(spark, own, 1), WORDS).collect():
        assert list(np.frombuffer(r.ids, "<u4")) == tokenizer.encode(own[r.doc_id][1], add_special_tokens=False).ids


def test_pack_empty(spark):
    assert pack(empty(spark), BYTES).count() == 0


@pytest.mark.parametrize("table_bytes", [1 << 30, 0])
def test_bpe(spark, table_bytes):
    own = rows()
    out = encode_decode(table(spark, own), WORDS, table_bytes=table_bytes, frequent=40).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = []
    for r in own:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want.append((-1 if r[0] is None else r[0], tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(np.frombuffer(r.ids, "<u4")), r.decoded) for r in out) == sorted(want)


def test_words_that_share_a_hash(spark, monkeypatch):
    """With hashes of few values most words clash, within a slice and between slices; all of these are noticed."""
    weak = importlib.import_module("certrisk.llm.bpe")
    whole = weak.text_hashes

    def few(data, start, end):
        return whole(data, start, end) % np.uint64(23)

    monkeypatch.setattr(weak, "text_hashes", few)
    own = rows()[:20] + [(5000, "aa bb", "en", "s", 1)]
    words = {r.hash: (r.word, r.other) for r in encode_all(spark, own).collect()}
    assert any(a != b for a, b in words.values())
    monkeypatch.undo()


@pytest.mark.parametrize("table_bytes", [1 << 30, 0])
def test_words_in_no_table_are_encoded_where_they_stand(spark, monkeypatch, table_bytes):
    bpe, own = importlib.import_module("certrisk.llm.bpe"), rows()
    whole = bpe.encoded_words
    monkeypatch.setattr(bpe, "encoded_words", lambda words, path: whole(words, path).filter("pmod(hash, 3) <> 0"))
    out = encode_decode(table(spark, own), WORDS, table_bytes=table_bytes, frequent=40).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(np.frombuffer(r.ids, "<u4"))) for r in out) == sorted(
        (-1 if r[0] is None else r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in own)


def encode_all(spark, own):
    """Distinct words, gathered in this process, so that its patched hashes count."""
    made = []
    bpe = importlib.import_module("certrisk.llm.bpe")

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, gather, _):
            batch = pa.record_batch({"text": pa.array([r[1] for r in own], pa.string())})
            made.extend(r for b in gather(iter([batch])) for r in b.to_pylist())
            return spark.createDataFrame([(r["hash"], bytearray(r["word"]), r["n"]) for r in made], "hash long, word binary, n long")

    return bpe.distinct_words(Rows())


def test_bpe_empty(spark):
    assert encode_decode(empty(spark), WORDS).count() == 0


def test_crc_is_of_little_endian_ids():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")
