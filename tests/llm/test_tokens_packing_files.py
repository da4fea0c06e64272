"""Operators 6 and 8 and the tokenizer helper, against the tokenizers library and exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tunefold.llm import packing, tokenfile
from tunefold.llm.queries import op6_karmarkar_karp_packing, op8_arrow_token_files, tokenizer_path
from tunefold.llm.tokens import PieceEncoder

ODD = [
    "", " ", "  a  b", " \n a\n", "it's o'clock, don't", "x́y é́ a² b3c Ⅷ", "αβγ λα word_αx", "a\tb  c", "<|endoftext|> x", 'token="ab12" x!!y',
    "a\n\n b \nc", "naïve ﬁ İx I İ", "'s 's s'", "a b c\x1cd", "END!! OF,!! A.B ,x", "a,b.c ... , .", "wörd​s ﻿x", "日本語 текст", "\x01a b",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_librarys_ids(name):
    rng = random.Random(3)
    signs = [" ", "\n", ",", ".", "!", "'", "a", "B", "é", "9", "\t", "the", "  ", "Ω"]
    texts = ODD + ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(1500)]
    tok, enc = Tokenizer.from_file(tokenizer_path(name)), PieceEncoder(tokenizer_path(name))
    got = enc.encode(texts) + enc.encode(texts[::-1])[::-1]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want + want


def test_differencing_deals_every_piece_once_and_evenly():
    rng = random.Random(1)
    for k in (1, 2, 7, 40):
        sizes = [rng.randint(1, 500) for _ in range(5 * k)]
        found = packing.difference(sizes, k)
        assert sorted(i for w in found for i in w) == list(range(len(sizes))) and len(found) == k
        loads = [sum(sizes[i] for i in w) for w in found]
        assert max(loads) - min(loads) <= 200
    assert packing.difference([8, 7, 6, 5, 4], 2) and packing.difference([], 3) == [[], [], []]


def test_windows_rise_until_all_fit():
    assert len(packing.windows([3, 3, 3], 5)) == 3  # 2 would do by the sum
    assert packing.windows([], 5) == []


def _check_pieces(rows, texts, capacity=2048):
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return 1 - sum(r.length for r in rows) / (capacity * len(by_seq))


def test_packing_round_trip(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert _check_pieces(op6_karmarkar_karp_packing(spark, sf).collect(), texts) < 0.02


def test_packing_odd_rows(docs_of):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "a", None: "b c"}
    df = docs_of(texts.items(), sequence_id=5, offset="x")
    _check_pieces(packing.pack(df, tokenizer_path("byte_bpe_50k.json")).collect(), texts)
    assert packing.pack(docs_of([]), tokenizer_path("byte_bpe_50k.json")).count() == 0
    assert packing.pack(docs_of([(1, "a"), (1, "a")]), tokenizer_path("byte_bpe_50k.json")).count() == 2


def _check_files(rows, texts):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    at = 0
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = np.array(tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_round_trip(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    _check_files(op8_arrow_token_files(spark, sf).collect(), texts)


def test_token_files_odd_rows(spark, docs_of):
    path = tokenizer_path("word_bpe_49k.json")
    texts = {1: None, 2: "", 3: "word, " * 300_000, 4: "a"}
    _check_files(tokenfile.token_files(spark, docs_of(texts.items(), start=1, path="p"), path).collect(), texts)
    assert tokenfile.token_files(spark, docs_of([]), path).count() == 0
    twice = tokenfile.token_files(spark, docs_of([(7, "b"), (7, "a"), (None, "c")]), path).collect()
    assert sorted(r.start for r in twice) == [0, 2, 4] and [r.start for r in twice if r.doc_id is None] == [0]


def test_sequences_are_views_of_the_mapped_file(tmp_path):
    path = str(tmp_path / "x.arrow")
    with tokenfile.opened(path, write=True) as sink:
        out = tokenfile.ShardWriter(sink, length=4, rows=3)
        out.write(np.arange(30, dtype=np.uint32))
        out.close()
    shard = tokenfile.Shard(path)
    before = pa.total_allocated_bytes()
    ids, mask = shard.sequence(7)
    assert ids.tolist() == [28, 29, 0, 0] and mask.to_pylist() == [True, True, False, False] and not ids.flags.owndata
    assert pa.total_allocated_bytes() == before
    assert [s.tolist() for s in shard.spans([(2, 3), (10, 5), (29, 1)])] == [[2, 3, 4], [10, 11, 12, 13, 14], [29]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_letters_before_every_sign(name):
    """Letters of all kinds that count as safe, and U+0130, before each ASCII sign, digit and some others."""
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalpha()] + ["\u0307", "\u0301", "é", "x", " ", "\n"]
    letters = "aZÀÿĀĳŉſƀǅǰɏİıİİ"
    texts = [f"{w}{x}{s}{t}" for w in ("", "kitabı ", "TBMM") for x in letters for s in signs for t in ("", " Kaya", "y.")]
    tok, enc = Tokenizer.from_file(tokenizer_path(name)), PieceEncoder(tokenizer_path(name))
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want


def test_a_doc_id_with_a_third_of_all_rows_is_spread(spark, docs_of):
    path = tokenizer_path("word_bpe_49k.json")
    rng = random.Random(2)
    texts = [(5, rng.choice(["same", f"text {i}", None])) for i in range(600)] + [(i, f"number {i}") for i in range(6, 1200)] + [(1, "a"), (None, "n")]
    rng.shuffle(texts)
    manifest = tokenfile.write_tokens(docs_of(texts), path, tokenfile.qualified(spark, tokenfile.scratch_path(spark, "tokens")))
    assert max(r.n_docs for r in manifest.collect()) < 600
    rows = sorted(tokenfile.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id or 0 for r in rows] == sorted(i or 0 for i, _ in texts)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0


def test_addresses_without_scheme_are_the_default_file_systems(spark):
    assert tokenfile.qualified(spark, "/tmp/x").startswith("file:/") and tokenfile.qualified(spark, "file:/tmp/x") == "file:/tmp/x"
