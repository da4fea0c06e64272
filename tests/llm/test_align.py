"""Operator 11 against the libraries and a plain double loop over tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tunefold.llm import align
from tunefold.llm.chat import _letters
from tunefold.llm.queries import op11_lockstep_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  two  spaces ", "\n", "plain words, and more.", "日本語 текст", "é é", "<|endoftext|> x", "</s> <s> <unk> <0x41>", "▁ under",
    "nul \x00 byte", "=" * 300, "-" * 77 + "=" * 31 + " end", "a" * 5000, "tab\tand space", "it's 3.14159 o'clock", "\U0001f600 smile", "x" * 9 + " " * 40 + "y",
]


def _want(texts):
    """Brute force over (key, text): one tuple per row, in order."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters, words = _letters(), {i: w for w, i in tok.get_vocab().items()}
    rows, holds = [], Counter()
    for _, text in texts:
        if not text:
            rows.append(([], [], [], Counter()))
            continue
        ids_a, ids_b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bytes_a = [bytes(letters[c] for c in words[i]) for i in ids_a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            rows.append(([], [], [], Counter()))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))), np.cumsum(list(map(len, bytes_b)))
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            u, v = int((ends_a <= end).sum()), int((ends_b <= end).sum())
            groups.append((ids_a[x:u], ids_b[y:v]))
            x, y = u, v
        links = Counter()
        for g, h in groups:
            ca, cb = Counter(g), Counter(h)
            for i in ca:
                for j in cb:
                    links[i, j] += ca[i] * cb[j]
        holds.update(links.keys())
        rows.append((ids_a, ids_b, groups, links))
    most = {}
    for (i, _), c in holds.items():
        most[i] = max(most.get(i, 0), c)
    out = []
    for (key, _), (ids_a, ids_b, groups, links) in zip(texts, rows):
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            key, len(ids_a), len(ids_b), len(groups), sum(links.values()), sum(n for p, n in links.items() if holds[p] == most[p[0]]),
            sum(n * holds[p] for p, n in links.items()), hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def _got(df):
    names = [c.split()[0] for c in align.ROWS.split(", ")]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_whole_table(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(op11_lockstep_alignment(spark, sf)) == _want(texts)


@pytest.mark.parametrize("block_bytes", [1, 3000, align.BLOCK_BYTES])
def test_odd_texts_in_any_blocks(docs_of, block_bytes):
    rng = random.Random(4)
    signs = ["the ", "Wörter", "  ", "\n", "123", "...", "日", "=", "==", " x", "\t", "</s>", "é", "ing"]
    texts = list(enumerate(ODD + ["".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(150)]))
    texts += [(None, "repeated row"), (None, "repeated row"), (3, "repeated id"), (3, None)]
    docs = docs_of(texts, block=1, place=2, a=3, count=4)
    assert _got(align.aligned(docs, A, B, block_bytes)) == _want(texts)


def test_empty_table(docs_of):
    assert align.aligned(docs_of([(1, "x")]).limit(0), A, B).collect() == []


def test_a_third_of_all_rows_alike(docs_of):
    texts = [(i, "the same words again") for i in range(60)] + [(100 + i, f"other words {i}") for i in range(120)]
    assert _got(align.aligned(docs_of(texts), A, B, 500)) == _want(texts)


@pytest.mark.parametrize("lane", [1, 2, 7, 50, 10_000])
def test_cuts_of_random_ends_in_lanes(lane):
    rng = np.random.default_rng(lane)
    sizes = rng.integers(0, 200, 40)
    starts = np.cumsum(sizes) - sizes
    last = set((starts + sizes)[sizes > 0].tolist())
    ends = [np.array(sorted(set(rng.integers(1, sizes.sum() + 1, 900).tolist()) | last)) for _ in range(2)]
    a, b = align.cuts(*ends, *align.lanes(starts, sizes, lane))
    both = np.intersect1d(*ends)
    assert ends[0][a].tolist() == ends[1][b].tolist() == both.tolist()


def test_a_wide_group_is_counted_not_multiplied_out():
    """Two runs of 20,000 tokens out of step: 4 * 10^8 links in four pairs."""
    n = 20_000
    ids_a, ids_b = np.array([1, 2] * (n // 2)), np.array([3] * (n - 1) + [4])
    groups = align.Groups(np.array([0, n]), np.array([0, n]))
    doc, pair, times = align.linked(ids_a, ids_b, groups, np.zeros(1, np.int64), 10)
    assert doc.tolist() == [0] * 4 and pair.tolist() == [13, 14, 23, 24]
    assert times.tolist() == [n // 2 * (n - 1), n // 2, n // 2 * (n - 1), n // 2]


def test_plain_special_tokens():
    side = align.ByteLevel(A)
    assert 50256 not in side.encode(["<|endoftext|>"])[0].tolist()
