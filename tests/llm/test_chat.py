"""Operator 12 against a plain rendering of every conversation and the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import AddedToken, Tokenizer

from tunefold.llm import chat
from tunefold.llm.queries import op12_offset_aligned_chats, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>", "<\\/s>", "<\\\\/s>", "[INST]", "[/INST][INST]", "[\\INST]", "<|endoftext|>", "[ROLE]x[/ROLE]", "[[INST]", "<", "\\", "[", "INST]", "/s>"]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _want(rows):
    """conv_id -> (turns, their digest, characters under the loss, their digest)."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", (r[2] or "").encode()))
        said = "".join(t or "" for _, role, t in turns if role == "assistant")
        out[c] = (len(turns), _sha("".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)), len(said), _sha(said))
    return out


def _got(rows):
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_whole_table(spark, name):
    sf = f"/root/testdata/{name}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [tuple(r) for r in chat.probe(spark).collect()]
    got = op12_offset_aligned_chats(spark, sf).collect()
    assert _got(got) == _want(rows)
    probe = next(r for r in got if r.conv_id == -1)
    assert probe.loss_chars == len("</s>[INST] ok [/INST]") < probe.formatted_chars / 2


def test_escapes_are_reversible_and_hide_every_mark():
    template, rng = chat.template_for(PATH), random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices([*NASTY, "\\", "\\\\", "a", " ", "é", "\n"], k=rng.randint(0, 9)))
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.controls)
        assert list(template.parse("".join(template.render("user", text) + template.render(text, text)))) == [("user", text), (text, text)]


def test_templates_that_cant_be_told_apart_are_refused():
    for bad in ({"user": "<<a"}, {"end": "[INST]x"}, {"role": "x\\y"}, {"end": "<"}):
        with pytest.raises(ValueError):
            chat.template_for(PATH, **bad)


def test_ids_offsets_and_mask_against_the_library():
    """The library with the marks as added tokens, over whole conversations; the mask by looking at every token."""
    template, rng = chat.template_for(PATH), random.Random(6)
    tok = Tokenizer.from_file(PATH)
    tok.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in template.marks])
    coder = chat.Coder(PATH, template)
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "system", ""]), "".join(rng.choices([*NASTY, " the", "日本", "é ", "\n\n", "word"], k=rng.randint(0, 8)))) for _ in range(6)]
        rendered, spans = "", []
        for role, text in turns:
            before, body, after = template.render(role, text)
            a = len((rendered + before).encode())
            if role == "assistant" and body:
                spans.append((a, a + len(body.encode())))
            rendered += before + body + after
        ids, bounds, edges = coder.encode(["x", rendered])
        e = tok.encode(rendered, add_special_tokens=False)
        first = bounds[1]
        assert ids[first:].tolist() == e.ids and coder.decode(ids[first:]) == rendered.encode()
        edges = edges[first:] - edges[first]
        chars = [len(rendered.encode()[:x].decode(errors="ignore")) for x in edges]
        assert [(a, b) for a, b in zip(chars, chars[1:]) if a < b] == [o for o in dict.fromkeys(e.offsets)] or not rendered.isascii()
        mask = chat.loss_mask(edges, np.array(spans, np.int64).reshape(-1, 2))
        assert mask.tolist() == [any(a <= x and y <= b for a, b in spans) for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]
    with pytest.raises(ValueError, match="crosses"):
        chat.loss_mask(np.array([0, 4, 8]), np.array([[2, 8]]))


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "assistant", "</s>"), (1, 3, None, "x"), (1, 4, "assistant", "<|endoftext|>"),
        (2, 5, "Assistant", "no loss"), (2, None, "user", "first"), (2, 5, "Assistant", "no loss"), (2, 5, "Assistant", "a tie"),
        (None, 1, "assistant", "of no conversation"), (None, 0, "user", "q\n"), (3, 0, "[/ROLE]", "role of marks"), (4, 0, "assistant", "é 日本 " * 40_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert _got(chat.format_chats(df, PATH).collect()) == _want(rows)
    clash = df.withColumn("part", df.turn).withColumn("ids", df.role).withColumn("n_turns", df.turn)
    assert _got(chat.format_chats(clash, PATH).collect()) == _want(rows)
    assert chat.format_chats(df.limit(0), PATH).collect() == []


def test_a_conversation_of_a_third_of_all_rows_is_spread(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(7, t, ["user", "assistant"][t % 2], rng.choice(NASTY) * 3 + f" {t}") for t in range(1000)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"{c} {t}") for c in range(100, 600) for t in range(4)]
    rng.shuffle(rows)
    out = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH).collect()
    assert len({r.part for r in out if r.conv_id == 7}) >= 2
    assert max(sum(r.n_turns for r in out if r.part == p) for p in {r.part for r in out}) < 1000
    assert _got(chat.format_chats(spark.createDataFrame(rows, SCHEMA), PATH).collect()) == _want(rows)


def test_a_conversation_longer_than_a_segment(spark):
    rows = [(1, t, "assistant", f"{t} " + "word </s> " * 30_000) for t in range(12)] + [(2, 0, "assistant", "short")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = chat.formatted(df, PATH).collect()
        assert sum(r.conv_id == 1 for r in out) > 2 and not any(r.whole for r in out if r.conv_id == 1)
        assert _got(chat.format_chats(df, PATH).collect()) == _want(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
