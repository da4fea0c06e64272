r"""Chat formatting with loss masks aligned by offsets (operator 12).

A conversation is rendered whole by a template, encoded once, and every token
gets its offsets in the rendered text. The spans of the assistant's texts are
known from rendering, sorted; a binary search of their edges among the token
offsets gives the tokens under the loss.

The template's marks are single tokens of their own, added behind the
tokenizer's vocabulary, so no token crosses a mark and the edges always meet
token edges (checked). A text that holds a mark, or a special token of the
tokenizer, is escaped: a backslash goes behind the first character, behind any
that stand there already (``</s>`` becomes ``<\/s>``, ``<\/s>`` becomes
``<\\/s>``). Taking one away again restores every text exactly.

At scale: rows are ranged by (conversation, turn, role, start of the text) and
sorted within ranges. A conversation lies in one range and becomes one output
row, unless it is longer than a range or than ``SEGMENT`` bytes: then each stretch
of turns becomes a row, encoded alike since marks part them. So a conversation
with a third of all rows is rendered and encoded by many tasks, none holding more
than a segment and one text. ``read_back`` hashes conversations of one row where
they lie; rows of longer ones, short by then, are brought together in order and
hashed as a stream, row by row.

Rows: null texts and roles count as empty. Turns are ordered by (turn, role,
text), null turns first; rows that tie are alike and are all kept. Null conv_ids are one conversation.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefold.llm.common import batches, written
from tunefold.llm.tokens import encoder

#: Bytes of rendered text in an output row before the next turn starts another, bytes of text encoded at once.
SEGMENT, AT_ONCE = 1_000_000, 500_000
#: Bytes of texts by which ranges are cut, beside conversation, turn and role.
PREFIX = 48

FORMATTED = "conv_id long, part int, seq int, whole boolean, n_turns int, ids array<int>, loss array<boolean>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


@dataclass(frozen=True)
class Template:
    """Marks around texts. ``reserved``: other strings that no text may hold unescaped (a tokenizer's special tokens)."""

    user: str = "[INST]"
    user_end: str = "[/INST]"
    role: str = "[ROLE]"
    role_end: str = "[/ROLE]"
    end: str = "</s>"
    reserved: tuple[str, ...] = ()
    _found: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or "\\" in c or heads & set(c[1:]) or any(o != c and o.startswith(c) for o in self.controls):
                raise ValueError(f"control string {c!r} can't be escaped or told apart")

    @property
    def marks(self) -> tuple[str, ...]:
        return (self.user, self.user_end, self.role, self.role_end, self.end)

    @property
    def controls(self) -> tuple[str, ...]:
        return (*self.marks, *self.reserved)

    def _pattern(self, name: str) -> re.Pattern:
        if not self._found:
            between = [(re.escape(c[0]), re.escape(c[1:])) for c in self.controls]
            u, v, r, s, e = map(re.escape, self.marks)
            self._found["escape"] = re.compile("|".join(rf"(?<={a})\\*(?={b})" for a, b in between))
            self._found["plain"] = re.compile("|".join(rf"(?<={a})\\(?=\\*{b})" for a, b in between))
            self._found["marks"] = re.compile("(" + "|".join(map(re.escape, self.marks)) + ")")
            self._found["turn"] = re.compile(f"{u}(?P<user>.*?){v}|{r}(?P<role>.*?){s}(?P<other>.*?){e}|(?P<assistant>.*?){e}", re.DOTALL)
        return self._found[name]

    def escape(self, text: str) -> str:
        return self._pattern("escape").sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._pattern("plain").sub("", text) if "\\" in text else text

    def render(self, role: str, text: str) -> tuple[str, str, str]:
        """What stands before a turn's escaped text, that text, and what stands after."""
        if role == "user":
            return self.user, self.escape(text), self.user_end
        if role == "assistant":
            return "", self.escape(text), self.end
        return self.role + self.escape(role) + self.role_end, self.escape(text), self.end

    def split(self, rendered: str) -> list[str]:
        """Texts and marks by turns."""
        return self._pattern("marks").split(rendered)

    def parse(self, rendered: str) -> Iterator[tuple[str, str]]:
        """Roles and texts of a rendered conversation, unescaped."""
        at = 0
        for m in self._pattern("turn").finditer(rendered):
            if m.start() != at:
                break
            at = m.end()
            role = m["role"]
            if role is not None:
                yield self.unescape(role), self.unescape(m["other"])
            elif m["user"] is not None:
                yield "user", self.unescape(m["user"])
            else:
                yield "assistant", self.unescape(m["assistant"])
        if at != len(rendered):
            raise ValueError("not a rendered conversation")


def _letters() -> dict[str, int]:
    """The printable character by which a byte-level vocabulary writes each byte, and the byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


_BYTES: dict[str, list[bytes]] = {}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer file."""
    if path not in _BYTES:
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        if (kind.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or kind.get("normalizer"):
            raise ValueError(f"{path}: only byte-level tokenizers give texts back")
        letters = _letters()
        vocab = kind["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in kind["added_tokens"])])
        out = [b""] * size
        for word, i in vocab.items():
            out[i] = bytes(letters[c] for c in word)
        for t in kind["added_tokens"]:
            out[t["id"]] = t["content"].encode()
        _BYTES[path] = out
    return _BYTES[path]


def template_for(path: str, **marks: str) -> Template:
    """The template whose texts also never hold the tokenizer's special tokens."""
    with open(path, encoding="utf-8") as f:
        return Template(reserved=tuple(t["content"] for t in json.load(f)["added_tokens"]), **marks)


class Coder:
    """Ids of rendered texts, and bytes of ids: the marks are the ids behind the vocabulary, in their order."""

    def __init__(self, path: str, template: Template):
        self.template, self.enc = template, encoder(path)
        self.bytes = token_bytes(path) + [m.encode() for m in template.marks]
        self.lengths = np.array(list(map(len, self.bytes)), np.int64)
        first = len(self.bytes) - len(template.marks)
        self.ids = {m: np.array([first + k], "<u4").tobytes() for k, m in enumerate(template.marks)}

    def encode(self, rendered: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text's begin, and the offsets (in bytes of all texts together) of the ids' edges."""
        parts = [self.template.split(r) for r in rendered]
        texts = iter(self.enc.encode([p for split in parts for p in split[::2]]))
        joined = [b"".join(self.ids[p] if k % 2 else next(texts) for k, p in enumerate(split)) for split in parts]
        ids = np.frombuffer(b"".join(joined), "<u4").astype(np.int32)
        bounds = np.cumsum([0, *(len(j) // 4 for j in joined)])
        return ids, bounds, np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def loss_mask(edges: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in the spans (sorted, two columns), given the offsets of all token edges."""
    edge = np.searchsorted(edges, spans)
    if not np.array_equal(edges[edge], spans):
        raise ValueError("a token crosses the edge of a turn")
    step = np.zeros(len(edges), np.int32)
    np.add.at(step, edge[:, 0], 1)
    np.add.at(step, edge[:, 1], -1)
    return np.cumsum(step)[:-1] > 0


def formatted(conversations: DataFrame, path: str, template: Template | None = None) -> DataFrame:
    """Token ids and loss mask of every conversation, one row each or, of very long ones, one per stretch of turns.

    ``conversations``: conv_id, turn, role, text. ``path``: a byte-level tokenizer file.
    Rows of one conversation follow each other by (part, seq); ``whole`` says that a row is all of it.
    """
    template = template or template_for(path)
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "conv_id", "turn", "role", F.substring("text", 1, PREFIX))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, seq = Coder(path, template), TaskContext.get().partitionId(), 0
        segments: list[tuple] = []  # conversation, its number here, turns, rendered text, spans in bytes
        held = 0

        def batch(last: bool) -> pa.RecordBatch:
            nonlocal segments, held
            ids, bounds, edges = coder.encode([s[3] for s in segments])
            begins = edges[bounds]
            spans = np.array([(b + x, b + y) for b, s in zip(begins.tolist(), segments) for x, y in s[4]], np.int64).reshape(-1, 2)
            mask = loss_mask(edges, spans)
            first, end = segments[0][1], segments[-1][1]
            # the first and the last conversation of a range may have rows in the next ones
            whole = [s[5] and not (s[1] == 0 or (last and s[1] == end)) for s in segments]
            at = pa.array(bounds, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([s[0] for s in segments], pa.int64()),
                    pa.array([task] * len(segments), pa.int32()),
                    pa.array([s[6] for s in segments], pa.int32()),
                    pa.array(whole),
                    pa.array([s[2] for s in segments], pa.int32()),
                    pa.ListArray.from_arrays(at, pa.array(ids)),
                    pa.ListArray.from_arrays(at, pa.array(mask)),
                ],
                names=[c.split()[0] for c in FORMATTED.split(", ")],
            )
            segments, held = [], 0
            return out

        conv, number, turns, text, spans, size, alone = None, -1, 0, [], [], 0, True

        def close(complete: bool) -> None:
            nonlocal turns, text, spans, size, held, seq, alone
            if turns:
                alone = alone and complete
                segments.append((conv, number, turns, "".join(text), spans, alone, seq))
                seq += 1
                held += size
            turns, text, spans, size = 0, [], [], 0

        for b in batches(parts, AT_ONCE):
            for c, role, said in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if c != conv or number < 0:
                    close(True)
                    conv, number, alone = c, number + 1, True
                    if held >= AT_ONCE:
                        yield batch(False)
                elif size >= SEGMENT:
                    close(False)
                    yield batch(False)
                before, body, after = template.render(role, said)
                start = size + len(before.encode())
                stop = start + len(body.encode())
                if role == "assistant" and stop > start:
                    spans.append((start, stop))
                size = stop + len(after.encode())
                text += (before, body, after)
                turns += 1
        close(True)
        if segments:
            yield batch(True)

    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, FORMATTED)


def read_back(table: DataFrame, path: str, template: Template | None = None) -> DataFrame:
    """One row per conversation of a written ``formatted`` table, from its ids and mask alone: see ``DIGEST``.

    ``turns_sha256`` is of role, line feed, text, line feed of each turn; ``loss_sha256`` of the text under the mask, unescaped.
    """
    template = template or template_for(path)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, conv, n = Coder(path, template), None, -1
        names = [c.split()[0] for c in DIGEST.split(", ")]
        out: list[tuple] = []

        def done() -> None:
            if n >= 0:
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for b in batches(parts, AT_ONCE):
            for k in range(b.num_rows):
                c = b.column(0)[k].as_py()
                ids = b.column(1)[k].values.to_numpy()
                mask = b.column(2)[k].values.to_numpy(zero_copy_only=False)
                if c != conv or n < 0:
                    done()
                    conv, n, chars, total = c, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                data = coder.decode(ids)
                rendered = data.decode()
                total += len(rendered)
                for role, text in template.parse(rendered):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                edges = np.concatenate([[0], np.cumsum(coder.lengths[ids])])
                step = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                for x, y in edges[step].reshape(-1, 2).tolist():
                    text = template.unescape(data[x:y].decode())
                    loss.update(text.encode())
                    chars += len(text)
            # the last conversation of a batch may go on in the next one
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if isinstance(x[0], str) else pa.int64()) for x in zip(*out)], names=names)
                out.clear()
        done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if isinstance(x[0], str) else pa.int64()) for x in zip(*out)], names=names)

    columns = ["conv_id", "ids", "loss"]
    alone = table.where("whole").select(*columns).mapInArrow(run, DIGEST)
    dealt = table.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return alone.unionByName(dealt.select(*columns).mapInArrow(run, DIGEST))


def format_chats(conversations: DataFrame, path: str, template: Template | None = None) -> DataFrame:
    """Formats, writes and reads back: the digests of ``read_back``."""
    return read_back(written(formatted(conversations, path, template), "chats"), path, template)


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: both sides say control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
