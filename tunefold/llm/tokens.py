"""Tokenization of whole texts inside a Python worker, piece by piece and cached.

A public tokenizer file (path given by the caller) is applied through the
``tokenizers`` library. Both kinds of file used here cut a text into pieces
before any merge, and a merge never crosses a piece; so the ids of a text are
the ids of its pieces in order, and pieces repeat. ``PieceEncoder`` cuts before
white space, commas and full stops, keeps the ids of the pieces it has met in a
bounded dictionary, and hands new words to the library many at a time. Texts in
which such a cut could change the library's own (other white space, runs of
signs or spaces, strings that look like special tokens) are cut with a slower
pattern or go to the library whole. ``tests/llm/test_tokens_packing_files.py`` holds the
results against the library.

The encoder stays in the worker between tasks, so its dictionary fills once.
"""

from __future__ import annotations

import array
import json
import re
import sys

import numpy as np

#: Entries after which the dictionary starts anew (about 200 MB).
MAX_PIECES = 1_000_000

# Without U+0130: its lower case ends in a combining mark, which belongs to the signs after it.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: letters up to a safe end | ASCII signs up to white space | anything else up to white space
_PIECE = re.compile(
    rf"[ \n]*[{_LETTERS}]+(?=[ \n!-&(-@\[-`{{-~]|\Z)|[!-&(-/:-@\[-`{{-~]+(?=[ \n]|\Z)|[ \n]*[^ \n]+|[ \n]+"
)
#: The library must see such a text whole.
_UNSAFE = re.compile(r"[^\S \n]|[\x01\x1c-\x1f\x85\u200b\ufeff]")
#: Only the pattern cuts these right.
_RUNS = ("  ", "\n\n", " \n", "\n ")
#: A comma or full stop that may belong to the piece before it.
_NO_CUT = re.compile(rf"[,.](?<![0-9{_LETTERS}][,.])")


def _bytes(ids) -> bytes:
    a = array.array("I", ids)
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


class PieceEncoder:
    """Ids of whole texts, through a dictionary of pieces that lives as long as the worker.

    ``plain``: strings of special tokens inside texts are ordinary text. ``most``: entries of the dictionary.
    """

    def __init__(self, path: str, plain: bool = False, most: int = MAX_PIECES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.most = most
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        # A file that drops white space gives a piece the same ids with and without a leading space.
        self.spaces_matter = (kind.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.pieces: dict[str, bytes] = {"": b""}

    def whole(self, text: str) -> bytes:
        """The library's own ids of a text, without cuts."""
        return _bytes(self.tok.encode(text, add_special_tokens=False).ids)

    def _words(self, words: list[str], spaced: bool) -> None:
        """Ids of words of letters only (``spaced``: each after one space), in one call of the library."""
        text = " " + " ".join(words) if spaced else "\n".join(words)
        e = self.tok.encode(text, add_special_tokens=False)
        ids, of = np.array(e.ids, "<u4"), np.array(e.word_ids)
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        cut = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)])]
        if not spaced and self.spaces_matter:
            cut = cut[::2]  # every other piece is a separator
        keys = [" " + w for w in words] if spaced else words
        if len(cut) != len(words):
            cut = [self.whole(k) for k in keys]
        self.pieces.update(zip(keys, cut))

    def _add(self, new: list[str]) -> None:
        """Puts the ids of new pieces into the dictionary."""
        spaced, bare, broken, rest = [], [], [], []
        for w in new:
            if w[0] == " " and w[1:].isalpha():
                spaced.append(w[1:])
            elif w.isalpha():
                bare.append(w)
            elif w[0] == "\n" and w[1:].isalpha():
                broken.append(w[1:])
            else:
                rest.append(w)
        bare += [w for w in dict.fromkeys(broken) if w not in self.pieces]
        for words, s in ((spaced, True), (list(dict.fromkeys(bare)), False)):
            if words:
                self._words(words, s)
        line = self.whole("\n")
        for w in broken:
            self.pieces["\n" + w] = line + self.pieces[w]
        for w in rest:
            cut = _PIECE.findall(w)
            if len(cut) == 1:
                self.pieces[w] = self.whole(w)
            else:
                if lacking := [x for x in dict.fromkeys(cut) if x not in self.pieces]:
                    self._add(lacking)
                self.pieces[w] = b"".join([self.pieces[x] for x in cut])

    def _cut(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if the library must see it whole."""
        if not text.replace("\n", "").isprintable() and _UNSAFE.search(text) or "<|" in text:
            return None
        if any(x in text for x in _RUNS):
            return _PIECE.findall(text)
        marked = text.replace(" ", "\x01 ").replace("\n", "\x01\n")
        if not _NO_CUT.search(text):
            marked = marked.replace(",", "\x01,").replace(".", "\x01.")
        return marked.split("\x01")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; texts of a call share one look at new words."""
        if len(self.pieces) > self.most:
            self.pieces.clear()
            self.pieces[""] = b""
        get, out, again, new = self.pieces.get, [], [], set()
        for k, text in enumerate(texts):
            parts = self._cut(text) if text else []
            if parts is None:
                out.append(self.whole(text))
                continue
            got = list(map(get, parts))
            if None in got:
                at = [j for j, g in enumerate(got) if g is None]
                lacking = [parts[j] for j in at]
                new.update(lacking)
                again.append((k, got, at, lacking))
                out.append(b"")
            else:
                out.append(b"".join(got))
        if new:
            self._add(list(new))
            for k, got, at, lacking in again:
                for j, p in zip(at, lacking):
                    got[j] = self.pieces[p]
                out[k] = b"".join(got)
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
