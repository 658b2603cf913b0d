"""Exact token ids of byte-level BPE files, fast enough for whole corpora.

The tokenizers library does all encoding. Byte-level BPE treats each pre-token by
itself, and a blank between two visible characters, or a single line break between
them, always starts one. So a text is cut there, each distinct word is encoded once and
its ids are remembered in a table of bounded size. Texts with any other spacing, or
with a special token's string in them, are encoded whole.
"""
from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from .common import held

BYTE_BPE = "byte_bpe_50k.json"
WORDS = 300_000  # words in a generation of a worker's memory
LONG = 200  # longer words are not remembered
SLICE = 1 << 22  # characters handled at a time
_CUT = re.compile(r"(?<=\S) (?=\S)")
PACKS = [struct.Struct(f"<{n}I").pack for n in range(64)]
STOPS = ".,;:!?"  # one of these after a letter is a pre-token of its own


def tokenizer_path(name: str) -> str:
    """The file itself if ``name`` is a path, else the public tokenizer of that name."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies use for each byte, by rule:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Spaced(Exception):
    """A word with blanks at an end: its text has other spacing than single blanks."""


class _Words(dict):
    """Ids of words, learned when first asked for. Two generations: words not asked for
    while ``most`` others were are forgotten."""

    def __init__(self, learn, most: int, old: dict | None = None):
        super().__init__()
        self.learn, self.most, self.old = learn, most, old or {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= LONG:
            self[word] = ids
        return ids


class Encoder:
    """``ids(text)``: what the library's ``encode(text, add_special_tokens=False).ids`` gives,
    as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, name: str = BYTE_BPE, most: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        path = tokenizer_path(name)
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and not spec.get("normalizer") and not spec.get("post_processor"))
        self.tokenize, self.pre = self.lib.model.tokenize, self.lib.pre_tokenizer
        self.bytes = str.maketrans({chr(b): c for c, b in byte_letters().items()})
        self.blank = " ".translate(self.bytes)
        self.line = self.whole("\n")
        self.stops = {c: self.whole(c) for c in STOPS}
        self.memo = _Words(self._learn, most)

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ids(self, form: str) -> bytes:
        """Ids of one pre-token, given in byte letters."""
        ids = [t.id for t in self.tokenize(form)]
        return PACKS[len(ids)](*ids) if len(ids) < len(PACKS) else struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, word: str) -> bytes:
        """Ids of a word after a blank, or with its leading line break."""
        if word.isalpha():  # letters after a blank are one pre-token
            return self._ids(self.blank + word if word.isascii() else (" " + word).encode().decode("latin-1").translate(self.bytes))
        core = word[1:] if word[:1] == "\n" else word
        if not core or core[0].isspace() or core[-1].isspace():
            raise _Spaced
        if core[-1] in self.stops and core[-2:-1].isalpha():
            return self.memo[word[:-1]] + self.stops[core[-1]]
        text = core if core is not word else " " + word
        if core.isalpha() and core.isascii():
            ids = self._ids(core)
        else:
            ids = b"".join([self._ids(form) for form, _ in self.pre.pre_tokenize_str(text)])
        return self.line + ids if core is not word else ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_word or any(s in text for s in self.special):
            return self.whole(text)
        if len(self.memo) > self.memo.most:
            self.memo = _Words(self._learn, self.memo.most, self.memo)
            self.memo.old.old = {}
        out, start, lead = [], 0, "\n"
        while start < len(text):
            cut = _CUT.search(text, start + SLICE) if len(text) - start > SLICE else None
            end = cut.start() if cut else len(text)
            words = (lead + text[start:end]).replace("\n", " \n").split(" ")
            if lead:
                del words[0]  # the empty word before the leading line break
            try:
                part = b"".join(map(self.memo.__getitem__, words))
            except _Spaced:
                return self.whole(text)
            out.append(part[len(self.line):] if lead else part)
            start, lead = end + 1, ""
        return b"".join(out)


def encoder(name: str = BYTE_BPE) -> Encoder:
    """The worker process's encoder; what it remembers serves later tasks too."""
    return held(("tokens", name), lambda: Encoder(name))
