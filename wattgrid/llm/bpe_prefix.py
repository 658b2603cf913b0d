"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word exactly one token can be the last of its BPE encoding. It
is found among the tokens that end there (matches of a suffix automaton of the whole vocabulary,
its suffix links giving the shorter ones): a token fits if BPE would leave it and the last token of the
prefix before it apart. That pair test walks back through the merges that formed the
two tokens and needs no text. Back-pointers from the whole word give the exact ids.

Normal forms and words of anything beyond ASCII come from the tokenizer file's own components, as the
library runs them: Unicode versions of other libraries differ from its own.

The word-end mark belongs to the last symbol, so a word is a string over 512 symbols:
each byte, and each byte with the mark. Words are independent, so each distinct word is
solved once per worker and remembered in a table of bounded size.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, table, text_rows
from .tokens import LONG, PACKS, byte_letters, tokenizer_path

WORD_BPE = "word_bpe_49k.json"
WORDS = 700_000  # remembered words; a worker starts anew beyond that
SLICE = 1 << 16  # parts of a text handled at a time
END = 0x1000  # code point of byte 0 with the word-end mark


class SuffixAutomaton:
    """All substrings of a set of strings, built over their trie level by level.

    Every string of the set is the longest of its state, so a state names at most one of them.
    """

    def __init__(self, words: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.size = [-1], [0]
        trie: dict = {}
        for w, i in words.items():
            node = trie
            for c in w:
                node = node.setdefault(c, {})
            node[None] = i
        named: dict[int, int] = {}
        level = [(0, trie)]
        while level:
            below = []
            for state, node in level:
                for c, child in node.items():
                    if c is None:
                        named[state] = child
                    else:
                        below.append((self._extend(state, c), child))
            level = below
        # of each state the longest proper suffix that is a string of the set, and the chain of all that end with its longest string
        self.up: list[int] = [0] * len(self.next)
        self.ends: list[tuple | None] = [None] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.size.__getitem__):
            u = self.link[v]
            self.up[v] = u if u in named else self.up[u]
            self.ends[v] = (self.size[v], named[v], self.ends[u]) if v in named else self.ends[u]

    def _state(self, size: int, link: int, moves: dict[str, int]) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, c: str) -> int:
        """State of the string of ``last`` and then ``c``, which no state has yet."""
        moves, size, link = self.next, self.size, self.link
        new, p = self._state(size[last] + 1, 0, {}), last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if size[q] > size[p] + 1:
                copy = self._state(size[p] + 1, link[q], dict(moves[q]))
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        return new

    def places(self, s: str) -> Iterator[tuple | None]:
        """For each place of ``s`` the strings of the set that end there, longest first, as a chain of (length, number, rest)."""
        moves, size, link, ends, up = self.next, self.size, self.link, self.ends, self.up
        v = n = 0
        for c in s:
            move = moves[v].get(c)
            while move is None and v:
                v = link[v]
                n = size[v]
                move = moves[v].get(c)
            if move is not None:
                v, n = move, n + 1
            yield ends[v] if n == size[v] else ends[up[v]]

    def matches(self, s: str) -> Iterator[list[tuple[int, int]]]:
        """The same as lists of (length, number)."""
        for found in self.places(s):
            out = []
            while found:
                n, i, found = found
                out.append((n, i))
            yield out


class _Parts(dict):
    """Ids and decoded text of blank-separated parts and of words, learned when first asked for."""

    def __init__(self, learn: Callable[[str], tuple[bytes, str]]):
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> tuple[bytes, str]:
        got = self.learn(part)
        if len(part) <= LONG:
            self[part] = got
        return got


class Bpe:
    """Exact encoder and decoder of one byte-level BPE file."""

    def __init__(self, name: str = WORD_BPE, most: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        lib = Tokenizer.from_file(path)
        self.normalizer, self.splitter = lib.normalizer, lib.pre_tokenizer
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self._read_text_rules(spec)
        letters = byte_letters()
        self.latin = str.maketrans({c: chr(b) for c, b in letters.items()})

        def symbols(token: str) -> str | None:
            marked = bool(self.suffix) and token.endswith(self.suffix)
            body = token[:len(token) - len(self.suffix)] if marked else token
            if not body or any(c not in letters for c in body):
                return None
            s = "".join(chr(letters[c]) for c in body)
            return s[:-1] + chr(END + ord(s[-1])) if marked else s

        self.rank: dict[int, int] = {}  # merge that forms a token
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((i, j), r)
            if k not in self.rank:
                self.rank[k], self.left[k], self.right[k] = r, i, j
        self.known = {s: i for t, i in vocab.items() if (s := symbols(t)) is not None and (len(s) == 1 or i in self.rank)}
        self.automaton = SuffixAutomaton(self.known)
        self.apart: dict[int, bool] = {}
        self.most = most
        self.memo = _Parts(self._chunk)

    def _read_text_rules(self, spec: dict) -> None:
        """Checks that the file's rules are those known here; how they treat ASCII parts without blanks."""
        rules = spec.get("normalizer") or {}
        steps = rules.get("normalizers", [rules] if rules else [])
        for s in steps:
            # of these only lower case changes ASCII without blanks
            blanks = s["type"] == "Replace" and s["pattern"].get("Regex") == r"\s+"
            if not blanks and s["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase"):
                raise ValueError(f"normaliser {s['type']} is not supported")
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        pre = spec["pre_tokenizer"]
        parts = pre.get("pretokenizers", [pre])
        if parts[0]["type"] != "Split" or not parts[0]["invert"] or parts[-1]["type"] != "ByteLevel" or parts[-1].get("use_regex", True):
            raise ValueError("words must come from one inverted split pattern, as bytes")
        self.words = regex.compile(parts[0]["pattern"]["Regex"])
        if spec.get("decoder"):
            raise ValueError("this file's decoder is not supported")

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves token ``a`` followed by token ``b`` apart.

        Going back in time from the two whole tokens, the younger of the two at the
        boundary is undone; at each step a merge of the two that would have come
        before the next step of either joins them. In a tie the left merge comes first.
        """
        key = a << 20 | b
        known = self.apart.get(key)
        if known is not None:
            return known
        rank, x, y, until = self.rank, a, b, float("inf")
        while True:
            if self.merge.get((x, y), until) < until:
                ok = False
                break
            rx, ry = rank.get(x, -1), rank.get(y, -1)
            if rx < 0 and ry < 0:
                ok = True
                break
            if rx > ry:
                until, x = rx, self.right[x]
            else:
                until, y = ry + 1, self.left[y]
        if len(self.apart) > 2_000_000:
            self.apart = {}
        self.apart[key] = ok
        return ok

    def word(self, word: str) -> list[int]:
        """Ids of one word, given as a character per byte, by the last token of each of its prefixes."""
        s = word
        if self.suffix:
            s = s[:-1] + chr(END + ord(s[-1]))
        size, token = [0] * (len(s) + 1), [-1] * (len(s) + 1)  # last token of each prefix
        apart, compatible, found_at = self.apart, self.compatible, self.automaton
        moves, longest, link, ends, up = found_at.next, found_at.size, found_at.link, found_at.ends, found_at.up
        v = matched = at = 0
        for c in s:
            at += 1
            # the automaton's step, as in ``places``: a generator's switch per symbol cost more than the step
            move = moves[v].get(c)
            while move is None and v:
                v = link[v]
                matched = longest[v]
                move = moves[v].get(c)
            if move is not None:
                v, matched = move, matched + 1
            found = ends[v] if matched == longest[v] else ends[up[v]]
            while found:
                n, i, found = found
                before = token[at - n]
                if n == at or (before >= 0 and (apart[key] if (key := before << 20 | i) in apart else compatible(before, i))):
                    size[at], token[at] = n, i
                    break
        out, at = [], len(s)
        while at:
            if not size[at]:
                raise ValueError(f"no encoding of {word!r}")
            out.append(token[at])
            at -= size[at]
        return out[::-1]

    def slices(self, text: str) -> Iterator[list[tuple[bytes, str]]]:
        """Ids and decoded text of the text's blank-separated parts, in order, in lists of at most ``SLICE``."""
        if self.special and any(s in text for s in self.special):
            for part in re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text):
                if part in self.special:
                    yield [(np.array([self.special[part]], "<u4").tobytes(), part)]
                else:
                    yield from self.slices(part)
            return
        # blanks of str.split() that the pattern's \s lacks would part a word: leave those texts whole
        chunks = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else [text]
        for at in range(0, len(chunks), SLICE):
            if len(self.memo) > self.most:
                self.memo = _Parts(self._chunk)
            yield list(map(self.memo.__getitem__, chunks[at:at + SLICE] if len(chunks) > SLICE else chunks))

    def pieces(self, text: str) -> Iterator[tuple[bytes, str]]:
        """The parts of ``slices`` one by one."""
        for parts in self.slices(text):
            yield from parts

    def _words(self, part: str) -> list[str]:
        """The part's words, as a character per byte."""
        if part.isascii() and part.split() == [part]:
            return self.words.findall(part.lower() if self.lower else part)
        if self.normalizer is not None:
            part = self.normalizer.normalize_str(part)
        return [form.translate(self.latin) for form, _ in self.splitter.pre_tokenize_str(part)]

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """A part without blanks; its words are remembered too."""
        out = []
        for w in self._words(chunk):
            key = w if w.isascii() else (w,)  # an ASCII word as a part of its own has the same result
            got = self.memo.get(key)
            if got is None:
                i = self.word(w)
                ids = PACKS[len(i)](*i) if len(i) < len(PACKS) else np.array(i, "<u4").tobytes()
                got = ids, " ".join([self.names[x] for x in i])
                if len(w) <= LONG:
                    self.memo[key] = got
            out.append(got)
        if len(out) == 1:
            return out[0]
        return b"".join([i for i, _ in out]), " ".join([t for _, t in out])

    def encode(self, text: str) -> bytes:
        return b"".join([p[0] for p in self.pieces(text)])

    def decode(self, ids: bytes) -> str:
        """Token strings with blanks between them: this kind of file names no decoder."""
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def bpe(name: str = WORD_BPE) -> Bpe:
    """The worker process's encoder; what it remembers serves later tasks too."""
    return held(("bpe", name), lambda: Bpe(name))


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(name)
        for batch in batches:
            ids = [b.encode(t.as_py()) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(ids, pa.binary())], names=["_id", "ids"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = WORD_BPE) -> DataFrame:
    """``_id`` and ``ids`` (little-endian unsigned 32-bit) of every whole text; NULL text is empty."""
    rows = text_rows(docs, id_col, text_col).select("_id", "_text")
    return rows.mapInArrow(_encode(name), f"_id {docs.schema[id_col].dataType.simpleString()}, ids binary")


def _decode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(name)
        for batch in batches:
            text = [b.decode(x.as_py()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(text, pa.string())], names=["_id", "text"])
    return run


def decode(rows: DataFrame, name: str = WORD_BPE) -> DataFrame:
    """``_id`` and ``text`` of ``_id``, ``ids`` rows."""
    return rows.mapInArrow(_decode(name), f"_id {rows.schema['_id'].dataType.simpleString()}, text string")


def _digests(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(name)
        for batch in batches:
            counts, ids, texts = [], [], []
            for t in batch.column("_text"):
                h, d, n, sep = hashlib.sha256(), hashlib.sha256(), 0, ""
                for parts in b.slices(t.as_py()):
                    got = b"".join([i for i, _ in parts])
                    if not got:
                        continue
                    h.update(got)
                    d.update((sep + " ".join([s for i, s in parts if i])).encode())
                    n, sep = n + len(got) // 4, " "
                counts.append(n)
                ids.append(h.hexdigest())
                texts.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(texts)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def op5_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` encoded and decoded: token count and digests of ids and text."""
    rows = text_rows(table(spark, sf_dir, "documents"), "doc_id", "text").select("_id", "_text")
    return rows.mapInArrow(_digests(WORD_BPE), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
