"""Token ids of whole texts, each distinct word encoded once per worker.

Both libraries' results are the concatenation of what they give for the
pieces of a text, if it is cut where no token can reach across:

* byte-level BPE splits before a space that a non-space follows, so ``a bc``
  is ``a`` and `` bc`` (special strings hold no space, so none is cut), and,
  where its file splits as GPT-2's, around a line feed between two non-spaces
  and between a letter and a mark after it;
* a SentencePiece model none of whose pieces has the whitespace marker after
  another character never merges across "non-space, space"; with the marker
  put before every text, ``a bc`` is ``a`` and ``bc``.

A text with the marker character itself is not cut.  ``tests/llm`` holds both
against the libraries on whole texts.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable
from functools import cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKER = "▁"
_SPACED = re.compile(r" +[^ ]+(?: +\Z)?| +\Z")
_MARKS = ".,;:!?"
_PLAIN = re.compile(r" ?\S+")
_WHITE, _LETTER, _MARK = (np.isin(np.arange(256), list(chars)) for chars in (b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f", bytes(range(65, 91)) + bytes(range(97, 123)), _MARKS.encode()))


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether no whitespace stands at ``at``, where characters of the UTF-8 ``data`` begin
    (two more bytes must follow the last)."""
    first = data[at]
    solid = ~_WHITE[first]
    wide = np.flatnonzero(first >= 0xC2)
    a, b, c = first[wide], data[at[wide] + 1], data[at[wide] + 2]
    solid[wide] = ~(
        (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        | (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        | (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    )
    return solid


def byte_level_bounds(raw: np.ndarray, starts: np.ndarray, fine: bool) -> np.ndarray:
    """Where the pieces of texts begin, and the end: ``raw`` holds the texts' UTF-8, one
    after another, ``starts`` their n + 1 bounds.  A piece keeps the space before it;
    the ids of a text's pieces, joined, are the ids of the text."""
    n = len(raw)
    data = np.concatenate([raw, np.zeros(3, np.uint8)])
    cut = np.zeros(n + 1, bool)
    cut[starts] = True
    space = np.flatnonzero(raw == 0x20)
    space = space[~cut[space + 1]]  # no space at the end of a text
    found = [space[_solid(data, space + 1)]]
    if fine:
        feed = np.flatnonzero(raw == 0x0A)
        before = data[feed - 1]
        feed = feed[~cut[feed + 1] & (before < 0x80) & ~_WHITE[before]]
        feed = feed[_solid(data, feed + 1)]
        found += [feed, feed + 1, 1 + np.flatnonzero(_MARK[raw[1:]] & _LETTER[raw[:-1]])]
    for at in found:
        cut[at] = True
    return np.flatnonzero(cut)


def piece_chunks(text: str) -> list[str]:
    """Pieces of ``text`` whose SentencePiece ids, joined, are the ids of ``text``."""
    if MARKER in text:
        return [text]
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return [c[1:] for c in _SPACED.findall(" " + text)]


@cache
def byte_level(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def sentence_piece(path: str):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    inside = [p for i in range(model.get_piece_size()) if MARKER in (p := model.id_to_piece(i)).lstrip(MARKER)]
    if inside:
        raise ValueError(f"pieces with the whitespace marker inside: {inside[:3]}")
    return model


def digest(path: str) -> str:
    """Names a tokenizer version: the SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def byte_level_alphabet() -> dict[int, str]:
    """The character that stands for each byte: printable ones of Latin-1 for
    themselves, the others in order from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _splits_words(tokenizer) -> bool:
    """Whether letters after a space or none, line feeds between non-spaces, and marks after
    letters are always pieces of their own (byte-level splitting, no normaliser, no special
    string that holds or crosses one)."""
    file = json.loads(tokenizer.to_str())
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    special = file["added_tokens"]
    return (
        file["normalizer"] is None
        and (file["pre_tokenizer"] or {}).items() >= plain.items()
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special)
        and not any(t["content"].isalpha() or re.search(rf"\s|[A-Za-z][{_MARKS}]", t["content"]) for t in special)
    )


class CodeTable:
    """A worker's codes by word, in two Arrow arrays of at most ``most`` bytes between
    calls: no Python object is kept, or looked up, for a word.

    When it is full, words that a later call asked for again stay, or those of the
    last call, where the former fill more than half of it.  A call reads the whole
    table once, so it should bring many words.
    """

    def __init__(self, compute: Callable[[pa.StringArray], pa.BinaryArray], most: int = 32 << 20):
        self._compute, self._most = compute, most
        self._words, self._codes = pa.array([], pa.string()), pa.array([], pa.binary())
        self._again = np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self._words)

    @property
    def nbytes(self) -> int:
        return self._words.nbytes + self._codes.nbytes

    def lookup(self, words: pa.StringArray) -> pa.BinaryArray:
        """The codes of words, none of them null."""
        at = pc.fill_null(pc.index_in(words, value_set=self._words), -1).to_numpy().copy()
        self._again[at[at >= 0]] = True
        holes = np.flatnonzero(at < 0)
        if len(holes):
            new = words.take(pa.array(holes)).dictionary_encode()
            at[holes] = new.indices.to_numpy() + len(self)
            self._codes = pa.concat_arrays([self._codes, self._compute(new.dictionary)])
            self._words = pa.concat_arrays([self._words, new.dictionary])
            self._again = np.concatenate([self._again, np.zeros(len(new.dictionary), bool)])
        codes = self._codes.take(pa.array(at))
        if self.nbytes > self._most:
            self._shrink(at)
        return codes

    def _shrink(self, at: np.ndarray) -> None:
        words, codes, none = self._words, self._codes, np.zeros(len(self), bool)
        last = none.copy()
        last[at] = True
        for stay, most in ((self._again, self._most // 2), (last, self._most), (none, self._most)):
            self._words, self._codes = words.filter(pa.array(stay)), codes.filter(pa.array(stay))
            if self.nbytes <= most:
                break
        self._again = np.zeros(len(self), bool)


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Runs of ``sizes`` integers each, as bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


class ByteLevelCoder:
    """Ids of whole texts as little-endian integers, each distinct word encoded about once."""

    def __init__(self, path: str, dtype: str):
        self._tokenizer, self._dtype = byte_level(path), dtype
        line = self._tokenizer.encode("\n", add_special_tokens=False).ids
        self._line = line[0] if len(line) == 1 else None
        self._fine = _splits_words(self._tokenizer)
        self._shown = "".join(c for _, c in sorted(byte_level_alphabet().items()))
        self._known = CodeTable(lambda words: self._encode(words))

    def _each(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self._dtype) for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _of_letters(self, words: pa.StringArray) -> pa.BinaryArray:
        """Words of letters, straight by the library's model: each is one piece."""
        model = self._tokenizer.model
        flat, sizes = [np.zeros(0, self._dtype)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), 5000):
            part = words.slice(i, 5000)
            lines = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], part), "\n")[0].as_py()
            shown = codecs.charmap_decode(lines.encode(), "strict", self._shown)[0].split(self._shown[0x0A])
            tokens = list(map(model.tokenize, shown))
            sizes.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            flat.append(np.fromiter(map(attrgetter("id"), chain.from_iterable(tokens)), self._dtype, sizes[-1].sum()))
        return _binary(np.concatenate(flat), np.concatenate(sizes))

    def _of_lines(self, words: list[str]) -> pa.BinaryArray:
        """Words without inner whitespace are encoded as lines of one text: a line feed
        between them is a token of its own, and no such word holds one."""
        plain = [i for i, w in enumerate(words) if self._line is not None and self._fine and _PLAIN.fullmatch(w)]
        rest = sorted(set(range(len(words))).difference(plain))
        order, flat, sizes = [], [np.zeros(0, self._dtype)], [np.zeros(0, np.int64)]
        parts = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        for part, found in zip(parts, self._each(["\n".join([words[i] for i in p]) for p in parts]), strict=True):
            cut = np.flatnonzero(found == self._line)
            if len(cut) != len(part) - 1:
                rest += part
                continue
            order += part
            flat.append(found[found != self._line])
            sizes.append(np.diff(cut, prepend=-1, append=len(found)) - 1)
        found = self._each([words[i] for i in rest])
        sizes.append(np.array([len(f) for f in found], np.int64))
        return _binary(np.concatenate([*flat, *found]), np.concatenate(sizes)).take(pa.array(np.argsort(order + rest), pa.int64()))

    def _encode(self, words: pa.StringArray) -> pa.BinaryArray:
        letters = np.zeros(len(words), bool)
        if self._fine:
            letters = pc.match_substring_regex(words, r"^ ?\pL+$").to_numpy(zero_copy_only=False)
        found = [self._of_letters(words.filter(pa.array(letters))), self._of_lines(words.filter(pa.array(~letters)).to_pylist())]
        order = np.argsort(np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)]))
        return pa.concat_arrays(found).take(pa.array(order))

    def encode(self, texts: pa.StringArray) -> pa.BinaryArray:
        """The ids of texts, none of them null."""
        texts = texts.cast(pa.string())
        if not pc.sum(pc.binary_length(texts)).as_py():
            return pa.array([b""] * len(texts), pa.binary())
        _, at, data = texts.buffers()
        starts = np.frombuffer(at, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = data.slice(int(starts[0]), int(starts[-1] - starts[0]))
        starts = starts - starts[0]
        bounds = byte_level_bounds(np.frombuffer(data, np.uint8), starts, self._fine)
        pieces = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), data])
        codes = self._known.lookup(pieces)
        ends = np.frombuffer(codes.buffers()[1], np.int32)[np.searchsorted(bounds, starts)]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), codes.buffers()[2] or pa.py_buffer(b"")])

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.encode(pa.array(texts, pa.string())).to_pylist()
