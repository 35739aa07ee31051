"""Unigram segmentation over a vocabulary of pieces: best path, all paths, expected counts.

The lattice of a word has an edge for every occurrence of a piece in it
(found with the double-array trie) and, for a character that is no piece, an
edge that stands for its UTF-8 bytes (byte fallback).  Many words are handled
together: their lattices lie side by side in one byte array, and one step of
the recursion treats the same byte offset of all words.

Log scores: a vocabulary file of the BPE kind stores merge ranks, which are no
log probabilities.  ``scores="zipf"`` (default) gives the piece of rank r the
weight 1 / (r + 2.7), normalised over pieces and bytes; ``scores="file"`` takes
the stored numbers, as for a unigram file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

from yoyflow.llm.tokenizers import MARKER, sentence_piece
from yoyflow.llm.trie import SEPARATOR, DoubleArrayTrie

ZIPF_OFFSET = 2.7
UNKNOWN_PENALTY = 10.0  # below the lowest score of the file, as the library has it
_GROUP_BYTES = 128 << 10


@dataclass
class PieceModel:
    trie: DoubleArrayTrie
    ids: np.ndarray  # of the trie's values
    byte_ids: np.ndarray  # of the 256 bytes
    text: list[bytes]  # by id: what a piece decodes to, the marker as a space
    scores: np.ndarray  # natural log, by id
    unknown: float | None  # score of a character that is no piece; None: the sum of its bytes' scores
    key: str = field(default="")

    @classmethod
    def load(cls, path: str, scores: str = "zipf") -> PieceModel:
        file = sentence_piece(path)
        n = file.get_piece_size()
        names = [file.id_to_piece(i) for i in range(n)]
        is_byte = [file.is_byte(i) for i in range(n)]
        normal = [i for i in range(n) if not (is_byte[i] or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
        byte_ids = np.zeros(256, np.int64)
        for i in np.flatnonzero(is_byte).tolist():
            byte_ids[int(names[i][1:-1], 16)] = i
        stored = np.array([file.get_score(i) for i in range(n)])
        if scores == "zipf":
            ranked = sorted(normal, key=lambda i: (-stored[i], i))
            weight = np.zeros(n)
            weight[ranked] = 1 / (np.arange(len(ranked)) + ZIPF_OFFSET)
            weight[byte_ids] = 1 / (len(ranked) + ZIPF_OFFSET)
            with np.errstate(divide="ignore"):
                log, unknown = np.log(weight / weight.sum()), None
        else:
            log, unknown = stored, float(stored[normal].min()) - UNKNOWN_PENALTY
        text = [b""] * n  # of control pieces
        for i in normal:
            text[i] = names[i].replace(MARKER, " ").encode()
        for b, i in enumerate(byte_ids.tolist()):
            text[i] = bytes([b])
        trie = DoubleArrayTrie([names[i].encode() for i in normal])
        return cls(trie, np.array(normal), byte_ids, text, log, unknown, f"{path}:{scores}")


@dataclass
class Lattice:
    """Edges of all words, ordered by offset of their end in the word, end and start."""

    data: np.ndarray
    first: np.ndarray  # place of each word's first byte
    last: np.ndarray  # place after each word's last byte
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray  # id, or -1: a character given by its bytes
    weight: np.ndarray
    by_end: list[tuple[int, int]]  # edges of one offset of the end


def groups(words: list[str]) -> Iterator[list[str]]:
    """Runs of words of about ``_GROUP_BYTES``; one longer word is a group."""
    group, size = [], 0
    for w in words:
        if group and size + len(w) > _GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(w)
        size += len(w) + 4
    if group:
        yield group


def lattice(model: PieceModel, words: list[str]) -> Lattice:
    raw = [(MARKER + w.replace(" ", MARKER)).encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) for r in raw], np.int64)
    last = np.cumsum(sizes + 1) - 1
    first = last - sizes
    data = np.frombuffer(bytes([SEPARATOR]).join(raw) + bytes([SEPARATOR]), np.uint8)
    start, length, value = model.trie.matches(data)
    piece = model.ids[value]
    weight = model.scores[piece]
    lead = ((data & 0xC0) != 0x80) & (data != SEPARATOR)
    wide = np.ones(len(data), np.int32)
    wide[data >= 0xC0], wide[data >= 0xE0], wide[data >= 0xF0] = 2, 3, 4
    lead[start[length == wide[start]]] = False
    other = np.flatnonzero(lead).astype(np.int32)
    if len(other):
        if model.unknown is None:
            total = np.concatenate([[0], np.cumsum(np.where(data == SEPARATOR, 0, model.scores[model.byte_ids[data]]))])
            fallback = total[other + wide[other]] - total[other]
        else:
            fallback = np.full(len(other), model.unknown)
        start, length = np.concatenate([start, other]), np.concatenate([length, wide[other]])
        piece, weight = np.concatenate([piece, np.full(len(other), -1)]), np.concatenate([weight, fallback])
    end = start + length
    word_start = np.repeat(first, sizes + 1)
    offset = end - word_start[start]
    order = np.lexsort((start, end, offset))
    start, end, piece, weight, offset = start[order], end[order], piece[order], weight[order], offset[order]
    cut = np.flatnonzero(np.diff(offset)) + 1
    bounds = [0, *cut.tolist(), len(offset)]
    by_end = [(a, b) for a, b in zip(bounds, bounds[1:], strict=False) if a < b]
    return Lattice(data, first, last, start, end, piece, weight, by_end)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def best_paths(model: PieceModel, words: list[str]) -> list[tuple[bytes, float]]:
    """Viterbi: little-endian int32 ids and log score of every word's best path.

    Of equally good paths the one whose last differing piece is longer wins.
    """
    out: list[tuple[bytes, float]] = []
    for group in groups(words):
        x = lattice(model, group)
        best = np.full(len(x.data) + 1, -np.inf)
        best[x.first] = 0
        via = np.full(len(x.data) + 1, -1)
        for a, b in x.by_end:
            score = best[x.start[a:b]] + x.weight[a:b]
            runs = _runs(x.end[a:b])
            top = np.maximum.reduceat(score, runs)
            lengths = np.diff(np.append(runs, b - a))
            winner = np.flatnonzero(score == np.repeat(top, lengths))
            ends = x.end[a:b][winner]
            winner = winner[_runs(ends)]
            ends = x.end[a:b][winner]
            best[ends], via[ends] = score[winner], winner + a
        taken, at = [], x.last
        while len(at):
            edge = via[at]
            taken.append(edge)
            at = x.start[edge]
            at = at[via[at] >= 0]
        taken = np.sort(x.start[used := np.concatenate(taken)] * np.int64(1 << 32) + used) & 0xFFFFFFFF
        place, ids = x.start[taken], x.piece[taken]
        if (ids < 0).any():
            wide = np.where(ids < 0, x.end[taken] - place, 1)
            nth = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
            place, known = np.repeat(place, wide), np.repeat(ids, wide)
            ids = np.where(known < 0, model.byte_ids[x.data[place + nth]], known)
        flat = ids.astype("<i4").tobytes()
        cuts = np.searchsorted(place, x.last).tolist()
        out += [(flat[4 * a : 4 * b], s) for a, b, s in zip([0, *cuts], cuts, best[x.last].tolist(), strict=False)]
    return out


def _forward(x: Lattice) -> np.ndarray:
    """Log of the summed probability of all paths from a word's begin to each place."""
    total = np.full(len(x.data) + 1, -np.inf)
    total[x.first] = 0
    for a, b in x.by_end:
        score = total[x.start[a:b]] + x.weight[a:b]
        runs = _runs(x.end[a:b])
        top = np.maximum.reduceat(score, runs)
        lengths = np.diff(np.append(runs, b - a))
        total[x.end[a:b][runs]] = top + np.log(np.add.reduceat(np.exp(score - np.repeat(top, lengths)), runs))
    return total


def marginals(model: PieceModel, words: list[str]) -> list[float]:
    """Natural log of the probability of each word, summed over all its segmentations."""
    out: list[float] = []
    for group in groups(words):
        x = lattice(model, group)
        out += _forward(x)[x.last].tolist()
    return out


def expected_counts(model: PieceModel, words: list[str], times: np.ndarray) -> np.ndarray:
    """How often each id occurs over all segmentations of the words, weighted by
    probability and by ``times``; a fallback character counts for its bytes."""
    counts = np.zeros(len(model.scores))
    done = 0
    for group in groups(words):
        x = lattice(model, group)
        ahead = _forward(x)
        behind = np.full(len(x.data) + 1, -np.inf)
        behind[x.last] = 0
        word_end = np.repeat(x.last, x.last - x.first + 1)
        left = word_end[x.start] - x.start
        order = np.lexsort((x.start, left))
        start, end, weight = x.start[order], x.end[order], x.weight[order]
        bounds = [*_runs(left[order]).tolist(), len(order)] if len(order) else []
        for a, b in zip(bounds, bounds[1:], strict=False):
            score = behind[end[a:b]] + weight[a:b]
            runs = _runs(start[a:b])
            top = np.maximum.reduceat(score, runs)
            lengths = np.diff(np.append(runs, b - a))
            behind[start[a:b][runs]] = top + np.log(np.add.reduceat(np.exp(score - np.repeat(top, lengths)), runs))
        which = np.repeat(np.arange(len(group)), x.last - x.first + 1)[x.start]
        share = np.exp(ahead[x.start] + x.weight + behind[x.end] - ahead[x.last][which]) * times[done : done + len(group)][which]
        known = x.piece >= 0
        counts += np.bincount(x.piece[known], share[known], len(counts))
        for s, e, p in zip(x.start[~known].tolist(), x.end[~known].tolist(), share[~known].tolist(), strict=True):
            np.add.at(counts, model.byte_ids[x.data[s:e]], p)
        done += len(group)
    return counts
