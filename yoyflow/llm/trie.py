"""A double-array trie over bytes, walked from many positions at once.

State ``s`` moves by byte ``b`` to ``t = base[s] + b + 1`` if ``check[t] == s``.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # no byte of UTF-8, so no key holds it
_WINDOW = 4096


class DoubleArrayTrie:
    """Keys are byte strings; a key's value is its place in ``keys``."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for v, key in enumerate(keys):
            node = 0
            for b in key:
                step = children[node].get(b + 1)
                if step is None:
                    step = children[node][b + 1] = len(children)
                    children.append({})
                    value.append(-1)
                node = step
            value[node] = v
        self.longest = max(map(len, keys), default=0)
        base = self._place(children)
        slot = np.zeros(len(children), np.int64)
        for node, to in enumerate(children):  # a child is always numbered after its parent
            for code, child in to.items():
                slot[child] = base[node] + code
        size = int(slot.max(initial=0)) + 258 + int(base.max(initial=0))
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.base[slot], self.value[slot] = base, value
        for node, to in enumerate(children):
            for child in to.values():
                self.check[slot[child]] = slot[node]

    @staticmethod
    def _place(children: list[dict[int, int]]) -> np.ndarray:
        """A base for every node so that no two children share a slot: the
        nodes with most children first, single children into the gaps."""
        base = np.zeros(len(children), np.int64)
        used = np.zeros(4 * len(children) + 4 * _WINDOW, bool)
        used[0] = True
        order = sorted((i for i, c in enumerate(children) if len(c) > 1), key=lambda i: -len(children[i]))
        start, width = 0, 0
        for node in order:
            codes = list(children[node])
            if len(codes) != width:
                start, width = 0, len(codes)
            while True:
                if start + _WINDOW + 258 > len(used):
                    used = np.concatenate([used, np.zeros(len(used), bool)])
                taken = used[start + codes[0] : start + codes[0] + _WINDOW].copy()
                for c in codes[1:]:
                    taken |= used[start + c : start + c + _WINDOW]
                if not taken.all():
                    start += int(taken.argmin())
                    break
                start += _WINDOW
            base[node] = start
            used[[start + c for c in codes]] = True
        single = [(i, *c) for i, c in enumerate(children) if len(c) == 1]
        gaps = np.flatnonzero(~used[257:]) + 257
        if len(gaps) < len(single):
            gaps = np.concatenate([gaps, len(used) + np.arange(len(single))])
        for (node, code), at in zip(single, gaps.tolist(), strict=False):
            base[node] = at - code
        return base

    def matches(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and value of every occurrence of every key in ``data``."""
        at, state = np.arange(len(data), dtype=np.int32), np.zeros(len(data), np.int32)
        found = []
        for k in range(self.longest):
            inside = at + k < len(data)
            at, state = at[inside], state[inside]
            to = self.base[state] + data[at + k] + 1
            ok = self.check[to] == state
            at, state = at[ok], to[ok]
            if not len(at):
                break
            v = self.value[state]
            hit = v >= 0
            found.append((at[hit], np.full(int(hit.sum()), k + 1, np.int32), v[hit]))
        if not found:
            return (np.zeros(0, np.int32),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
