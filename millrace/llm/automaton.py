"""A minimal acyclic automaton of words with number outputs, laid out in flat arrays that can be memory-mapped.

States with the same continuations are one state (shared suffixes). Each transition knows how many words
come before those it leads to, so a walk also yields the word's rank among all words, by which its output is
found. Transitions lie in one table by `base[state] + byte`; a slot names the state it belongs to.
"""

from __future__ import annotations

import io

import numpy as np

WIDTH = 2048
FIELDS = ("base", "check", "goto", "skip", "final", "starts", "ids")


def build(words: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the automaton that maps each non-empty word to its list of ids."""
    order = sorted(w for w in words if w)
    register: dict[tuple, int] = {}
    edges: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    path = [0]  # states along the last word, not yet shared

    def share(down_to: int, word: bytes) -> None:
        for k in range(len(word), down_to, -1):
            state = path[k]
            sign = (final[state], *sorted(edges[state].items()))
            same = register.setdefault(sign, state)
            if same != state:
                edges[path[k - 1]][word[k - 1]] = same
            path.pop()

    last = b""
    for w in order:
        same = 0
        while same < len(last) and last[same] == w[same]:
            same += 1
        share(same, last)
        for b in w[same:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][b] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = w
    share(0, last)

    # States that can be reached, in the order met; words below each.
    number: dict[int, int] = {0: 0}
    queue = [0]
    for s in queue:
        for t in edges[s].values():
            if t not in number:
                number[t] = len(number)
                queue.append(t)
    below: dict[int, int] = {}
    stack = [(0, False)]
    while stack:
        s, done = stack.pop()
        if done:
            below[s] = final[s] + sum(below[t] for t in edges[s].values())
        elif s not in below:
            stack.append((s, True))
            stack += [(t, False) for t in edges[s].values() if t not in below]

    base = np.zeros(len(number), np.int32)
    used = np.zeros(256 + 4 * sum(len(edges[s]) for s in number) + 256, bool)
    slots: list[tuple[int, int, int, int]] = []
    low = 0
    for s in sorted(number, key=lambda x: -len(edges[x])):
        own = np.fromiter(sorted(edges[s]), np.int64, len(edges[s]))
        if not len(own):
            continue
        while used[low]:
            low += 1
        at = max(0, low - int(own[0]))
        while True:  # the first free place among the next WIDTH
            if at + WIDTH + 256 >= len(used):
                used = np.concatenate([used, np.zeros(len(used) + WIDTH, bool)])
            clash = used[at + own[0] : at + own[0] + WIDTH].copy()
            for b in own[1:].tolist():
                clash |= used[at + b : at + b + WIDTH]
            k = int(clash.argmin())
            if not clash[k]:
                at += k
                break
            at += WIDTH
        used[at + own] = True
        base[number[s]] = at
        before = int(final[s])
        for b in own.tolist():
            t = edges[s][b]
            slots.append((at + b, number[s], number[t], before))
            before += below[t]
    size = int(base.max(initial=0)) + 256
    check, goto, skip = (np.full(size, v, np.int32) for v in (-1, 0, 0))
    for at, s, t, before in slots:
        check[at], goto[at], skip[at] = s, t, before
    lists = [words[w] for w in order]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    ids = np.array([i for x in lists for i in x], np.int32)
    is_final = np.zeros(len(number), np.int32)
    for s, k in number.items():
        is_final[k] = final[s]
    return dict(zip(FIELDS, (base, check, goto, skip, is_final, starts, ids), strict=True))


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A header of seven lengths, then the arrays, all of 4-byte numbers."""
    out = io.BytesIO()
    out.write(np.array([len(arrays[k]) for k in FIELDS], np.int32).tobytes())
    for k in FIELDS:
        out.write(np.ascontiguousarray(arrays[k], np.int32).tobytes())
    return out.getvalue()


class Automaton:
    """A built automaton in a memory-mapped file."""

    def __init__(self, file: str) -> None:
        flat = np.memmap(file, np.int32, mode="r")
        at = len(FIELDS)
        for name, n in zip(FIELDS, flat[:at].tolist(), strict=True):
            setattr(self, name, flat[at : at + n])
            at += n

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Each word's rank, -1 where the word is unknown. All words take a step at a time."""
        out = np.full(len(words), -1, np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        live = np.flatnonzero(size > 0)
        state, rank = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        k = 0
        while len(live):
            slot = self.base[state[live]] + flat[start[live] + k].astype(np.int64)
            ok = self.check[slot] == state[live]
            live, slot = live[ok], slot[ok]
            rank[live] += self.skip[slot]
            state[live] = self.goto[slot]
            k += 1
            ends = size[live] == k
            done = live[ends]
            done = done[self.final[state[done]] == 1]
            out[done] = rank[done]
            live = live[~ends]
        return out

    def output(self, rank: int) -> list[int]:
        return self.ids[self.starts[rank] : self.starts[rank + 1]].tolist()
