"""A minimal acyclic transducer: sorted terms in, their lexicographic ordinals out."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

WIDE = 256  # one more than the largest byte


class Transducer:
    """Ordinals (0, 1, ...) of a sorted list of different byte strings.

    States with the same future are one state: while terms come in order, the states behind the last
    common prefix are compared with those already registered. An arc puts out the number of terms that
    come before those below it, so that the outputs along a term add up to its ordinal.
    """

    def __init__(self, terms: Iterable[bytes]):
        self._arcs: list[list[tuple[int, int]]] = [[]]  # by state: byte and state, in order of bytes
        self._final = [False]
        self._registered: dict[tuple, int] = {}
        path, last = [0], b""  # states along the last term
        size = 0
        for term in terms:
            if size and term <= last:
                raise ValueError("terms must be sorted and different")
            shared = 0
            while shared < min(len(term), len(last)) and term[shared] == last[shared]:
                shared += 1
            self._minimise(path, last, shared)
            for byte in term[shared:]:
                self._arcs.append([])
                self._final.append(False)
                self._arcs[path[-1]].append((byte, len(self._arcs) - 1))
                path.append(len(self._arcs) - 1)
            self._final[path[-1]] = True
            last = term
            size += 1
        self._minimise(path, last, 0)
        self.size = size
        self._compile()

    def _minimise(self, path: list[int], last: bytes, keep: int) -> None:
        while len(path) > keep + 1:
            state = path.pop()
            form = (self._final[state], tuple(self._arcs[state]))
            same = self._registered.setdefault(form, state)
            if same != state:
                byte, _ = self._arcs[path[-1]][-1]
                self._arcs[path[-1]][-1] = (byte, same)

    def _compile(self) -> None:
        """Arcs of the reachable states as sorted arrays: state and byte, target, output."""
        below: dict[int, int] = {}
        stack = [0]
        while stack:  # number of terms below each state, without recursion
            state = stack[-1]
            open_targets = [t for _, t in self._arcs[state] if t not in below]
            if open_targets:
                stack.extend(open_targets)
                continue
            stack.pop()
            below[state] = int(self._final[state]) + sum(below[t] for _, t in self._arcs[state])
        number = {state: k for k, state in enumerate(sorted(below))}
        rows = []
        for state, k in number.items():
            before = int(self._final[state])
            for byte, target in self._arcs[state]:
                rows.append((k * WIDE + byte, number[target], before))
                before += below[target]
        table = np.array(rows, np.int64).reshape(-1, 3)
        self.keys, self.targets, self.outputs = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        self.final = np.array([self._final[s] for s in number], bool)
        del self._arcs, self._final, self._registered

    @property
    def states(self) -> int:
        return len(self.final)

    def ordinals(self, terms: pa.Array) -> np.ndarray:
        """Ordinal of each term of a binary array, or -1; all terms take their next arc together."""
        offsets = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
        data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
        state, total = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at, end = offsets[:-1].copy(), offsets[1:]
        live = np.flatnonzero(at < end)
        while len(live) and len(self.keys):
            wanted = state[live] * WIDE + data[at[live]]
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[place] == wanted
            state[live[~hit]] = -1
            live, place = live[hit], place[hit]
            state[live] = self.targets[place]
            total[live] += self.outputs[place]
            at[live] += 1
            live = live[at[live] < end[live]]
        if len(live):
            state[live] = -1
        found = state >= 0
        found[found] = self.final[state[found]]
        return np.where(found, total, -1)
