"""Double-array tries over byte strings, built and walked with array operations.

State s goes to t = base[s] + byte if check[t] = s. A key ends by the byte ``END``, whose state's base is the
key's number. Keys must not hold ``END`` themselves.
"""

from __future__ import annotations

import numpy as np

END = 0x0A
SPACE = 0x20
FEW = 8  # children; states with more are placed one by one


class DoubleArray:
    def __init__(self, keys: list[bytes], seed: int = 0) -> None:
        """``keys``: distinct and in ascending byte order."""
        self.size = len(keys)
        parent, symbol, key = _tree(keys)
        self._place(parent, symbol, key, np.random.default_rng(seed))

    def _place(self, parent: np.ndarray, symbol: np.ndarray, key: np.ndarray, rng: np.random.Generator) -> None:
        """Give every inner node a base at which all its children's slots are free."""
        nodes = len(parent)
        children = np.bincount(parent[1:], minlength=nodes)
        first = np.searchsorted(parent[1:], np.arange(nodes)) + 1  # children of a node are neighbours
        base, used, room = np.zeros(nodes, dtype=np.int64), np.zeros(0, dtype=bool), 0

        def grow(to: int) -> None:
            nonlocal used, room
            used, room = np.concatenate([used, np.zeros(to + 256 - len(used), dtype=bool)]), to

        grow(256 + nodes + nodes // 3 + 256)
        order = np.argsort(-children, kind="stable")
        for node in order[:int((children > FEW).sum())]:
            mine = symbol[first[node]:first[node] + children[node]]
            for trial in range(1, 10**6):
                at = rng.integers(1, room, size=16)
                fit = np.flatnonzero(~used[at[:, None] + mine].any(axis=1))
                if len(fit):
                    break
                if trial % 64 == 0:
                    grow(room + room // 4)
            base[node] = at[fit[0]]
            used[base[node] + mine] = True
        owner = np.zeros(len(used), dtype=np.int64)
        for m in range(FEW, 1, -1):
            left, trial = np.flatnonzero(children == m), 0
            while len(left):
                trial += 1
                if trial % 32 == 0:
                    grow(room + room // 4)
                if len(owner) < len(used):
                    owner = np.zeros(len(used), dtype=np.int64)
                at = rng.integers(1, room, size=len(left))
                slots = at[:, None] + symbol[first[left][:, None] + np.arange(m)]
                owner[slots] = np.arange(len(left))[:, None]
                # of nodes that want one slot, the last one owns it
                won = ~used[slots].any(axis=1) & (owner[slots] == np.arange(len(left))[:, None]).all(axis=1)
                base[left[won]] = at[won]
                used[slots[won]] = True
                left = left[~won]
        single = np.flatnonzero(children == 1)
        free = np.flatnonzero(~used[256:room]) + 256
        if len(free) < len(single):
            grow(room + len(single))
            free = np.flatnonzero(~used[256:room]) + 256
        base[single] = free[:len(single)] - symbol[first[single]]

        slot = np.zeros(nodes, dtype=np.int64)
        slot[1:] = base[parent[1:]] + symbol[1:]
        self.base = np.zeros(room + 256, dtype=np.int32)
        self.check = np.full(room + 256, -1, dtype=np.int32)
        self.base[slot] = np.where(key >= 0, key, base)
        self.check[slot[1:]] = slot[parent[1:]]

    def state(self, prefix: bytes) -> int:
        """The state after ``prefix``, or -1."""
        s = 0
        for byte in prefix:
            t = int(self.base[s]) + byte
            if self.check[t] != s:
                return -1
            s = t
        return s

    def accepted(self, text: np.ndarray, at: np.ndarray, state: int) -> np.ndarray:
        """Numbers of all keys found from the positions ``at`` on, in words of ``text`` joined by one space.

        All positions take their next byte together. ``text`` ends pieces with ``END``, the last one too.
        """
        states, out = np.full(len(at), state, dtype=np.int32), []
        while len(at):
            byte = text[at]
            ends = np.flatnonzero((byte == SPACE) | (byte == END))
            if len(ends):
                final = self.base[states[ends]] + END
                hit = self.check[final] == states[ends]
                out.append(self.base[final[hit]])
            to = self.base[states] + byte
            on = (self.check[to] == states) & (byte != END)
            states, at = to[on], at[on] + 1
        return np.concatenate(out) if out else np.empty(0, dtype=np.int32)


def _tree(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent, last byte and key number (-1: inner) of every node, level by level; node 0 is the root."""
    length = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys)) + 1
    text = np.frombuffer(b"".join(k + b"\n" for k in keys), dtype=np.uint8)
    start = np.cumsum(length) - length
    parents, symbols, numbers = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [np.full(1, -1, dtype=np.int64)]
    live, node, count, depth = np.arange(len(keys)), np.zeros(len(keys), dtype=np.int64), 1, 0
    while len(live):
        byte = text[start[live] + depth].astype(np.int64)
        new = np.ones(len(live), dtype=bool)
        new[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
        done = length[live] == depth + 1
        parents.append(node[new])
        symbols.append(byte[new])
        numbers.append(np.where(done[new], live[new], -1))
        node = count + np.cumsum(new) - 1
        count += int(new.sum())
        live, node, depth = live[~done], node[~done], depth + 1
    return np.concatenate(parents), np.concatenate(symbols), np.concatenate(numbers)
