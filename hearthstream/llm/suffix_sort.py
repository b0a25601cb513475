"""Deep-shallow sorting of byte strings with their longest common prefixes.

Strings are split by a multikey quicksort, eight bytes at a time, to a shallow
depth.  Groups that still agree there have long common prefixes and are ordered
by a blind trie: an insertion walks down by branching bytes alone, compares once
with the leaf it reaches, and adds one node.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differing = int.from_bytes(a) ^ int.from_bytes(b)
    return n - (differing.bit_length() + 7) // 8


class _Leaf:
    __slots__ = ("members",)

    def __init__(self, i: int):
        self.members = [i]


class _Branch:
    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth = depth
        self.children: dict = {}


def blind_trie_sort(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before it."""

    def byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1  # a prefix sorts first

    root: _Leaf | _Branch = _Leaf(0)
    for i in range(1, len(strings)):
        s = strings[i]
        node = root
        while type(node) is _Branch:
            found = node.children.get(byte(s, node.depth))
            node = found if found is not None else next(iter(node.children.values()))
        t = strings[node.members[0]]
        shared = common_prefix(s, t)
        if shared == len(s) == len(t):
            node.members.append(i)
            continue
        above, node = None, root
        while type(node) is _Branch and node.depth < shared:
            above, node = node, node.children[byte(s, node.depth)]
        if type(node) is not _Branch or node.depth != shared:
            branch = _Branch(shared)
            branch.children[byte(t, shared)] = node
            if above is None:
                root = branch
            else:
                above.children[byte(s, above.depth)] = branch
            node = branch
        node.children[byte(s, shared)] = _Leaf(i)
    order: list[int] = []
    prefixes: list[int] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if type(node) is _Leaf:
            for k, i in enumerate(node.members):
                order.append(i)
                prefixes.append(len(strings[i]) if k else before)
        else:
            keys = sorted(node.children)
            todo += [
                (node.children[c], before if c == keys[0] else node.depth) for c in reversed(keys)
            ]
    return order, prefixes


def _words(strings: list[bytes], depth: int) -> np.ndarray:
    flat = b"".join(s[:depth].ljust(depth, b"\0") for s in strings)
    return np.frombuffer(flat, ">u8").reshape(len(strings), depth // WORD).astype(np.uint64)


def deep_shallow_sort(
    groups: np.ndarray, strings: list[bytes], shallow: int = 48
) -> tuple[np.ndarray, np.ndarray]:
    """Sort by group number, then by string; with each one's prefix with its predecessor.

    The prefix of a group's first string is -1.
    """
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(groups, kind="stable")
    words = _words(strings, shallow)
    # Multikey quicksort: strings that agree so far are split by their next word.
    tied = np.zeros(n, np.int64)
    tied[1:] = np.cumsum(groups[order][1:] != groups[order][:-1])
    for column in range(words.shape[1]):
        counts = np.bincount(tied)
        active = np.flatnonzero(counts[tied] > 1)
        if not len(active):
            break
        rows = order[active]
        split = np.lexsort((words[rows, column], tied[active]))
        rows = rows[split]
        order[active] = rows
        word = words[rows, column]
        new = np.zeros(n, np.int64)
        new[active[1:]] = (word[1:] != word[:-1]) & (tied[active][1:] == tied[active][:-1])
        changed = np.zeros(n, np.int64)
        changed[1:] = tied[1:] != tied[:-1]
        tied = np.cumsum(changed | new)
    prefixes = np.full(n, -1, np.int64)
    starts = np.flatnonzero(np.diff(tied, prepend=-1))
    ends = np.append(starts[1:], n)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a > 1:
            rows = order[a:b]
            inner, shared = blind_trie_sort([strings[i] for i in rows.tolist()])
            order[a:b] = rows[inner]
            prefixes[a + 1 : b] = shared[1:]
        if a and groups[order[a]] == groups[order[a - 1]]:
            prefixes[a] = common_prefix(strings[order[a]], strings[order[a - 1]])
    return order, prefixes
