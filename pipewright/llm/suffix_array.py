"""Common-prefix interval tree over an enhanced suffix array, as plain functions on one bucket of suffixes.

A bucket holds suffixes that begin alike: for each the bytes to its right (the
suffix, up to a cap) and the bytes to its left. Sorted by the right bytes, with
the common prefix lengths of neighbours, the nested intervals of the array are
the inner nodes of the suffix tree. A stack finds them in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Nodes (depth, first, last) of at least ``least``; ``common[i]`` is the length shared by elements i and i + 1.

    Every node is given once, after the nodes inside it.
    """
    stack: list[tuple[int, int]] = []  # (depth, first), depths rising
    for i, depth in enumerate([*common, least - 1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def prefixes(rows: list[bytes], width: int) -> np.ndarray:
    """Common prefix length of each two neighbours; rows hold at most ``width`` bytes."""
    if len(rows) < 2:
        return np.zeros(0, np.int64)
    size = np.array([len(r) for r in rows])
    grid = np.frombuffer(b"".join(r.ljust(width + 1, b"\0") for r in rows), np.uint8).reshape(len(rows), width + 1)
    differ = grid[1:] != grid[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.minimum(first, np.minimum(size[1:], size[:-1]))


def common_suffix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[len(a) - n:]) ^ int.from_bytes(b[len(b) - n:])
    return ((x & -x).bit_length() - 1) >> 3 if x else n


def repeats(left: list[bytes], common: list[int], least: int, root: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of a bucket as (bytes to the left, bytes to the right, all members).

    ``common`` are the common prefixes of the suffixes in their order, ``root`` the
    prefix that all share. A node of the tree gives its members one right end;
    sorted by their left bytes, the same scan gives the sets that share a longest
    left extension, and whoever joins or leaves such a set has another byte there.
    Sets that lie inside one child of the node can be extended to the right: the
    child gives them. What remains can be extended on neither side.
    """
    order = sorted(range(len(left)), key=lambda i: left[i][::-1])
    rank = [0] * len(left)
    for place, i in enumerate(order):
        rank[i] = place
    for right, first, last in intervals(common, root):
        members = sorted(range(first, last + 1), key=rank.__getitem__)
        shared = [common_suffix(left[a], left[b]) for a, b in pairwise(members)]
        for lead, x, y in intervals(shared, max(least - right, 0)):
            group = members[x:y + 1]
            if right in common[min(group):max(group)]:
                yield lead, right, group
