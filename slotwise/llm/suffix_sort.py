"""Deep-shallow sorting of byte strings, with their common prefixes.

Multikey quicksort orders the strings by eight bytes at a time down to a shallow
depth. Strings still equal there form groups with a long common prefix; each
such group is ordered by a blind trie, which holds branching bytes only and
compares whole strings once per insertion.
"""

from __future__ import annotations

SHALLOW = 64
_STEP = 8


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (x.bit_length() + 7) // 8


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, lcp): places in sorted order, and each one's common prefix with
    the one before it (0 for the first). The strings are known to agree on their
    first ``depth`` bytes, or to be shorter."""
    order: list[int] = []
    stack = [(list(range(len(strings))), depth)]
    while stack:
        group, at = stack.pop()
        if len(group) == 1:
            order += group
        elif at - depth >= shallow:
            order += BlindTrie(strings, group).order()
        else:
            pivot = strings[group[len(group) // 2]][at:at + _STEP]
            less, same, more = [], [], []
            for i in group:
                key = strings[i][at:at + _STEP]
                (same if key == pivot else less if key < pivot else more).append(i)
            if more:
                stack.append((more, at))
            if len(pivot) < _STEP:
                stack += [([i], at) for i in reversed(same)]        # equal strings that end here
            else:
                stack.append((same, at + _STEP))
            if less:
                stack.append((less, at))
    lcp = [0] * len(order)
    for k in range(1, len(order)):
        lcp[k] = common(strings[order[k - 1]], strings[order[k]])
    return order, lcp


class BlindTrie:
    """A compacted trie whose nodes hold a depth and branching bytes; -1 is the
    end of a string. Leaves hold the places of equal strings."""

    def __init__(self, strings: list[bytes], places: list[int]):
        self.strings = strings
        self.root: list | dict = [places[0]]            # leaf: list; node: {"depth": d, byte: child}
        for i in places[1:]:
            self.insert(i)

    def byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        # blind search: follow branching bytes only, any child where none fits
        node = self.root
        while isinstance(node, dict):
            child = node.get(self.byte(i, node["depth"]))
            node = child if child is not None else next(v for k, v in node.items() if k != "depth")
        leaf = node[0]
        n = common(self.strings[i], self.strings[leaf])
        if n == len(self.strings[i]) == len(self.strings[leaf]):
            node.append(i)
            return
        # the branch is made where the strings part
        above, node = None, self.root
        while isinstance(node, dict) and node["depth"] < n:
            above = node, self.byte(i, node["depth"])
            node = node[above[1]]
        if isinstance(node, dict) and node["depth"] == n:
            node[self.byte(i, n)] = [i]
            return
        branch = {"depth": n, self.byte(leaf, n): node, self.byte(i, n): [i]}
        if above is None:
            self.root = branch
        else:
            above[0][above[1]] = branch

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, dict):
                stack += [node[k] for k in sorted((k for k in node if k != "depth"), reverse=True)]
            else:
                out += node
        return out
