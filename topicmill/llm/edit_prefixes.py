"""Edit strings as linked nodes that share their prefixes.

A node is one more piece after its parent. It keeps ancestors at distances of powers of
two and a rolling hash of all letters up to it, so the longest common prefix of two strings
is found by lifting both nodes together while their hashes differ. Equal hashes of different
nodes are verified letter by letter.
"""

from __future__ import annotations

_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Prefixes:
    """Node 0 is the empty string."""

    def __init__(self):
        self.parent = [0]
        self.piece = [""]
        self.depth = [0]
        self.print = [0]
        self.up: list[list[int]] = [[]]

    def add(self, node: int, piece: str) -> int:
        """The node of ``piece``, which is not empty, after ``node``."""
        new, up = len(self.parent), [node]
        while len(self.up[up[-1]]) >= len(up):
            up.append(self.up[up[-1]][len(up) - 1])
        value = self.print[node]
        for letter in piece:
            value = (value * _BASE + ord(letter)) % _PRIME
        self.parent.append(node)
        self.piece.append(piece)
        self.depth.append(self.depth[node] + 1)
        self.print.append(value)
        self.up.append(up)
        return new

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor at ``depth``."""
        while self.depth[node] > depth:
            up, gap = self.up[node], self.depth[node] - depth
            node = up[min(gap.bit_length(), len(up)) - 1]
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth have the same pieces; equal hashes are verified."""
        if self.print[x] != self.print[y]:
            return False
        while x != y:
            if self.piece[x] != self.piece[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def parted(self, x: int, y: int) -> tuple[int, int]:
        """Where the strings of two nodes of one depth part: their ancestors after the longest
        common prefix of pieces, or the nodes themselves when nothing differs."""
        if self.same(x, y):
            return x, y
        step = len(self.up[x]) - 1
        while step >= 0:
            if step < len(self.up[x]) and not self.same(self.up[x][step], self.up[y][step]):
                x, y = self.up[x][step], self.up[y][step]
            else:
                step -= 1
        return x, y

    def less(self, x: int, y: int) -> bool:
        """Whether the string of ``x`` comes before that of ``y``; a prefix comes first."""
        depth = min(self.depth[x], self.depth[y])
        low, high = self.lifted(x, depth), self.lifted(y, depth)
        one, two = self.parted(low, high)
        if one == two or self.same(one, two):
            return self.depth[x] < self.depth[y]
        a, b = self.piece[one], self.piece[two]
        if a.startswith(b) or b.startswith(a):  # pieces of other lengths: the rest decides
            return self.text(x, self.depth[one] - 1) < self.text(y, self.depth[two] - 1)
        return a < b

    def text(self, node: int, depth: int = 0) -> str:
        """The letters of a node after its ancestor at ``depth``."""
        return "".join(self.pieces(node, depth))

    def pieces(self, node: int, depth: int = 0) -> list[str]:
        """The pieces of a node after its ancestor at ``depth``, in order."""
        found = []
        while self.depth[node] > depth:
            found.append(self.piece[node])
            node = self.parent[node]
        return found[::-1]
