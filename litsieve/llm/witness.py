"""Merkle trees by aligned append, with incremental witnesses.

Leaves are appended from left to right. What is complete so far is a row of open subtrees of
falling height. Each leaf carries a partial witness, the siblings up to the root of its open
subtree; when a subtree and its sibling complete a larger one, the witnesses below either of
them are extended by the root of the other.

Levels pair nodes; a last node without a partner is hashed alone. :func:`fold` undoes it: it
tells from a position and the number of leaves on which side a sibling stands, if there is one.
"""

from __future__ import annotations

from binascii import hexlify
from hashlib import sha256

SIZE = 32


def node(*digests: bytes) -> bytes:
    """SHA-256 of the digests as hex text, one after the other."""
    return sha256(hexlify(b"".join(digests))).digest()


class Appender:
    """Open subtrees (height, root, first leaf) and one partial witness per leaf."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, int]] = []
        self.witnesses: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.witnesses.append(bytearray())
        self._add(0, leaf, len(self.witnesses) - 1)

    def _add(self, height: int, root: bytes, first: int) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, start = self.open.pop()
            for w in self.witnesses[start:first]:
                w += root
            for w in self.witnesses[first:]:
                w += left
            height, root, first = height + 1, node(left, root), start
        self.open.append((height, root, first))

    def close(self, height: int = 0) -> bytes:
        """Root of all leaves, of ``height`` levels at least; last nodes are hashed alone."""
        while len(self.open) > 1 or self.open[0][0] < height:
            at, root, first = self.open.pop()
            self._add(at + 1, node(root), first)
        return self.open[0][1]


def fold(leaf: bytes, witness: bytes, position: int, size: int) -> tuple[bytes, bytes]:
    """(root, unused rest of the witness) of the leaf at a position among ``size`` leaves."""
    while size > 1:
        if position % 2 == 0 and position + 1 == size:
            leaf = node(leaf)
        else:
            sibling, witness = witness[:SIZE], witness[SIZE:]
            leaf = node(sibling, leaf) if position % 2 else node(leaf, sibling)
        position, size = position // 2, (size + 1) // 2
    return leaf, witness
