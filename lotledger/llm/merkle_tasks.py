"""Hash trees of a builder's leaves as a postorder log, and proofs read from it by position."""

from __future__ import annotations

import hashlib

# Children of a node, and the height of what one builder holds (16 ** 3 = 4,096 leaves).
ARITY, HEIGHT = 16, 3


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def ceiling(a: int, b: int) -> int:
    return -(-a // b)


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = ceiling(leaves, ARITY), height + 1
    return height


def postorder_position(level: int, index: int, leaves: int, height: int) -> int:
    """Place (from 0) of node ``index`` of ``level`` among the nodes of a tree in order of completion.

    A node is complete once the last leaf below it is written; at that moment
    it follows the nodes below it and precedes those above. So the nodes
    written up to it are, per level up to its own, all that end where it ends
    or earlier, and per higher level those that end before it begins.
    """
    end = min((index + 1) * ARITY ** level, leaves)
    up_to = sum(ceiling(end, ARITY ** m) for m in range(level + 1))
    return up_to + sum(index * ARITY ** level // ARITY ** m for m in range(level + 1, height + 1)) - 1


def build_log(leaves: list[str], height: int) -> list[str]:
    """Nodes in order of completion; the last one is the root.

    One open run per level is all that is held. After the last leaf the open
    runs are closed from below, also those of a single node.
    """
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(height)]

    def write(level: int, digest: str) -> None:
        log.append(digest)
        if level < height:
            runs[level].append(digest)
            if len(runs[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        whole, runs[level] = "".join(runs[level]), []
        write(level + 1, digest_of(whole))

    for leaf in leaves:
        write(0, leaf)
    for level in range(height):
        if runs[level]:
            close(level)
    return log


def siblings(log: list[str], leaf: int, leaves: int, height: int) -> list[tuple[str, str]]:
    """Per level from the leaf up: the digests before and after its own in its run, joined."""
    out = []
    for level in range(height):
        index, count = leaf // ARITY ** level, ceiling(leaves, ARITY ** level)
        first = index // ARITY * ARITY
        place = lambda i: postorder_position(level, i, leaves, height)  # noqa: B023, E731
        out.append(("".join(log[place(i)] for i in range(first, index)),
                    "".join(log[place(i)] for i in range(index + 1, min(first + ARITY, count)))))
    return out


def run_siblings(log: list[str], leaves: int, height: int) -> list[list[tuple[str, str]]]:
    """:func:`siblings` of every leaf, each node's pair read once."""
    known: dict = {}
    out = []
    for leaf in range(leaves):
        path = []
        for level in range(height):
            key = (level, leaf // ARITY ** level)
            if key not in known:
                index, count = key[1], ceiling(leaves, ARITY ** level)
                first = index // ARITY * ARITY
                run = [log[postorder_position(level, i, leaves, height)] for i in range(first, min(first + ARITY, count))]
                known[key] = ("".join(run[:index - first]), "".join(run[index - first + 1:]))
            path.append(known[key])
        out.append(path)
    return out


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = digest_of(before + digest + after)
    return digest


def build(leaves: list[str], alone: bool, height: int = HEIGHT) -> list[str]:
    """A builder's log; one of several builders goes up to their common height."""
    return build_log(leaves, height_of(len(leaves)) if alone else height)


def paths(log: list[str], leaves: int, alone: bool, height: int = HEIGHT) -> list[list[tuple[str, str]]]:
    return run_siblings(log, leaves, height_of(leaves) if alone else height)
