"""Deep-shallow sorting of suffixes: multikey quicksort first, blind tries for what still shares a long prefix."""

from __future__ import annotations

import numpy as np

WORD = 8  # bytes of a character of the quicksort


def characters(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on as one number that sorts alike; zeros beyond the end."""
    out = np.concatenate([data, np.zeros(WORD, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        out = (out[:-size] << np.uint64(8 * size)) | out[size:]
    return out[: len(data)]


def multikey_quicksort(
    data: np.ndarray, at: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, shallow: int
) -> list[tuple[int, int]]:
    """Sort the segments of order in place by the first bytes of the suffixes; returns segments that are equal so far.

    All segments take one step at a time: partition by a pivot character into less, equal
    and greater; the equal part goes on with the next character.
    """
    words, depth, deep = characters(data), np.zeros(len(start), np.int64), []
    while True:
        more = size > 1
        start, size, depth = start[more], size[more], depth[more]
        low = depth >= shallow
        deep += zip(start[low].tolist(), size[low].tolist(), strict=True)
        start, size, depth = start[~low], size[~low], depth[~low]
        if not len(start):
            return deep
        first = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(start)), size)
        members = np.arange(len(segment)) + (start - first)[segment]
        suffixes = order[members]
        word = words[at[suffixes] + depth[segment]]
        pivot = word[first + size // 2][segment]
        part = (word >= pivot).astype(np.int64) + (word > pivot)
        counts = np.bincount(segment * 3 + part, minlength=3 * len(start)).reshape(-1, 3)
        inside = np.cumsum(counts, axis=1) - counts
        for p in range(3):
            mine = np.flatnonzero(part == p)
            before = np.cumsum(counts[:, p]) - counts[:, p]
            s = segment[mine]
            order[start[s] + inside[s, p] + np.arange(len(mine)) - before[s]] = suffixes[mine]
        start = (start[:, None] + inside).reshape(-1)
        depth = (depth[:, None] + np.array([0, WORD, 0])).reshape(-1)
        size = counts.reshape(-1)


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Indexes of strings of one length in sorted order, equal ones together.

    A node holds the byte position it branches on and its children; a leaf holds equal
    strings. A search looks at the branching bytes only, and one comparison with the leaf
    it ends in tells where the new string leaves the trie.
    """
    root: list = [0]  # a leaf: indexes of equal strings
    is_leaf = {id(root)}
    leaves = [root]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while id(node) not in is_leaf:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        t = strings[node[0]]
        if s == t:
            node.append(i)
            continue
        gap = int.from_bytes(s, "big") ^ int.from_bytes(t, "big")
        same = len(s) - (gap.bit_length() + 7) // 8
        above, node = None, root
        while id(node) not in is_leaf and node[0] < same:
            above, node = node, node[1][s[node[0]]]
        leaf = [i]
        leaves.append(leaf)  # keeps ids unique
        is_leaf.add(id(leaf))
        if id(node) not in is_leaf and node[0] == same:
            node[1][s[same]] = leaf
            continue
        branch = [same, {t[same]: node, s[same]: leaf}]
        if above is None:
            root = branch
        else:
            above[1][s[above[0]]] = branch
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) in is_leaf:
            out.append(node)
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow(
    data: np.ndarray, at: np.ndarray, start: np.ndarray, size: np.ndarray, depth: int, shallow: int = 32
) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes that begin at `at` within segments by their first `depth` bytes.

    Returns their order and, for every place in it, whether its suffix differs from the
    one before. Every suffix has at least depth bytes.
    """
    order, new = np.arange(len(at)), np.ones(len(at), bool)
    shallow = min(shallow, depth // WORD * WORD)
    text = data.tobytes()
    for first, n in multikey_quicksort(data, at, order, start, size, shallow):
        suffixes = order[first : first + n].tolist()
        places = at[order[first : first + n]].tolist()
        place = first
        for equal in blind_trie([text[p + shallow : p + depth] for p in places]):
            order[place : place + len(equal)] = [suffixes[i] for i in equal]
            new[place + 1 : place + len(equal)] = False
            place += len(equal)
    return order, new
