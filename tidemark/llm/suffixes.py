"""Deep-shallow sorting: the order of strings, and how far neighbours agree.

Strings are first sorted to a shallow depth by multikey quicksort with eight bytes as one character: a segment is parted
into what is less than its pivot, equal and greater, and what is equal goes on to the next character. The segments of all
depths are parted together, a pass at a time. What still agrees goes to a blind trie per segment: a string walks down by the
branching bytes alone, is compared once with the leaf it meets, and is inserted where they part, so a long common
prefix is read once a string and not once a comparison.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Branch:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


def blind_trie(strings: list[bytes], members: list[int]) -> tuple[list[int], list[int]]:
    """Members in order of their strings, and what each shares with the one before it (the first: 0)."""
    top: _Branch | list[int] = [members[0]]

    def byte(string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    for member in members[1:]:
        string, node = strings[member], top
        while type(node) is _Branch:
            node = node.kids.get(byte(string, node.depth)) or next(iter(node.kids.values()))
        met = strings[node[0]]
        if met == string:
            node.append(member)
            continue
        depth = common(string, met)
        above, node = None, top
        while type(node) is _Branch and node.depth < depth:
            above, node = node, node.kids[byte(string, node.depth)]
        if type(node) is _Branch and node.depth == depth:
            node.kids[byte(string, depth)] = [member]
            continue
        branch = _Branch(depth, {byte(met, depth): node, byte(string, depth): [member]})
        if above is None:
            top = branch
        else:
            above.kids[byte(string, above.depth)] = branch
    order: list[int] = []
    shared: list[int] = []
    waiting = [(top, 0)]
    while waiting:
        node, before = waiting.pop()
        if type(node) is _Branch:
            kids = [node.kids[c] for c in sorted(node.kids)]
            waiting += [(kid, node.depth) for kid in reversed(kids[1:])]
            waiting.append((kids[0], before))
        else:
            order += node
            shared += [before] + [len(strings[node[0]])] * (len(node) - 1)
    return order, shared


def multikey_quicksort(characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their characters, and for each place where the rows begin that equal the one there."""
    n, depth = characters.shape
    order, start, level = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    place = np.arange(n if n > 1 and depth else 0)  # those in segments that go on
    while len(place):
        rows, own = order[place], level[place]
        first = np.flatnonzero(np.concatenate(([True], np.diff(start[place]) != 0)))
        sizes = np.diff(np.append(first, len(place)))
        value = characters[rows, own]
        three = np.sort(np.stack((value[first], value[first + sizes // 2], value[first + sizes - 1])), axis=0)
        pivot = np.repeat(three[1], sizes)
        side = (value > pivot).astype(np.int64) + (value >= pivot)
        part = 3 * np.repeat(np.arange(len(first)), sizes) + side
        turn = np.argsort(part, kind="stable")
        order[place] = rows[turn]
        begins = np.flatnonzero(np.concatenate(([True], np.diff(part[turn]) != 0)))
        lengths = np.diff(np.append(begins, len(place)))
        start[place] = np.repeat(place[begins], lengths)
        level[place] = own[turn] + (side[turn] == 1)
        place = place[(np.repeat(lengths, lengths) > 1) & (level[place] < depth)]
    return order, start


def deep_shallow(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and the common prefix of each with the one before it in that order (the first: 0)."""
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    head = np.frombuffer(b"".join([s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings]), np.uint8).reshape(n, SHALLOW)
    characters = np.ascontiguousarray(head).view(">u8").astype(np.uint64)
    order, segment = multikey_quicksort(np.column_stack((characters, np.minimum(lengths, SHALLOW).astype(np.uint64))))
    differ = head[order[1:]] != head[order[:-1]]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), SHALLOW)
    shared = np.concatenate(([0], np.minimum(first, np.minimum(lengths[order[1:]], lengths[order[:-1]]))))
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(segment) != 0, [True])))
    sizes = np.diff(bounds)
    for at, size in zip(bounds[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        members = order[at : at + size].tolist()
        if len(strings[members[0]]) < SHALLOW:
            shared[at + 1 : at + size] = len(strings[members[0]])
            continue
        if size == 2:
            a, b = strings[members[0]], strings[members[1]]
            agreed = common(a, b)
            if a > b:
                members.reverse()
            own = [0, agreed]
        else:
            members, own = blind_trie(strings, members)
        order[at : at + size] = members
        shared[at + 1 : at + size] = own[1:]
    return order, shared
