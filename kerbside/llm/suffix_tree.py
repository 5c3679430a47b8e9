"""Suffix trees of number sequences: ranks of suffixes and longest common extensions."""

from collections.abc import Sequence

import numpy as np

# The sequence's end: smaller than every symbol, which are numbers from 0.
END = -1


class SuffixTree:
    """Ukkonen's tree of a sequence, built in one pass, with an end symbol of its own.

    A node's edge is the stretch ``first[node]`` to ``last[node]`` of the sequence. A leaf's edge runs
    to the end, and ``suffix`` says where the suffix of a leaf begins (-1 for inner nodes).
    """

    def __init__(self, symbols: Sequence[int]):
        self.text = [*symbols, END]
        size = len(self.text)
        self.first, self.last, self.suffix = [0], [0], [-1]
        self.child: list[dict[int, int] | None] = [{}]
        link = [0]
        text, first, last, child = self.text, self.first, self.last, self.child
        # The active point: a node, the place in the text of its edge's first symbol, and how far
        # along that edge it lies. ``waiting`` suffixes are not yet in the tree.
        node, edge, along, waiting = 0, 0, 0, 0
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if along == 0:
                    edge = at
                down = child[node].get(text[edge])
                if down is None:
                    child[node][text[edge]] = self._leaf(at, size, at - waiting + 1, link)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    # A leaf's stretch ends beyond what is read, so it is never walked past.
                    span = last[down] - first[down]
                    if along >= span:
                        edge, along, node = edge + span, along - span, down
                        continue
                    if text[first[down] + along] == symbol:
                        along += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle = len(first)
                    first.append(first[down])
                    last.append(first[down] + along)
                    self.suffix.append(-1)
                    link.append(0)
                    child.append({text[first[down] + along]: down})
                    child[node][text[edge]] = middle
                    first[down] += along
                    child[middle][symbol] = self._leaf(at, size, at - waiting + 1, link)
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node == 0 and along:
                    along -= 1
                    edge = at - waiting + 1
                elif node:
                    node = link[node]

    def _leaf(self, at: int, size: int, suffix: int, link: list[int]) -> int:
        self.first.append(at)
        self.last.append(size)
        self.suffix.append(suffix)
        self.child.append(None)
        link.append(0)
        return len(self.first) - 1

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of an Euler tour, and the depths that it passes between them.

        Edges are taken by rising symbols, or by falling ones with the end still before all. Of the
        tour's inner visits those between two children are kept: the one between two leaves of
        least depth is their lowest common ancestor's.
        """
        suffixes, depths, low = [], [], 0
        first, last, child, suffix = self.first, self.last, self.child, self.suffix
        stack = [(0, 0, False)]
        while stack:
            node, depth, later = stack.pop()
            if later:
                low = depth
            edges = child[node]
            if edges is None:
                suffixes.append(suffix[node])
                depths.append(low)
                continue
            depth += last[node] - first[node]
            # Pushed the other way round: the edge pushed last is taken first.
            order = sorted(edges, reverse=not falling)
            if falling and order[0] == END:
                order.append(order.pop(0))
            for symbol in order[:-1]:
                stack.append((edges[symbol], depth, True))
            stack.append((edges[order[-1]], depth, False))
        return np.array(suffixes), np.array(depths[1:], np.int32)


def ranks(suffixes: np.ndarray) -> np.ndarray:
    """Place of each suffix in their order."""
    place = np.empty(len(suffixes), np.int64)
    place[suffixes] = np.arange(len(suffixes))
    return place


class CommonExtension:
    """Lengths of longest common prefixes of suffixes, each in constant time.

    Minima of all stretches of two, four, eight ... depths of the tour are held, so that two
    overlapping stretches answer for any range.
    """

    def __init__(self, suffixes: np.ndarray, depths: np.ndarray):
        self.place = ranks(suffixes)
        self.least = [depths]
        while 2 << (len(self.least) - 1) <= len(depths):
            half, before = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(before[:-half], before[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different suffixes; the end counts as a suffix that has none in common."""
        low, high = np.minimum(self.place[a], self.place[b]), np.maximum(self.place[a], self.place[b])
        # Exponent of the greatest power of two within the range: exact below 2**53.
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for each in np.unique(level):
            at = np.flatnonzero(level == each)
            least = self.least[each]
            found[at] = np.minimum(least[low[at]], least[high[at] - (1 << int(each))])
        return found
