"""Decoding of prefix codes by finite automata in arrays.

A state is an inner node of a code tree. A step takes ``WIDE`` or ``NARROW`` bits at once: from a state and these
bits a table gives the next state and the UTF-8 bytes of the symbols on the way, as a slice. The last few bits of a
text are a shorter step of the same table. So a text is a row of table entries, and its bytes are their slices.

The states of one text depend on each other, but many texts are walked together, and long ones are cut into
segments. A segment other than the first starts in a guessed state, that of the root; where the guess was wrong, it
is walked again only until both ways meet, which prefix codes soon do. Where all codes have a length that some number
divides, segments hold a multiple of that many bits, so that the guess is not out of step for good. For codes that
do not meet nevertheless, the ways from all states through a segment are taken together; states that meet are one
from there on.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np

WIDE, NARROW = 8, 4
#: Steps in a segment, at least.
SEGMENT = 128
#: Walks over wrong guesses before every state is followed.
_GUESSES = 16
_DEAD = 0


class Forest:
    """Code trees of some texts as arrays. State 0 is that of bits which no code begins with; it has no way out."""

    def __init__(self):
        self.children: list[list[int]] = [[_DEAD, _DEAD]]
        self.symbols: list[bytes] = []
        self.roots: list[int] = []
        self.divisors: list[int] = []

    def add(self, codes: dict[str, str]) -> int:
        """Number of the tree of these codes; leaves are negative numbers of symbols."""
        children, root = self.children, len(self.children)
        children.append([_DEAD, _DEAD])
        for symbol, code in codes.items():
            node = root
            for bit in code[:-1]:
                below = children[node][bit == "1"]
                if below <= _DEAD:
                    below = children[node][bit == "1"] = len(children)
                    children.append([_DEAD, _DEAD])
                node = below
            self.symbols.append(symbol.encode("utf-8", "surrogatepass"))
            children[node][code[-1:] == "1"] = -len(self.symbols)
        self.roots.append(root)
        self.divisors.append(math.gcd(*map(len, codes.values())) or 1)
        return len(self.roots) - 1

    def automaton(self, width: int) -> Automaton:
        return Automaton(self, width)


class Automaton:
    """Tables over ``(state, 1 followed by up to width bits)``."""

    def __init__(self, forest: Forest, width: int):
        self.width = width
        self.roots = np.array(forest.roots, np.int64)
        bits = np.array(forest.divisors, np.int64)
        bits //= np.gcd(bits, width)
        self.segment = -(-SEGMENT // bits) * bits
        below = np.array(forest.children, np.int64)
        states = len(below)
        self.stride = 2 << width
        root_of = np.repeat(np.r_[_DEAD, self.roots], np.diff(np.r_[0, self.roots, states]))
        after = np.zeros((states, self.stride), np.int64)
        after[:, 1] = np.arange(states)
        said = np.full((states, self.stride, width), -1, np.int32)  # symbols in the order of their last bits
        for bits in range(width):
            at = np.arange(1 << bits, 2 << bits)
            for bit in (0, 1):
                found, to = below[after[:, at], bit], 2 * at + bit
                leaf = found < 0
                after[:, to] = np.where(leaf, root_of[:, None], found)
                said[:, to, :bits] = said[:, at, :bits]
                said[:, to, bits] = np.where(leaf, -found - 1, -1)
        self.after = (after * self.stride).ravel()  # states as places of their entries
        symbol = said.reshape(-1)
        used = symbol >= 0
        sizes = np.array([len(x) for x in forest.symbols] or [0], np.int64)
        each = np.where(used, sizes[symbol], 0)
        self.count = each.reshape(-1, width).sum(1)
        self.first = np.cumsum(self.count) - self.count
        self.bytes = slices(
            np.frombuffer(b"".join(forest.symbols), np.uint8), (np.cumsum(sizes) - sizes)[symbol[used]], sizes[symbol[used]]
        )

    def nbytes(self) -> int:
        return self.after.nbytes + self.count.nbytes + self.first.nbytes + self.bytes.nbytes

    def decode(self, packed: list[bytes], trees: Iterable[int]) -> list[bytes]:
        """UTF-8 bytes of texts, each given as a padding byte and code bits."""
        trees = np.fromiter(trees, np.int64, len(packed))
        return self._decode(packed, trees, self.roots[trees] * self.stride)[0]

    def pieces(self, packed: bytes, tree: int, size: int) -> Iterator[bytes]:
        """One text in pieces of ``size`` coded bytes; a piece ends with a whole symbol."""
        trees, state = np.array([tree]), self.roots[[tree]] * self.stride
        for begin in range(1, len(packed), size):
            padding = packed[:1] if begin + size >= len(packed) else b"\0"
            (text,), state = self._decode([padding + packed[begin : begin + size]], trees, state)
            yield text

    def _decode(self, packed: list[bytes], trees: np.ndarray, start: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Texts, and the states in which they end."""
        steps, sizes = self._steps(packed)
        entries = self._walk(steps, sizes, trees, start)
        count = self.count[entries]
        data = slices(self.bytes, self.first[entries], count).tobytes()
        ends = np.cumsum(sizes)
        bounds = np.r_[0, np.cumsum(count)][np.r_[0, ends]].tolist()
        state = np.where(sizes > 0, self.after[entries[ends - 1]] if len(entries) else start, start)
        return [data[begin:end] for begin, end in zip(bounds, bounds[1:])], state

    def _steps(self, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What each step reads, as 1 followed by its bits, and the number of steps of each text."""
        lengths = np.array([len(x) for x in packed], np.int64)
        data = np.frombuffer(b"".join(packed), np.uint8)
        begin = np.cumsum(lengths) - lengths
        body = np.ones(len(data), bool)
        body[begin] = False
        padding = data[begin].astype(np.int64)
        bits = (lengths - 1) * 8 - padding
        codes = data[body].astype(np.int64)
        if self.width == NARROW:
            codes = np.stack([codes >> 4, codes & 15], 1).ravel()
        each = (lengths - 1) * (8 // self.width)
        whole, rest = np.divmod(np.maximum(bits, 0), self.width)
        sizes = whole + (rest > 0)
        first = np.cumsum(each) - each
        if (sizes != each).any():  # steps that hold nothing but padding
            within = np.arange(len(codes)) - np.repeat(first, each) < np.repeat(sizes, each)
            codes = codes[within]
        codes |= 1 << self.width
        last = (np.cumsum(sizes) - 1)[rest > 0]
        codes[last] >>= self.width - rest[rest > 0]
        return codes, sizes

    def _walk(self, steps: np.ndarray, sizes: np.ndarray, trees: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Table entry of every step."""
        roots, size = self.roots[trees] * self.stride, self.segment[trees]
        segments = -(-sizes // size)
        text = np.repeat(np.arange(len(sizes)), segments)
        number = np.arange(len(text)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = (np.cumsum(sizes) - sizes)[text] + number * size[text]
        length = np.minimum(sizes[text] - number * size[text], size[text])
        entries = np.full(len(steps), -1)
        state = np.where(number > 0, roots[text], start[text])
        final = np.empty(len(text), np.int64)
        self._first(steps, entries, begin, length, state, final)
        linked = np.flatnonzero(number[1:] > 0) + 1
        for _ in range(_GUESSES):
            wrong = linked[state[linked] != final[linked - 1]]
            if not len(wrong):
                return entries
            state[wrong] = final[wrong - 1]
            self._advance(steps, entries, begin, length, wrong[np.argsort(-length[wrong], kind="stable")], state, final)
        wrong = linked[state[linked] != final[linked - 1]]
        if len(wrong):
            self._follow(steps, begin, length, number, text, roots, state, final)
            self._first(steps, entries, begin, length, state, final)
        return entries

    def _first(self, steps, entries, begin, length, state, final) -> None:
        """Walk all segments, longest first, with the steps of equal number side by side."""
        order = np.argsort(-length, kind="stable")
        numbers = np.arange(int(length.max(initial=0)))
        going = np.searchsorted(-length[order], -numbers, "left").tolist()
        places = np.concatenate([begin[order[:n]] + step for step, n in enumerate(going)] or [numbers])
        read, walked, at = steps[places], np.empty(len(places), np.int64), 0
        now = state[order]
        for n in going:
            if n < len(now):
                final[order[n : len(now)]] = now[n:]
            entry = np.add(now[:n], read[at : at + n], out=walked[at : at + n])
            now = self.after[entry]
            at += n
        final[order[: len(now)]] = now
        entries[places] = walked

    def _advance(self, steps, entries, begin, length, live, state, final) -> None:
        """Walk the segments ``live``, longest first, until they end or meet the way they were walked before."""
        now = state[live]
        sizes = -length[live]
        for step in range(-int(sizes.min(initial=0))):
            going = np.searchsorted(sizes[: len(live)], -step, "left")  # those with more than ``step`` steps
            if going < len(live):
                final[live[going:]] = now[going:]
                live, now = live[:going], now[:going]
            if not len(live):
                return
            at = begin[live] + step
            entry = now + steps[at]
            other = entries[at] != entry
            if not other.all():
                live, at, entry = live[other], at[other], entry[other]
                if not len(live):
                    return
                sizes = -length[live]
            entries[at] = entry
            now = self.after[entry]
        final[live] = now

    def _follow(self, steps, begin, length, number, text, roots, state, final) -> None:
        """Set the true state at the begin of each segment from the ways of all states through all segments."""
        inner = np.flatnonzero(number[1:] > 0)  # segments with one behind them
        bounds = np.r_[self.roots * self.stride, len(self.after)]
        tree = np.searchsorted(bounds, roots[text[inner]], "right") - 1
        first, many = bounds[tree], (bounds[tree + 1] - bounds[tree]) // self.stride + 1
        # A way is a segment and a state; the last state of each segment stands for bits without a code.
        lane = np.repeat(np.arange(len(inner)), many)
        local = np.arange(len(lane)) - np.repeat(np.cumsum(many) - many, many)
        dead = local == np.repeat(many, many) - 1
        way = np.where(dead, 0, first[lane] + local * self.stride)
        meets = np.arange(len(lane))
        for step in range(int(length[inner].max())):
            going = step < length[inner[lane]]
            way[going] = self.after[way[going] + steps[begin[inner[lane[going]]] + step]]
            if step in (1, 3, 7, 15, 31, 63):
                _, kept, merged = np.unique(lane * len(self.after) + way, return_index=True, return_inverse=True)
                lane, way, meets = lane[kept], way[kept], merged[meets]
        reached = way[meets]
        offset = np.cumsum(many) - many
        for place, segment in enumerate(inner.tolist()):
            now = state[segment]
            own = many[place] - 1 if now == 0 else (now - first[place]) // self.stride
            state[segment + 1] = final[segment] = reached[offset[place] + own]


def slices(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``data[first[i] : first[i] + count[i]]`` for all ``i``, back to back."""
    total = int(count.sum())
    if not total:
        return data[:0]
    return data[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(total)]
