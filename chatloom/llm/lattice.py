"""All segmentations of a word into weighted pieces, in log space."""

from __future__ import annotations

import math

import numpy as np
import sentencepiece

START = "▁"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # any odd number mixes
_BITS = 22
_NOTHING = np.uint64(0x110000)  # beyond every character
_CELLS = 1 << 20
# Words of as many characters go by windows, one at a time.
LONG = 1 << 12
WINDOW = 1 << 14
# Learning goes over long words in stretches of as many characters.
STRETCH = 1 << 8


def _hash(text: str) -> int:
    value = 0
    for char in text:
        value = (value * int(_MULTIPLIER) + ord(char) + 1) % (1 << 64)
    return value


def _slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _MULTIPLIER) >> np.uint64(64 - _BITS)).astype(np.int64)


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a published vocabulary file with prior probabilities that sum to 1.

    The file's scores are negated merge ranks, not logarithms; a piece of rank r has
    weight 1 / (r + 1), as in Zipf's law. A byte gets the weight of the last rank. A
    piece with the word mark anywhere but at its start can't occur in a word.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights = {}
    for number in range(model.get_piece_size()):
        if model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
            continue
        piece = model.id_to_piece(number)
        if START in piece[1:] or model.get_score(number) < -1e8:
            continue
        rank = model.get_piece_size() if model.is_byte(number) else -model.get_score(number)
        weights[piece] = 1.0 / (rank + 1.0)
    total = sum(weights.values())
    return {piece: w / total for piece, w in weights.items()}


class Lattice:
    """Forward sums over the segmentations of many words at a time.

    ``logs`` has the natural logarithm of every piece's probability. A character
    that is no piece is spelled by its UTF-8 bytes, so that any word has a
    segmentation. Words of like lengths are laid side by side, a column each, and
    the recursion goes down the columns of all of them together.
    """

    def __init__(self, logs: dict[str, float]):
        self.pieces = list(logs)
        self.logs = np.array([logs[p] for p in self.pieces])
        self.bytes = {p: i for i, p in enumerate(self.pieces) if _is_byte(p)}
        plain = [i for i, p in enumerate(self.pieces) if not _is_byte(p)]
        self.longest = max((len(self.pieces[i]) for i in plain), default=1)
        hashes = np.array([_hash(self.pieces[i]) for i in plain], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array(plain, dtype=np.int64)[order]
        # A hash that isn't marked here belongs to no piece.
        self.marked = np.zeros(1 << _BITS, dtype=bool)
        self.marked[_slot(self.hashes)] = True

    def _spelled(self, char: str) -> list[int]:
        return [self.bytes[b] for b in byte_pieces(char) if b in self.bytes]

    def _arcs(self, texts: list[str], tall: int):
        """For every start and size the columns in which a piece stands, and which.

        A spelled character is an arc with number -1 - its code.
        """
        codes = np.full((tall, len(texts)), _NOTHING, dtype=np.uint64)
        for column, text in enumerate(texts):
            codes[: len(text), column] = np.frombuffer(
                text.encode("utf-32-le", "surrogatepass"), dtype="<u4"
            )
        for start in range(tall):
            hashes = np.zeros(len(texts), dtype=np.uint64)
            for size in range(1, min(self.longest, tall - start) + 1):
                hashes = hashes * _MULTIPLIER + codes[start + size - 1] + np.uint64(1)
                columns = np.flatnonzero(self.marked[_slot(hashes)])
                at = np.searchsorted(self.hashes, hashes[columns])
                at = np.minimum(at, len(self.hashes) - 1)
                real = self.hashes[at] == hashes[columns]
                columns, numbers = columns[real], self.numbers[at[real]]
                if size == 1:
                    lone = codes[start] != _NOTHING
                    lone[columns] = False
                    lone = np.flatnonzero(lone)
                    columns = np.concatenate([columns, lone])
                    spelled = -1 - codes[start][lone].astype(np.int64)
                    numbers = np.concatenate([numbers, spelled])
                if len(columns):
                    yield start, start + size, columns, numbers

    def _weights(self, numbers: np.ndarray) -> np.ndarray:
        weights = self.logs[np.maximum(numbers, 0)]
        for code in np.unique(numbers[numbers < 0]):
            own = self._spelled(chr(-1 - code))
            weights[numbers == code] = self.logs[own].sum() if own else -700.0
        return weights

    def _groups(self, words: list[str]):
        """Words of like lengths: their places, their marked texts, the longest length."""
        places = [i for i, w in enumerate(words) if len(w) < LONG]
        for own, texts, tall in self._laid([START + words[i] for i in places], _CELLS):
            yield np.array(places)[own], texts, tall

    def _laid(self, texts: list[str], cells: int):
        """Texts of like lengths: their places, they, the longest length."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            least = sizes[order[at]]
            end = int(np.searchsorted(sizes[order], least + 1 + least // 4, side="right"))
            # Bounds the matrix of a group, however long its words are.
            end = min(end, at + max(1, cells // int(least)))
            own = order[at:end]
            yield own, [texts[i] for i in own], int(sizes[own].max())
            at = end

    def marginals(self, words: list[str]) -> np.ndarray:
        """Log probability of every word, summed over all its segmentations."""
        out = np.zeros(len(words))
        for own, texts, tall in self._groups(words):
            ahead = np.full((tall + 1, len(texts)), -np.inf)
            ahead[0] = 0.0
            for start, end, columns, numbers in self._arcs(texts, tall):
                ahead[end, columns] = np.logaddexp(
                    ahead[end, columns], ahead[start, columns] + self._weights(numbers)
                )
            sizes = np.array([len(t) for t in texts])
            out[own] = ahead[sizes, np.arange(len(texts))]
        for place, word in enumerate(words):
            if len(word) >= LONG:
                out[place] = self._marginal_of_long(START + word)
        return out

    def expected(self, words: list[str]) -> np.ndarray:
        """How often each piece is expected in all the words together, every word shared
        among its segmentations by their weights. Long words go by stretches, whose
        ends no piece crosses.
        """
        counts = np.zeros(len(self.pieces))
        texts = [START + word for word in words]
        cut = [t[i : i + STRETCH] for t in texts if len(t) > LONG for i in range(0, len(t), STRETCH)]
        texts = [t for t in texts if len(t) <= LONG] + cut
        # All arcs of a group are held, so it is smaller than one of forward sums alone.
        for _, own, tall in self._laid(texts, _CELLS // 4):
            arcs = [(*arc, self._weights(arc[3])) for arc in self._arcs(own, tall)]
            ahead = np.full((tall + 1, len(own)), -np.inf)
            ahead[0] = 0.0
            for start, end, columns, _, weights in arcs:
                ahead[end, columns] = np.logaddexp(
                    ahead[end, columns], ahead[start, columns] + weights
                )
            sizes, every = np.array([len(t) for t in own]), np.arange(len(own))
            total = ahead[sizes, every]
            behind = np.full_like(ahead, -np.inf)
            behind[sizes, every] = 0.0
            for start, end, columns, numbers, weights in reversed(arcs):
                rest = weights + behind[end, columns]
                behind[start, columns] = np.logaddexp(behind[start, columns], rest)
                share = np.exp(ahead[start, columns] + rest - total[columns])
                known = numbers >= 0
                counts += np.bincount(numbers[known], share[known], minlength=len(counts))
                for code in np.unique(numbers[~known]):
                    for number in self._spelled(chr(-1 - code)):
                        counts[number] += share[numbers == code].sum()
        return counts

    def _window(self, codes: np.ndarray, start: int, end: int):
        """(start, end, weight) lists of the arcs that begin in a stretch of one text,
        in the order of their starts, which count from the stretch's."""
        found = []
        hashes = np.zeros(end - start, dtype=np.uint64)
        for size in range(1, min(self.longest, len(codes) - start) + 1):
            # An arc ends within the text, so the last ones of it are shorter.
            hashes = hashes[: len(codes) - start - size + 1]
            behind = codes[start + size - 1 : start + size - 1 + len(hashes)]
            hashes = hashes * _MULTIPLIER + behind + np.uint64(1)
            places = np.flatnonzero(self.marked[_slot(hashes)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[places]), len(self.hashes) - 1)
            real = self.hashes[at] == hashes[places]
            places, numbers = places[real], self.numbers[at[real]]
            if size == 1:
                lone = np.ones(len(hashes), dtype=bool)
                lone[places] = False
                lone = np.flatnonzero(lone)
                places = np.concatenate([places, lone])
                spelled = -1 - behind[lone].astype(np.int64)
                numbers = np.concatenate([numbers, spelled])
            found.append((places, places + size, self._weights(numbers)))
        starts, ends, weights = (np.concatenate(parts) for parts in zip(*found))
        order = np.argsort(starts, kind="stable")
        return starts[order].tolist(), ends[order].tolist(), weights[order].tolist()

    def _marginal_of_long(self, text: str) -> float:
        """The same for one long text: only the sums of the next ``longest`` places
        are carried from window to window."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = codes.astype(np.uint64)
        carried = [0.0] + [-math.inf] * self.longest
        for start in range(0, len(codes), WINDOW):
            end = min(start + WINDOW, len(codes))
            ahead = carried + [-math.inf] * (end - start)
            for a, b, weight in zip(*self._window(codes, start, end)):
                new, old = ahead[a] + weight, ahead[b]
                more, less = (new, old) if new > old else (old, new)
                if less == -math.inf:
                    ahead[b] = more
                else:
                    ahead[b] = more + math.log1p(math.exp(less - more))
            carried = ahead[end - start : end - start + self.longest + 1]
        return carried[0]


def byte_pieces(char: str) -> list[str]:
    return [f"<0x{b:02X}>" for b in char.encode("utf-8", "surrogatepass")]


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x")
