"""Ids of a published SentencePiece BPE vocabulary, by vectorised merge rounds."""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

MARK = "▁"
# Symbols of single characters that are no piece: this plus the code point.
_BASE = 1 << 18
_SHIFT = np.int64(1) << 21
_NEVER = np.int32(2**31 - 1)
# Words with more characters are cut where no piece crosses.
LONG = 64
# A segment still longer than that is merged by a heap, one pair at a time.
LONGEST = 512
# Words remembered by one Python worker, and their characters; beyond that the
# memory is emptied.
KNOWN_WORDS, KNOWN_CHARACTERS = 200_000, 8_000_000
# Text bytes turned into ids at once.
BLOCK_BYTES = 4 << 20
# Encoded by both sides when a vocabulary is opened.
PROBES = ("", " ", "a", " two  words ", "ﬁ Ⅷ é é", "\t\n\r\0", "x" * 40, "日本 𝒜<s><0x41>")


class PieceEncoder:
    """What the sentencepiece library's encode and decode give for a BPE model.

    Words (runs of the word mark with what follows) are merged each on their own,
    which is exact as no piece has the mark behind another character. In a round
    every word of a batch finds its pair of lowest rank by a segmented minimum over
    one flat array, merges all its places of that pair, leftmost first, and the
    array is compacted; words without a pair leave. Distinct words are merged once
    and remembered.

    The library merges one pair at a time. That comes to the same unless a merge
    makes a new pair of the same or a lower rank; words with such a pair ("inverted")
    and segments beyond ``LONGEST`` characters are merged in the library's order.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.surfaces: list[bytes] = []
        normal = []
        for number, name in enumerate(names):
            if model.is_byte(number):
                self.byte_ids[int(name[3:5], 16)] = number
                self.surfaces.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(number):
                self.surfaces.append(b"")
            elif model.is_unknown(number):
                self.surfaces.append(" ⁇ ".encode())
            else:
                self.surfaces.append(name.replace(MARK, " ").encode())
                normal.append(number)
        self.is_byte = np.array([model.is_byte(i) for i in range(count)])
        self.is_control = np.array([model.is_control(i) for i in range(count)])
        self.plain = {names[i]: i for i in normal}
        self.mark_led = {i for i in normal if names[i].startswith(MARK)}
        self.unknown = model.unk_id()
        self.falls_back = bool(self.is_byte.any())
        if any(MARK in name.lstrip(MARK) for name in self.plain):
            raise ValueError("a piece has the word mark behind another character")
        self._tables([model.get_score(i) for i in range(count)])
        self.digits = np.array([str(i) for i in range(count)], dtype=object)
        self.forget()
        for probe in PROBES:
            if self.flat(pa.array([probe]))[0].tolist() != model.encode(probe):
                raise ValueError("the vocabulary is no plain BPE with a leading word mark")

    def _symbol(self, text: str) -> int | None:
        if text in self.plain:
            return self.plain[text]
        return _BASE + ord(text) if len(text) == 1 else None

    def _tables(self, scores: list[float]) -> None:
        """Pairs that merge, their pieces and ranks; adjacent characters of pieces."""
        ordered = sorted({-scores[i] for i in self.plain.values()})
        place = {score: rank for rank, score in enumerate(ordered)}
        self.ranks = np.full(len(scores) + 1, _NEVER, dtype=np.int32)
        for number in self.plain.values():
            self.ranks[number] = place[-scores[number]]
        self.first_symbols = np.arange(0x110000, dtype=np.int32) + _BASE
        pairs, beside = {}, set()
        for text, number in self.plain.items():
            if len(text) == 1:
                self.first_symbols[ord(text)] = number
            for cut in range(1, len(text)):
                beside.add(ord(text[cut - 1]) << 21 | ord(text[cut]))
                left, right = self._symbol(text[:cut]), self._symbol(text[cut:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = number
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.pairs = pairs
        self.beside = np.array(sorted(beside), dtype=np.int64)
        # A part made by a merge (not a character) whose rank isn't below the whole's.
        many = {i for text, i in self.plain.items() if len(text) > 1}
        self.inverted = np.array(
            [
                any(s in many and self.ranks[s] >= self.ranks[n] for s in (k >> 21, k & 0x1FFFFF))
                for k, n in zip(self.keys.tolist(), self.merged.tolist())
            ],
            dtype=bool,
        )

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece of every pair, -1 without one, and whether the pair is inverted."""
        if not len(self.keys):
            return np.full(len(left), -1, dtype=np.int32), np.zeros(len(left), dtype=bool)
        key = left.astype(np.int64) * _SHIFT + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.merged[at], np.int32(-1)), hit & self.inverted[at]

    def _segments(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Segment number of every character: words, the long ones cut further."""
        starts = np.zeros(len(codes), dtype=bool)
        begins = np.cumsum(sizes) - sizes
        starts[begins] = True
        for word in np.flatnonzero(sizes > LONG):
            own = codes[begins[word] : begins[word] + sizes[word]].astype(np.int64)
            key = own[:-1] * _SHIFT + own[1:]
            at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            starts[begins[word] + 1 : begins[word] + sizes[word]] = self.beside[at] != key
        return np.cumsum(starts) - 1

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """Merges in the library's order: lowest rank first, then leftmost."""
        ranks, pairs = self.ranks, self.pairs
        before = list(range(-1, len(symbols) - 1))
        after = [*range(1, len(symbols)), -1]
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            whole = pairs.get(symbols[left] << 21 | symbols[right])
            if whole is not None:
                heapq.heappush(heap, (int(ranks[whole]), left, symbols[left], symbols[right]))

        for left in range(len(symbols) - 1):
            offer(left, left + 1)
        while heap:
            _, left, one, other = heapq.heappop(heap)
            right = after[left]
            # A symbol that was merged away is -1; one that grew is another.
            if symbols[left] != one or right < 0 or symbols[right] != other:
                continue
            symbols[left] = pairs[one << 21 | other]
            symbols[right] = -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s >= 0]

    def _rounds(
        self, symbols: np.ndarray, segments: np.ndarray
    ) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """(place, segment, symbol) arrays of what is done; the segments left undone
        because of an inverted pair."""
        done, odd = [], []
        places = np.arange(len(symbols))
        pair = np.full(len(symbols), -1, dtype=np.int32)
        twisted = np.zeros(len(symbols), dtype=bool)
        fresh = np.flatnonzero(segments[:-1] == segments[1:])
        while len(symbols):
            pair[fresh], twisted[fresh] = self._look_up(symbols[fresh], symbols[fresh + 1])
            rank = self.ranks[pair]
            first = np.flatnonzero(np.diff(segments, prepend=-1))
            sizes = np.diff(first, append=len(segments))
            least = np.minimum.reduceat(rank, first)
            crossed = np.logical_or.reduceat(twisted, first)
            if crossed.any():
                odd.append(segments[first[crossed]])
            ended = (least == _NEVER) & ~crossed
            if ended.any():
                out = np.repeat(ended, sizes)
                done.append((places[out], segments[out], symbols[out]))
            stay = np.repeat(~(ended | crossed), sizes)
            goal = np.repeat(least, sizes)[stay]
            symbols, segments, places = symbols[stay], segments[stay], places[stay]
            pair, twisted, rank = pair[stay], twisted[stay], rank[stay]
            at = np.flatnonzero(rank == goal)
            if not len(at):
                break
            # Of places that overlap in a row every second one merges, from the left.
            head = np.diff(at, prepend=-2) != 1
            at = at[(at - np.repeat(at[head], np.diff(np.flatnonzero(head), append=len(at)))) % 2 == 0]
            # Two neighbours merge in one round: in between, the first meets the
            # second's left part.
            beside = np.flatnonzero(np.diff(at) == 2)
            beside = beside[segments[at[beside]] == segments[at[beside + 1]]]
            _, met = self._look_up(pair[at[beside]], symbols[at[beside + 1]])
            held = np.unique(segments[at[beside[met]]])
            symbols[at] = pair[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            if len(held):
                out = np.isin(segments, held)
                odd.append(held)
                keep &= ~out
                at = at[~out[at]]
            moved = np.cumsum(keep) - 1
            symbols, segments, places = symbols[keep], segments[keep], places[keep]
            pair, twisted = pair[keep], twisted[keep]
            at = moved[at]
            changed = np.zeros(len(symbols), dtype=bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            fresh = np.flatnonzero(changed)
            pair[fresh], twisted[fresh] = -1, False
            fresh = fresh[fresh < len(symbols) - 1]
            fresh = fresh[segments[fresh] == segments[fresh + 1]]
        return done, np.concatenate(odd) if odd else np.zeros(0, dtype=np.int64)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        if not len(codes):
            return np.zeros(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        segments = self._segments(codes, sizes)
        symbols = self.first_symbols[codes]
        del codes
        long = np.bincount(segments) > LONGEST
        short = np.flatnonzero(~long[segments])
        done, odd = self._rounds(symbols[short], segments[short])
        parts = [(short[p], symbol) for p, _, symbol in done]
        for segment in (*np.flatnonzero(long), *odd):
            start, end = np.searchsorted(segments, [segment, segment + 1])
            alone = self._one_by_one(symbols[start:end].tolist())
            parts.append((np.arange(start, start + len(alone)), np.array(alone, dtype=np.int32)))
        place = np.concatenate([p for p, _ in parts])
        symbol = np.concatenate([s for _, s in parts])
        order = np.argsort(place, kind="stable")
        place, symbol = place[order], symbol[order]
        word = np.repeat(np.arange(len(words)), sizes)[place]
        ids, widths = self._spelled(symbol)
        return ids, np.bincount(word, widths, minlength=len(words)).astype(np.int64)

    def _spelled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many each symbol gave: characters without a piece are bytes."""
        widths = np.ones(len(symbols), dtype=np.int64)
        strange = np.flatnonzero(symbols >= _BASE)
        if not len(strange):
            return symbols, widths
        if not self.falls_back:
            return np.where(symbols >= _BASE, self.unknown, symbols).astype(np.int32), widths
        values, which = np.unique(symbols[strange], return_inverse=True)
        spelled = [self.byte_ids[list(chr(v - _BASE).encode())] for v in values.tolist()]
        own = np.array([len(s) for s in spelled])
        widths[strange] = own[which]
        ids = np.repeat(symbols, widths)
        ids[np.repeat(symbols >= _BASE, widths)] = np.concatenate([spelled[i] for i in which])
        return ids, widths

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Places of words in the memory, after merging the new ones."""
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            ids, lengths = self.merge(new)
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            for word in new:
                self.known[word] = len(self.known)
            self.characters += sum(map(len, new))
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
        return np.fromiter((self.known[w] for w in words), dtype=np.int64, count=len(words))

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Memory places of all words in a row, and how many words each text has."""
        blank = pc.equal(texts, "")
        odd = pc.match_substring_regex(texts, f"^ |  |{MARK}").to_numpy(zero_copy_only=False)
        usual = pc.if_else(pc.or_(blank, pa.array(odd)), "", texts)
        parts = pc.split_pattern(usual, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        numbers = self._numbers([MARK + w for w in coded.dictionary.to_pylist()])
        numbers = numbers[coded.indices.to_numpy()]
        if not odd.any() and not pc.any(blank).as_py():
            return numbers, counts
        # Each blank or odd text left one empty word, which gives way.
        bounds = np.cumsum(counts) - counts
        pieces = []
        for i, text in enumerate(texts.to_pylist()):
            if odd[i]:
                cut = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
                pieces.append(self._numbers(cut))
                counts[i] = len(cut)
            elif not text:
                counts[i] = 0
            else:
                pieces.append(numbers[bounds[i] : bounds[i] + counts[i]])
        return np.concatenate([np.zeros(0, dtype=np.int64), *pieces]), counts

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each; a null counts as empty."""
        if len(self.known) > KNOWN_WORDS or self.characters > KNOWN_CHARACTERS:
            self.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        numbers, counts = self._words(texts)
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        ids = self.ids[shift + np.arange(len(shift))]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, bounds

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of ids: the word mark is a space, the first one goes, and
        bytes that are no character are replaced one by one."""
        listed = ids.tolist()
        parts = list(map(self.surfaces.__getitem__, listed))
        first = next((i for i, part in enumerate(parts) if part), 0)
        if listed and listed[first] in self.mark_led:
            parts[first] = parts[first][1:]
        joined = b"".join(parts)
        if not self.is_control[ids].any():
            try:
                joined.decode()
                return joined
            except UnicodeDecodeError:
                pass
        return _repaired(parts, self.is_byte[ids])


def _repaired(parts: list[bytes], is_byte: np.ndarray) -> bytes:
    out, at = [], 0
    while at < len(parts):
        end = at + 1
        if is_byte[at]:
            while end < len(parts) and is_byte[end]:
                end += 1
            run = b"".join(parts[at:end])
            while run:
                size = next((n for n in range(1, 5) if _is_character(run[:n])), 0)
                out.append(run[:size] if size else "�".encode())
                run = run[max(size, 1) :]
        else:
            out.append(parts[at])
        at = end
    return b"".join(out)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def blocks_of(sizes: np.ndarray, most: int = BLOCK_BYTES) -> list[np.ndarray]:
    """Places of neighbouring texts that make up about ``most`` bytes together."""
    turn = np.cumsum(sizes, dtype=np.int64) // most
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(turn)) + 1) if len(sizes) else []


_encoders: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per file and Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
