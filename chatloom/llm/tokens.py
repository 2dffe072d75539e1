"""Token ids of a published byte-level BPE vocabulary, many texts at a time."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

# Fixed value: the split pattern of this kind of vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Unicode white space, as the pattern's \s has it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Words remembered by one Python worker; beyond that the memory is emptied.
KNOWN_WORDS = 400_000
# Text bytes turned into ids at once.
BLOCK_BYTES = 4 << 20


def _byte_values() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones
    for themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them for the file.

    Strings of the file's added tokens are these tokens if ``special``, as in a
    tokenizer as it is loaded, and ordinary text otherwise. Texts are cut before single spaces, where the split pattern cuts too. Every
    distinct piece is encoded once and its ids are remembered. A text with white
    space before a space could be cut elsewhere and is encoded in one go.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary = told["model"]["vocab"]
        self.added: dict[str, int] = {}
        for token in told["added_tokens"] if special else []:
            if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("an added token takes more than its own string")
            self.added[token["content"]] = token["id"]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.adding = "|".join(map(re.escape, longest_first))
        values = _byte_values()
        ranks = {
            bytes(values[c] for c in token): number
            for token, number in vocabulary.items()
            if all(c in values for c in token)
        }
        # The file may list a special token among its words; it is no merge.
        ranks = {token: n for token, n in ranks.items() if not token.startswith(b"<|endof")}
        self.core = tiktoken.Encoding(
            "published", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.ranks = ranks
        self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, number in ranks.items():
            self.widths[number] = len(token)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def surfaces(self) -> list[bytes]:
        """The bytes of every id that ordinary text can have."""
        out = [b""] * len(self.widths)
        for token, number in self.ranks.items():
            out[number] = token
        return out

    def one(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, disallowed_special=())

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text that may hold added tokens: these stand between other parts."""
        if not self.added:
            return self.one(text)
        parts = re.split(f"({self.adding})", text)
        ids = [
            np.array([self.added[part]], dtype=np.uint32) if place % 2 else self.one(part)
            for place, part in enumerate(parts)
        ]
        return np.concatenate(ids).astype(np.uint32)

    def learn(self, words: list[str]) -> None:
        """Remember the ids of new words, by one call for all of them."""
        # A line feed between two words is always a token of its own, unless a
        # word itself begins or ends in white space other than one space.
        joint, single = [], []
        for word in words:
            inner = word[1:] if word[:1] == " " else word
            (joint if inner and not inner[0].isspace() and not inner[-1].isspace() else single).append(word)
        ids = self.one("\n".join(joint)) if joint else self.ids[:0]
        begins = np.concatenate([[0], np.cumsum(self.widths[ids])])
        sizes = np.fromiter((len(w.encode()) for w in joint), dtype=np.int64, count=len(joint))
        at = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        first, last = np.searchsorted(begins, at), np.searchsorted(begins, at + sizes)
        if len(joint) and not (begins[first] == at).all():
            raise AssertionError("a token spans two words")
        alone = [self.one(w) for w in single]
        base = len(self.ids)
        tail = base + len(ids) + np.concatenate([[0], np.cumsum([len(x) for x in alone])])[:-1]
        for word in (*joint, *single):
            self.known[word] = len(self.known)
        self.ids = np.concatenate([self.ids, ids, *alone]).astype(np.uint32)
        self.starts = np.concatenate([self.starts, base + first, tail]).astype(np.int64)
        self.lengths = np.concatenate(
            [self.lengths, last - first, [len(x) for x in alone]]
        ).astype(np.int64)

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.learn(new)
        return np.fromiter((self.known[w] for w in words), dtype=np.int64, count=len(words))

    def regular(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts in which no white space stands before a space."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        coded = parts.flatten().dictionary_encode()
        words = [" " + w for w in coded.dictionary.to_pylist()]
        numbers = self._numbers(words)[coded.indices.to_numpy()]
        # The first part of a text has no space before it.
        firsts = [w for w in pc.list_element(parts, 0).to_pylist()]
        numbers[bounds[:-1]] = self._numbers(firsts)
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        ids = self.ids[shift + np.arange(len(shift))]
        cuts = np.concatenate([[0], ends])[bounds]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; a null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, f"[{SPACE}] ").to_numpy(zero_copy_only=False)
        for token in self.added:
            odd = odd | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = self.whole(texts[i].as_py())
        plain = np.flatnonzero(~odd)
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)[plain]
        blocks = np.cumsum(sizes) // BLOCK_BYTES
        for own in np.split(plain, np.flatnonzero(np.diff(blocks)) + 1) if len(plain) else []:
            for i, ids in zip(own, self.regular(texts.take(pa.array(own)))):
                out[i] = ids
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """One encoder per file, reading of added tokens, and Python worker."""
    if (path, special) not in _encoders:
        _encoders[path, special] = Encoder(path, special)
    return _encoders[path, special]
