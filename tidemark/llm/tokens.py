"""Public tokenizers applied to whole texts, each distinct pre-token of a worker's texts once.

Both vocabularies merge inside pre-tokens only. A few megabytes of texts at a time are cut into
pre-tokens by vectorised comparisons of character classes; distinct pre-tokens go through the
tokenizers library and what it gives is remembered in the worker. This holds for texts whose
characters have settled classes (below U+0250, no rare white space or control characters, no
apostrophe); all other texts take the library's plain pattern.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from array import array
from functools import cache

import numpy as np

from tidemark.llm.common import alike, stretch_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the public pattern for which a plain form is known.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Entries kept by a worker before it starts anew.
REMEMBERED = 500_000


def byte_to_char() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for code points from 256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


_TO_CHAR = str.maketrans({b: c for b, c in enumerate(byte_to_char())})


def as_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHAR)


_TO_BYTE = {c: b for b, c in enumerate(byte_to_char())}


def as_bytes(token: str) -> bytes:
    """The bytes of a vocabulary entry, by the byte table in reverse; an entry with other characters is text."""
    try:
        return bytes([_TO_BYTE[c] for c in token])
    except KeyError:
        return token.encode()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _merges(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """The pair that makes each token when only merges of lower rank are known."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[at] + parts[at + 1], rank) >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges.append((as_chars(parts[0]), as_chars(parts[1])))
    return merges


# Characters below this are in normal form, lower-case one by one and have settled classes.
PLAIN_BELOW = 0x250
# U+0130 lower-cases to two characters; an apostrophe may begin a contraction.
NOT_PLAIN = re.compile(rf"[^\t\n\r -&(-~\xa1-\u012f\u0131-{chr(PLAIN_BELOW - 1)}]|<\|")
SPACE, LETTER, NUMBER, OTHER = range(4)
CLASSES = np.array(
    [
        SPACE if chr(c).isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
        for c in range(PLAIN_BELOW)
    ],
    np.uint8,
)
_RNG = np.random.default_rng(20240502)
# One value more for lower-case forms outside the table; stretches of equal hashes are compared.
_VALUES = _RNG.integers(1, 1 << 63, PLAIN_BELOW + 1, dtype=np.uint64)


class Pool:
    """Ids of remembered pre-tokens, found by their text; starts anew when full."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = array("I")
        self.ends = array("q", [0])

    def add(self, key: str, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        slot = self.slots[key] = len(self.ends) - 2
        return slot

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slots one after the other, and the place after each, from 0."""
        ids, bounds = np.array(self.ids, np.uint32), np.array(self.ends)
        begin = bounds[slots]
        length = bounds[slots + 1] - begin
        after = np.cumsum(length)
        gathered = ids[np.repeat(begin - (after - length), length) + np.arange(after[-1] if len(after) else 0)]
        return gathered, np.concatenate(([0], after))


class Vocabulary:
    """What the two kinds of tokenizers share: cut, look up, gather."""

    lower = False

    def __init__(self, model):
        self.model = model
        self.pool = Pool()

    def piece(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize(as_chars(text.encode()))]

    def whole(self, text: str) -> list[int]:
        raise NotImplementedError

    def cut(self, cls: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every whole text. Give a few megabytes at a time."""
        result: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if NOT_PLAIN.search(text):
                result[i] = np.array(self.whole(text), np.uint32)
            elif text:
                plain.append(i)
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
                result[i] = ids
        return result

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        starts, ends = self.cut(CLASSES[codes], codes, offsets)
        if self.lower:
            joined = joined.lower()
            codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        hashes = stretch_hashes(_VALUES[np.minimum(codes, PLAIN_BELOW)], starts, ends)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if not alike(codes, starts, ends, first[inverse]):
            return [np.array(self.whole(t), np.uint32) for t in texts]
        pool = self.pool
        if len(pool.slots) >= pool.limit:
            pool.clear()
        known = pool.slots
        slots = np.empty(len(first), np.int64)
        for i, (a, b) in enumerate(zip(starts[first].tolist(), ends[first].tolist(), strict=True)):
            piece = joined[a:b]
            slot = known.get(piece)
            slots[i] = pool.add(piece, self.piece(piece)) if slot is None else slot
        gathered, after = pool.gather(slots[inverse])
        edge = after[np.searchsorted(starts, offsets)]
        return [gathered[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _runs(cls: np.ndarray, offsets: np.ndarray, single: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one class inside a text; characters of class `single` stand alone."""
    new = np.ones(len(cls), bool)
    new[1:] = cls[1:] != cls[:-1]
    if single is not None:
        new |= cls == single
    new[offsets[:-1][offsets[:-1] < len(cls)]] = True
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(cls)), cls[starts]


class ByteLevel(Vocabulary):
    """Byte-level BPE by a rank file and a pre-token pattern, through the tokenizers library."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        from tokenizers.models import BPE

        ranks = read_ranks(ranks_path)
        # ignore_merges: a pre-token that is itself a token is taken whole, as rank files do
        vocabulary = {as_chars(t): r for t, r in ranks.items()}
        super().__init__(BPE(vocabulary, _merges(ranks), ignore_merges=True))
        self.pattern = regex.compile(pattern)
        self.known_pattern = pattern == KNOWN_PATTERN
        self._read_bytes(vocabulary)

    def _read_bytes(self, vocabulary: dict[str, int]) -> None:
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = as_bytes(token)
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)

    def whole(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self.piece(p)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if not self.known_pattern:
            return [np.array(self.whole(t), np.uint32) for t in texts]
        return super().encode_all(texts)

    def cut(self, cls, codes, offsets):
        """A run takes one space before it; other white space but the last character is one piece."""
        starts, ends, kind = _runs(cls, offsets, None)
        space = kind == SPACE
        at_end = np.isin(ends, offsets[1:])
        blank = codes[ends - 1] == 32
        gives = space & ~at_end & blank  # its last space goes to the next run
        alone = space & ~at_end & ~blank
        starts = starts.copy()
        starts[1:][gives[:-1]] -= 1
        ends = np.where(gives | alone, ends - 1, ends)
        last = ends[alone]
        starts, ends = np.concatenate((starts, last)), np.concatenate((ends, last + 1))
        full = starts < ends
        starts, ends = starts[full], ends[full]
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order]

    def decode(self, ids) -> bytes:
        """The bytes of the ids; a character may be split over several of them."""
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character span of each token: every character that holds one of its bytes."""
        data = np.frombuffer(text.encode(), np.uint8)
        char_of_byte = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.token_sizes[ids]) if len(ids) else np.zeros(0, np.int64)
        starts = ends - self.token_sizes[ids] if len(ids) else ends
        if not len(ids):
            return starts, ends
        return char_of_byte[starts], char_of_byte[ends - 1] + 1


class ByteLevelFile(ByteLevel):
    """Byte-level BPE of a tokenizer file without normalizer; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        Vocabulary.__init__(self, self.tokenizer.model)
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        self.known_pattern = (
            kind["normalizer"] is None
            and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        )
        self._read_bytes(self.tokenizer.get_vocab(with_added_tokens=True))

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if not self.known_pattern:
            return [np.array(self.whole(t), np.uint32) for t in texts]
        return Vocabulary.encode_all(self, texts)


class Pieces:
    """A sentencepiece model; every unit of spaces and the characters after them once.

    Merges never cross from another character to a space when no piece holds a space after one.
    Such a model encodes the units of " " + text each for itself; other models, and texts of which a
    unit does not keep its bytes, are encoded whole.
    """

    UNIT = re.compile(r" +[^ ]*")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token_bytes = [
            bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("\u2581", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)
        self.by_unit = not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.pool = Pool()
        self.lossy: set[int] = set()

    def decode(self, ids) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, before which the model puts a space. Give a few megabytes at a time."""
        if not self.by_unit:
            return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]
        pool = self.pool
        if len(pool.slots) >= pool.limit:
            pool.clear()
            self.lossy.clear()
        units = [self.UNIT.findall(" " + text) for text in texts]
        unknown = list({u for us in units for u in us if u not in pool.slots})
        for unit, ids in zip(unknown, self.model.encode([u[1:] for u in unknown], num_threads=1), strict=True):
            slot = pool.add(unit, ids)
            if self.decode(ids) != unit.encode():
                self.lossy.add(slot)
        slots = [np.fromiter(map(pool.slots.__getitem__, us), np.int64, len(us)) for us in units]
        gathered, after = pool.gather(np.concatenate(slots) if slots else np.zeros(0, np.int64))
        edge = after[np.cumsum([0, *map(len, slots)])]
        result = [gathered[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        if self.lossy:
            bad = np.fromiter(self.lossy, np.int64, len(self.lossy))
            for i, s in enumerate(slots):
                if np.isin(s, bad).any():
                    result[i] = np.array(self.model.encode(texts[i]), np.uint32)
        return result


class LowerWords(Vocabulary):
    """The lower-casing word-end BPE of a tokenizer file."""

    lower = True

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        super().__init__(self.tokenizer.model)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def cut(self, cls, codes, offsets):
        starts, ends, kind = _runs(cls, offsets, NUMBER)
        return starts[kind != SPACE], ends[kind != SPACE]


@cache
def byte_level(ranks_path: str, pattern: str) -> ByteLevel:
    return ByteLevel(ranks_path, pattern)


@cache
def byte_level_file(path: str) -> ByteLevelFile:
    return ByteLevelFile(path)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


@cache
def lower_words(path: str) -> LowerWords:
    return LowerWords(path)
