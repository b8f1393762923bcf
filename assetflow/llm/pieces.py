"""A public piece vocabulary as byte strings, with vectorised lookup of substrings."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .words import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces of a sentencepiece model as UTF-8 (word mark U+2581 is the space byte).

    Every single byte is a piece too: the model's own piece where it has one, else its
    byte-fallback piece, whose score lies ``penalty`` below all others. So any byte
    string has a segmentation, and joining the pieces gives the bytes back.
    """

    def __init__(self, path: str, penalty: float = 10.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[bytes, int] = {}
        fallback: dict[bytes, int] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                fallback[bytes([int(sp.id_to_piece(i)[3:5], 16)])] = i
            else:
                found[sp.id_to_piece(i).replace("▁", " ").encode()] = i
        self.size = sp.get_piece_size()
        self.mark = sp.id_to_piece(0)
        low = min(sp.get_score(i) for i in found.values())
        rows = [(b, i, sp.get_score(i)) for b, i in found.items()]
        rows += [(b, i, low - penalty) for b, i in fallback.items() if b not in found]
        self.text = [b for b, _, _ in rows]
        self.ids = np.array([i for _, i, _ in rows], np.int32)
        self.scores = np.array([s for _, _, s in rows])
        self.longest = max(map(len, self.text))
        missing = [b for b in range(256) if bytes([b]) not in found and bytes([b]) not in fallback]
        if missing:
            raise ValueError(f"the vocabulary has no piece for the bytes {missing}")
        self.bytes_of = [b""] * self.size
        for b, i, _ in rows:
            self.bytes_of[i] = b
        for b, i in fallback.items():
            self.bytes_of[i] = b
        self._index()

    def _index(self) -> None:
        """Two hash tables: most pieces sit in the first, those that collide there in the second."""
        keys = np.array([self._key(b) for b in self.text], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("pieces collide under the 64-bit key")
        self.bits = 19
        self.tables = []
        rest = np.arange(len(keys))
        for salt in range(16):
            slot = self._slot(keys[rest], salt)
            _, first = np.unique(slot, return_index=True)
            key = np.zeros(1 << self.bits, np.uint64)
            row = np.full(1 << self.bits, -1, np.int32)
            key[slot[first]], row[slot[first]] = keys[rest[first]], rest[first]
            self.tables.append((key, row))
            rest = np.delete(rest, first)
            if not len(rest):
                return
        raise ValueError("the vocabulary is too large for the lookup tables")

    def _slot(self, key: np.ndarray, salt: int) -> np.ndarray:
        return (key * np.uint64(0xFF51AFD7ED558CCD + 2 * salt) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _key(piece: bytes) -> int:
        """Read from its end, as the dynamic programs extend substrings to the left."""
        h = 0
        for b in reversed(piece):
            h = (h * int(_STEP) + b + 1) & ((1 << 64) - 1)
        return int(mix(np.array([h], np.uint64))[0]) | 1

    @staticmethod
    def extend(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return h * _STEP + byte.astype(np.uint64) + np.uint64(1)

    def rows(self, h: np.ndarray) -> np.ndarray:
        """Row of the piece whose running key is ``h``, or -1."""
        key = mix(h) | np.uint64(1)
        out = np.full(len(h), -1, np.int32)
        for salt, (keys, row) in enumerate(self.tables):
            slot = self._slot(key, salt)
            hit = keys[slot] == key
            out[hit] = row[slot[hit]]
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """One table per Python worker and path."""
    return Pieces(path)


#: Items longer than this are gone through alone, by ``stretches``; a step of a few lanes costs as much as one of many.
LONG = 1024
#: Positions of a long item looked up together.
STRETCH = 1 << 13


def stretches(v: Pieces, data: np.ndarray):
    """For a long item, stretch by stretch: its first position, and the row of the piece that ends at each position
    after so many bytes before it (``[position, longest - back]``, -1: none)."""
    for a in range(0, len(data), STRETCH):
        n = min(STRETCH, len(data) - a)
        out = np.full((n, v.longest), -1, np.int32)
        h = np.zeros(n, np.uint64)
        for back in range(1, v.longest + 1):
            at = a + np.arange(n) + 1 - back
            inside = at >= 0
            h = v.extend(h, data[np.maximum(at, 0)])
            out[inside, v.longest - back] = v.rows(h[inside])
        yield a, out


def lanes(length: np.ndarray, most: int = 1 << 20, wide: int = 4096):
    """Positions of items by growing length, cut so that a block's padded size stays near ``most`` bytes."""
    order = np.argsort(length, kind="stable")
    a = 0
    while a < len(order):
        b = min(len(order), a + wide)
        while b > a + 1 and int(length[order[b - 1]]) * (b - a) > most:
            b = a + (b - a) // 2
        yield order[a:b]
        a = b


def block(data: np.ndarray, start: np.ndarray, length: np.ndarray, lead: bool) -> np.ndarray:
    """The items as rows of bytes, padded with 0; ``lead`` puts a space before each."""
    n = int(length.max(initial=0)) + lead
    out = np.zeros((len(start), n), np.uint8)
    cols = np.arange(n - lead)
    ok = cols < length[:, None]
    out[:, lead:][ok] = data[(start[:, None] + cols)[ok]]
    if lead:
        out[:, 0] = 32
    return out
