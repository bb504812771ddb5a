"""Token ids of what stands between two blanks: each distinct part of a batch is coded once.

For tokenizers that drop blanks before they look for words, so that no word and no
special token crosses one: a text's ids are those of its parts in a row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANKS = r"[\t-\r ]+"
#: What the memo of a task may hold, in bytes of words, ids and entries.
MEMO_BYTES = 96 << 20
ENTRY_BYTES = 220
#: Letters that composing leaves alone and that change case one for one, and the signs that end a word of letters.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_signs() -> list[str]:
    """The sign that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def parts_at_blanks(ids: Callable[[str], list]) -> bool:
    """Whether blanks only part words: what ``ids`` gives for words with blanks around them is what it gives for the words."""
    tries = ["a", "ab cd", "x1", "don't", "!?", "é", "日本", "́a"]
    return all(list(ids(f" {a}\t\n{b} ")) == [*ids(a), *ids(b)] for a in tries for b in tries)


class Parts:
    """Ids of parts as little-endian 32-bit bytes.

    A subclass gives ``whole``, which codes any parts, and ``words``, which codes words
    of lower-case letters in the signs that stand for their bytes. Where the two agree,
    tried on every letter, a part that is letters of ``LETTERS`` goes to ``words``,
    lowered, and signs after it are coded by themselves; all other parts go to
    ``whole``. The memo is bounded in bytes.
    """

    def __init__(self, memo_bytes: int = MEMO_BYTES):
        self.memo: dict[str, bytes] = {}
        self.held, self.most = 0, memo_bytes
        shown = byte_signs()
        self.signs = {ord(c): "".join(shown[b] for b in c.encode()) for c in map(chr, range(0xDF, 0x100)) if LETTERS.fullmatch(c)}
        self.letters = LETTERS if self._agree() else None

    def whole(self, parts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def words(self, words: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _agree(self) -> bool:
        letters = [*map(chr, range(65, 91)), *map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))]
        tries = [a + b for a in "aZßéÿÀÞ" for b in letters if LETTERS.fullmatch(b)]
        alone = self.whole([*tries, *[t + "," for t in tries], *[t + "'." for t in tries]])
        comma, dot = self.whole([",", "'."])
        n = len(tries)
        short = self.words([self._shown(t) for t in tries])
        return all(short[k] == alone[k] and alone[n + k] == alone[k] + comma and alone[2 * n + k] == alone[k] + dot for k in range(n))

    def _shown(self, word: str) -> str:
        low = word.lower()
        return low if low.isascii() else low.translate(self.signs)

    def _keep(self, parts: list[str], coded: list[bytes]) -> None:
        self.memo.update(zip(parts, coded))
        self.held += sum(map(len, parts)) + sum(map(len, coded)) + ENTRY_BYTES * len(parts)

    def look_up(self, parts: list[str]) -> list[bytes]:
        memo, letters = self.memo, self.letters
        if self.held > self.most:
            memo.clear()
            self.held = 0
        stems = [part.rstrip(SIGNS) for part in parts]
        of_letters = [letters is not None and (s.isalpha() if s.isascii() else letters.fullmatch(s) is not None) for s in stems]
        new = list({s: None for s, plain in zip(stems, of_letters) if plain and s not in memo})
        self._keep(new, self.words([self._shown(s) for s in new]))
        tails = list({p[len(s) :]: None for p, s, plain in zip(parts, stems, of_letters) if plain and len(s) < len(p) and p[len(s) :] not in memo})
        others = list({p: None for p, plain in zip(parts, of_letters) if not plain and p not in memo})
        for some in (tails, *(others[a : a + 20_000] for a in range(0, len(others), 20_000))):
            self._keep(some, self.whole(some) if some else [])
        return [
            memo[p] if not plain else memo[s] if len(s) == len(p) else memo[s] + memo[p[len(s) :]] for p, s, plain in zip(parts, stems, of_letters)
        ]

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """Of each text its ids."""
        split = pc.split_pattern_regex(texts.cast(pa.large_string()), pattern=BLANKS)
        coded = pc.dictionary_encode(pc.list_flatten(split))
        ids = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum(pc.list_value_length(split).to_numpy()).tolist()
        numbers = coded.indices.to_numpy()
        for a, b in zip([0, *ends], ends):
            yield b"".join(map(ids.__getitem__, numbers[a:b].tolist()))
