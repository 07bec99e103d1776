"""What Python workers that tokenise share: a bounded memory, the byte alphabet."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class Recent(dict):
    """Two generations of remembered values, bounded by bytes.

    Looking up a new key makes its value; ``fill`` makes many at once. The keys
    of one slice are all held until ``rest``, which forgets long ones and, once
    the young generation is full, the old one. ``weigh`` gives a value's bytes."""

    def __init__(self, make: Callable | None = None, limit: int = 96 << 20, longest: int = 64, overhead: int = 200,
                 weigh: Callable = len):
        super().__init__()
        self.make, self.limit, self.longest, self.overhead, self.weigh = make, limit, longest, overhead, weigh
        self.older: dict = {}
        self.size, self.long = 0, []

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        self._hold(key, value)
        return value

    def _hold(self, key, value) -> None:
        self[key] = value
        self.size += self.overhead + self.weigh(value)
        if len(key) > self.longest:
            self.long.append(key)

    def fill(self, keys: set, make_all: Callable[[list], Iterable]) -> None:
        new = keys.difference(self)
        for key in new.intersection(self.older):
            self._hold(key, self.older[key])
        made = list(new.difference(self))
        for key, value in zip(made, make_all(made)):
            self._hold(key, value)

    def rest(self) -> None:
        for key in self.long:
            self.size -= self.overhead + self.weigh(self.pop(key))
        self.long = []
        if self.size > self.limit:
            self.older, self.size = dict(self), 0
            self.clear()


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others are numbered from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


_LETTERS = {b: c for c, b in byte_alphabet().items()}


def byte_level(word: str) -> str:
    """The word's UTF-8 bytes as characters of the byte-level alphabet."""
    return word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(_LETTERS)
