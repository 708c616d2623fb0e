"""Word rules that several operators share (whole texts, null is empty)."""

from __future__ import annotations

import xxhash

# Bytes that separate words are all ASCII characters but digits
# and letters; A-Z are lower-cased; every byte of a non-ASCII character stays.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b
    if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))
WORD_PATTERN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of ASCII alphanumerics and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class HashCache(dict):
    """64-bit hashes of byte strings, remembered up to a bound."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value
