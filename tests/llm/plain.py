"""Word hashes, n-grams and scores in plain Python, from their definitions; nothing of the tested modules is used."""

import re

M = (1 << 64) - 1


def mix(h):
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & M
    h ^= h >> 29
    h = h * 0xD6E8FEB86659FD93 & M
    return h ^ h >> 32


def word_hash(word: bytes) -> int:
    """A polynomial in the bytes plus one, ASCII letters in lower case, mixed."""
    h = 0
    for i, b in enumerate(word):
        b += 32 * (0x41 <= b <= 0x5A)
        h = (h + (b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64)) & M
    return mix(h)


def pair_hash(a: int, b: int) -> int:
    return mix((a * 0x9FB21C651E98DF25 + b) & M)


def runs(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII bytes, and runs of other marks."""
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", text.lower().encode())


def only_words(text: str) -> list[bytes]:
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())
