"""Dense statistics of a text, on its UTF-8 bytes with whole-buffer operations."""

from __future__ import annotations

LOWER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123)])
DIGITS = b"0123456789"
HIGH = bytes(range(128, 256))  # of non-ASCII letters and signs
PUNCTUATION = bytes(c for c in range(33, 127) if c not in LETTERS and c not in DIGITS)

#: lower case, everything that is not a letter becomes a space; bytes of non-ASCII letters stay
PLAIN = bytes(c + 32 if 65 <= c < 91 else c if 97 <= c < 123 or c >= 128 else 32 for c in range(256))

#: fixed values: digits and signs written for letters
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
REVEALED = bytes(ord(LOOKALIKES[chr(c)]) if chr(c) in LOOKALIKES else c + 32 if 65 <= c < 91 else c for c in range(256))
#: signs put between letters, deleted when look-alikes are read as letters
SEPARATORS = bytes(c for c in PUNCTUATION if chr(c) not in LOOKALIKES)


def count_of(b: bytes, kinds: bytes) -> int:
    """Number of bytes of ``b`` that are among ``kinds``."""
    return len(b) - len(b.translate(None, kinds))
