"""Words as bytes: digits, a-z and everything beyond ASCII, A-Z lower-cased; or all between blanks."""

import re
from collections.abc import Iterator

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, in UTF-8.

    Bytes of characters beyond ASCII are all above 127, so cutting the bytes cuts the characters alike.
    """
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def blank_parts(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in parts of about so many bytes, which no word ``[^\\x20\\x09-\\x0D]+`` crosses."""
    start = 0
    while start < len(text):
        blank = _BLANK.search(text, start + size)
        end = blank.start() if blank else len(text)
        yield text[start:end]
        start = end


def blank_words(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+``, those of so many bytes of the text at a time; no word is cut."""
    for part in blank_parts(text, size):
        yield part.split()
