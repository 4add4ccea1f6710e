"""Words of a text as runs of letters and digits, shared by the operators that read words."""

from __future__ import annotations

#: A-Z lower-cased; every other ASCII byte that is neither a digit nor a letter is a blank. Bytes from
#: 128 on are parts of other letters.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def words(text: str | None) -> list[bytes]:
    """The maximal runs of characters that are no ASCII sign, blank or control, in UTF-8."""
    return (text or "").encode().translate(_FOLD).split()
