"""Words as runs of letters, the same on both sides of a model."""

from __future__ import annotations

import re
import sys


def _numbers_that_are_no_letters() -> str:
    """Ranges of the characters that ``\\w`` has beside letters, decimal digits and the underscore: ², ½, Ⅷ and their like."""
    found = [c for c in range(128, sys.maxunicode + 1) if chr(c).isnumeric() and not chr(c).isdecimal() and not chr(c).isalpha()]
    ranges: list[list[int]] = []
    for c in found:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in ranges)


#: Runs of letters (Unicode category L).
LETTERS = re.compile(rf"[^\W\d_{_numbers_that_are_no_letters()}]+")


def letter_words(text: str | None) -> list[str]:
    """The lower-cased runs of letters of a text, in order."""
    return LETTERS.findall((text or "").lower())
