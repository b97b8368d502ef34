"""Words of texts, and a bounded memory of values by word."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

#: Latin letters and signs come before this code. Texts of these and common punctuation are
#: cut into words by plain character classes, others by Unicode properties.
LATIN = 0x250
LATIN_TEXT = re.compile(f"[\\x00-{chr(LATIN - 1)}\u2010-\u2027\u2030-\u205e\u20ac]*")
#: White space by Unicode.
BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def char_ranges(kinds: str, most: int) -> str:
    """For a character class: all characters below `most` of the general categories
    that begin with one of `kinds`."""
    return "".join(re.escape(chr(c)) for c in range(most) if unicodedata.category(chr(c))[0] in kinds)


class WordCache(dict):
    """Looks a word up, or works its value out and keeps it. Long words are not kept, and
    a full cache is emptied, so memory stays bounded whatever the texts hold."""

    def __init__(self, work: Callable, most: int = 800_000, longest: int = 48):
        super().__init__()
        self.work, self.most, self.longest = work, most, longest

    def __missing__(self, word):
        value = self.work(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value
