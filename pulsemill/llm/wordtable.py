"""What a worker remembers of words, bounded by bytes."""

from __future__ import annotations

#: Bytes that a table may hold in each of its two generations, and the longest word that it takes.
TABLE_BYTES = 32 << 20
LONGEST = 64
#: Bytes of an entry besides its characters: key, value and place in the table.
ENTRY_BYTES = 240


class WordTable:
    """Values of words in two generations: a full one becomes the older one, and what is found there moves up again.

    Longer words than ``LONGEST`` are not taken, and every entry counts its characters, so memory does not follow the texts.
    """

    def __init__(self, limit: int = TABLE_BYTES):
        self.limit, self.held = limit, 0
        self.known: dict = {}
        self.older: dict = {}

    def earlier(self, word: str):
        """The value of a word that is only in the older generation, or None."""
        found = self.older.get(word)
        if found is not None:
            self.add(word, found)
        return found

    def add(self, word: str, value) -> None:
        if len(word) > LONGEST:
            return
        self.held += ENTRY_BYTES + 8 * len(word)
        if self.held > self.limit:
            # The dictionary itself stays, as callers hold on to it.
            self.older = dict(self.known)
            self.known.clear()
            self.held = ENTRY_BYTES + 8 * len(word)
        self.known[word] = value
