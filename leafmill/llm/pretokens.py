"""Pre-token splitting that agrees with the tokenizers library, at dictionary speed.

Both JSON vocabularies split a text by a regular expression before merging, so the ids of a
pre-token do not depend on its surroundings and can be remembered per distinct pre-token.
"""

from __future__ import annotations

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct pre-tokens remembered by one worker; the memory they take is bounded by this.
MEMO_ENTRIES = 900_000
#: Longer pre-tokens are worked out each time.
MEMO_CHARS = 64


class ClassGuard:
    """Tells texts whose characters `regex` and the library put in different classes.

    The two carry different Unicode versions.  Each character beyond the first blocks is
    compared once and remembered.
    """

    SAFE = 0x530

    def __init__(self):
        import regex
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.pairs = [(regex.compile(p), Split(Regex(p), "removed")) for p in (r"\p{L}", r"\p{N}", r"\s")]
        self.outside = regex.compile(rf"[^\x00-\u{self.SAFE:04x}]")
        self.known: dict[str, bool] = {}

    def agrees(self, text: str) -> bool:
        if text.isascii() or not self.outside.search(text):
            return True
        known = self.known
        for ch in set(text):
            if ord(ch) > self.SAFE:
                if ch not in known:
                    known[ch] = all(bool(r.match(ch)) == (not s.pre_tokenize_str(ch)) for r, s in self.pairs)
                if not known[ch]:
                    return False
        return True


class Memo(dict):
    """A bounded dictionary.  When it is full, the entries that the batch at hand uses stay."""

    def __init__(self, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.limit = limit

    def missing(self, wanted: set[str]) -> list[str]:
        """The keys that are not here; when there is no room for them, only wanted entries stay."""
        new = wanted - self.keys()
        if len(self) + len(new) > self.limit:
            kept = [(k, self[k]) for k in wanted - new]
            self.clear()
            self.update(kept)
        return list(new)

    def forget_long(self, keys) -> None:
        for key in keys:
            if len(key) > MEMO_CHARS:
                del self[key]

    def learn(self, more: dict) -> None:
        """Remember short keys; a full memo starts again."""
        if len(self) + len(more) > self.limit:
            self.clear()
        self.update((k, v) for k, v in more.items() if len(k) <= MEMO_CHARS)
