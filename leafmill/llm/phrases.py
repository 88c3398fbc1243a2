"""Content-defined phrases of byte strings, the unit of operator 7.

A rolling hash of ``GRAM`` bytes triggers at position t if it is the least of all grams inside
some string of ``SPAN`` bytes.  The consecutive SPAN-byte strings that choose the same trigger
form a phrase: from the first byte of the first to the last byte of the last.  Which trigger a
string chooses depends on its bytes alone, so equal strings lie in phrases with equal triggers.
"""

from __future__ import annotations

import numpy as np

from leafmill.llm.hashing import Prefixes, mix

SPAN = 200
GRAM = 40
#: Grams in a string of SPAN bytes.
WIDTH = SPAN - GRAM + 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values, by doubling."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def phrases(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Phrases of each document of ``raw``: owner, low and high (first and last string's start,
    from the start of the document), at (trigger's place), trigger and whole (hashes), step and copies.

    A phrase that follows itself at a constant distance (periodic text) is given once, with
    that distance and the number of copies.
    """
    none = {k: np.zeros(0, np.int64) for k in ("owner", "low", "high", "at", "trigger", "whole", "step", "copies")}
    if len(raw) < SPAN:
        return none
    sums = Prefixes(raw)
    starts = np.arange(len(raw) - GRAM + 1)
    gram = sums.of(starts, starts + GRAM)
    # high half: the hash; low half: the place, so that of equal grams the last is the least
    key = (gram >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - starts.astype(np.uint64))
    chosen = (0xFFFFFFFF - (sliding_least(key, WIDTH) & np.uint64(0xFFFFFFFF)).astype(np.int64))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(chosen)]
    ok = np.arange(len(chosen)) + SPAN <= offsets[1:][owner]
    if not ok.any():
        return none
    begin = np.flatnonzero(ok & np.append(True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | ~ok[:-1]))
    last = np.flatnonzero(ok & np.append((chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | ~ok[1:], True))
    own, at = owner[begin], chosen[begin]
    whole = mix(sums.of(begin, last + SPAN) + (at - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    trigger = gram[at]
    step = np.append(0, begin[1:] - begin[:-1])
    same = np.append(False, (own[1:] == own[:-1]) & (whole[1:] == whole[:-1]) & (trigger[1:] == trigger[:-1]))
    head = ~same | np.append(False, same[1:] & same[:-1] & (step[1:] != step[:-1]))
    first = np.flatnonzero(head)
    copies = np.diff(np.append(first, len(begin)))
    after = np.where(copies > 1, step[np.minimum(first + 1, len(step) - 1)], 0)
    base = offsets[:-1][own[first]]
    return {
        "owner": own[first], "low": begin[first] - base, "high": last[first] - base, "at": at[first] - base,
        "trigger": trigger[first].view(np.int64), "whole": whole[first].view(np.int64), "step": after, "copies": copies,
    }
