"""Operator 4: token counts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of a batch lie one after the other in a flat array of symbols.  Each round
finds the lowest merge rank of every sequence, applies that pair in all sequences at once, and
drops the sequences that have no pair left; what remains of a sequence is its token count.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import pretokens
from leafmill.llm.common import prepare, table, text_chunks

LIMIT = 2048
NONE = np.int64(1 << 40)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Counter:
    """Counts the tokens of texts for a word-end BPE vocabulary in a tokenizers JSON file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        names = byte_alphabet()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + suffix] for c in names], np.int64)
        self.size = max(vocab.values()) + 1
        rules = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in rules], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in rules], np.int64)
        first = {}
        for rank, new in enumerate(self.made.tolist()):
            first.setdefault(new, rank)
        if any(first.get(vocab[x], -1) >= rank for rank, pair in enumerate(rules) for x in pair):
            raise ValueError("a merge comes before the symbols it joins; simultaneous merging would differ")
        self.tokenizer = Tokenizer.from_file(path)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.odd_space = regex.compile(r"[\x1c-\x1f]")  # white space to str.split, not to the pattern
        self.guard = pretokens.ClassGuard()
        self.memo = pretokens.Memo()

    def normalise(self, text: str) -> str:
        """NFC, then lower case letter by letter (a sigma has one form at any place)."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text that holds no added token."""
        text = self.normalise(text)
        if self.guard.agrees(text):
            return self.pattern.findall(text)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in split]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word (a non-empty byte string)."""
        counts = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        symbols = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        symbols[ends - 1] = self.last[np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        ranks = np.full(len(symbols), NONE)
        if len(symbols) > 1:
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[ends - 1] = NONE
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(owner)))
            low = np.minimum.reduceat(ranks, starts)
            done = low == NONE
            counts[owner[starts[done]]] = sizes[done]
            if done.any():
                keep = np.repeat(~done, sizes)
                symbols, owner, ranks, low, sizes = symbols[keep], owner[keep], ranks[keep], low[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = ranks == np.repeat(low, sizes)
            if (hit[1:] & hit[:-1]).any():  # overlapping pairs of one symbol: every second one
                at = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), at, -1))
                hit &= (at - begin) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            last = ranks[at + 1] == NONE
            ranks[at] = np.where(last, NONE, 0)  # the pair to its right is the swallowed symbol's
            place = np.cumsum(keep) - 1
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            at = place[at]
            beside = np.zeros(len(symbols) + 1, bool)
            beside[at] = True
            beside[at - 1] = True  # -1 is the spare last place
            near = np.flatnonzero(beside[: len(symbols) - 1])
            same = owner[near] == owner[near + 1]
            ranks[near] = np.where(same, self.rank(symbols[near], symbols[near + 1]), NONE)
            ranks[-1] = NONE
        return counts

    def __call__(self, texts: list[str]) -> list[int]:
        """White space only separates pre-tokens, so each distinct run of other characters is counted once."""
        split, extra = [], []
        for text in texts:
            parts = self.added.split(text) if self.added and "<|" in text else [text]
            extra.append(len(parts) - 1)
            split.append([c for part in parts for c in (part.split() if not self.odd_space.search(part) else self.pieces(part))])
        missing = self.memo.missing(set().union(*split))
        if missing:
            pieces = [self.pieces(c) for c in missing]
            flat = list({p for own in pieces for p in own})
            tokens = dict(zip(flat, self.merged([p.encode() for p in flat]).tolist()))
            self.memo.update((c, tokens[own[0]] if len(own) == 1 else sum(map(tokens.__getitem__, own))) for c, own in zip(missing, pieces))
        out = [sum(map(self.memo.__getitem__, parts)) + n for parts, n in zip(split, extra)]
        self.memo.forget_long(missing)
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``; a null text is empty.

    No shuffle: one pass over the texts, each row on its own; equal rows give equal rows.
    """
    import public_tokenizers

    prepare(docs.sparkSession)
    path = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for chunk in text_chunks(batches):
            counts = count(chunk.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
