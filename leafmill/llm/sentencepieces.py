"""Operator 1: SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary file at hand is a merge (BPE) model.  For such a model the best path to a
boundary is the merge result of the text before it, and it has one last piece: the piece whose
join with the best path before it stays apart under the merge rules.  The search therefore keeps
a backpointer for each of the last ``longest piece`` boundaries.  Whenever the paths from all of
them pass through one boundary, the ids before it are final and leave the window.

Most texts offer such a boundary at every word: no piece joins the character classes on its two
sides.  The segments between are searched once and remembered; a segment of any length passes
through the same bounded window.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import pretokens
from leafmill.llm.common import prepare, table, text_chunks

SPACE = "▁"


class Model:
    """Pieces of a SentencePiece merge model with identity normalisation and byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        if lib.encode("a  b ÅＡ", out_type=str) and lib.normalize("a  b ÅＡ ") != SPACE + "a  b ÅＡ ".replace(" ", SPACE):
            raise ValueError("only models with identity normalisation and a leading blank are supported")
        ids = range(lib.get_piece_size())
        special = {i for i in ids if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.ids = {lib.id_to_piece(i): i for i in ids if i not in special}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        byte_of = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.out = [byte_of[i] if i in byte_of else lib.id_to_piece(i).replace(SPACE, " ").encode() if i not in special else b"" for i in ids]
        self.apart: dict[tuple[str, str], bool] = {}
        self.memo = pretokens.Memo()
        figures = "\\d_\u00b2\u00b3\u00b9\u00bc-\u00be"
        letters, others = re.compile(rf"[^\W{figures}]+"), re.compile(rf"(?:[{figures}]|[^\w{SPACE}\n])+")
        self.split = re.compile(rf"{SPACE}*{letters.pattern}|{SPACE}*{others.pattern}|{SPACE}*\n|{SPACE}+")
        known = (p.lstrip(SPACE) for p in self.ids)
        self.segmented = all(not p or letters.fullmatch(p) or others.fullmatch(p) for p in known)

    def stays_apart(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` ends with these two pieces."""
        key = (a, b)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > 500_000:
                self.apart.clear()
            found = self.apart[key] = self.merge(a + b) == [a, b]
        return found

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours until none are left."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stream(self, text: str) -> Iterator[list[str]]:
        """Runs of final pieces of a text, as the paths in the window meet."""
        ids, longest, n = self.ids, self.longest, len(text)
        last: dict[int, str] = {}  # boundary -> last piece of the best path to it
        done, check = 0, 4 * longest
        for end in range(1, n + 1):
            chosen = text[end - 1]
            for size in range(min(longest, end - done), 0, -1):
                piece = text[end - size : end]
                if piece in ids or size == 1:
                    start = end - size
                    if start == done and done == 0 or self._follows(last.get(start), piece):
                        chosen = piece
                        break
            last[end] = chosen
            if end - done >= check and end < n:
                meet = self._meet(last, end, done)
                if meet > done:
                    yield self._path(last, meet, done)
                    # the piece that ends at the meeting point decides what may follow it
                    last = {at: piece for at, piece in last.items() if at >= meet}
                    done = meet
                    check = 4 * longest
                else:
                    check *= 2
        if n > done:
            yield self._path(last, n, done)

    def _follows(self, before: str | None, piece: str) -> bool:
        return before is not None and self.stays_apart(before, piece)

    def _meet(self, last: dict[int, str], end: int, done: int) -> int:
        """The latest boundary on the paths from every boundary that a later piece can start at."""
        open_ends = set(range(max(done + 1, end - self.longest + 1), end + 1))
        while len(open_ends) > 1:
            top = max(open_ends)
            open_ends.remove(top)
            open_ends.add(top - len(last[top]))
            if min(open_ends) <= done:
                return done
        return open_ends.pop()

    @staticmethod
    def _path(last: dict[int, str], end: int, done: int) -> list[str]:
        pieces = []
        while end > done:
            pieces.append(last[end])
            end -= len(last[end])
        return pieces[::-1]

    def to_ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.ids.get(p)
            if i is None:
                out.extend(self.bytes[b] for b in p.encode("utf-8", "surrogatepass"))
            else:
                out.append(i)
        return out

    def segment(self, text: str) -> bytes:
        return np.array([i for pieces in self.stream(text) for i in self.to_ids(pieces)], np.uint32).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        texts = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        if not self.segmented:
            return [self.segment(t) for t in texts]
        split = [self.split.findall(t) for t in texts]
        missing = self.memo.missing(set().union(*split))
        self.memo.update((s, self.segment(s)) for s in missing)
        out = [b"".join(map(self.memo.__getitem__, parts)) for parts in split]
        self.memo.forget_long(missing)
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.out.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode_column(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """All columns of ``docs`` and ``piece_ids`` (ids as little-endian uint32 bytes)."""
    import public_tokenizers

    prepare(docs.sparkSession)
    path = public_tokenizers.path(tokenizer)
    schema = docs.drop("piece_ids").withColumn("piece_ids", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for chunk in text_chunks(batches):
            ids = m.encode([t or "" for t in chunk.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(ids, pa.binary())], [*chunk.schema.names, "piece_ids"])

    return docs.drop("piece_ids").mapInArrow(run, schema)


def decode_column(frame: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """``frame`` with ``decoded``: the text of ``piece_ids``."""
    import public_tokenizers

    path = public_tokenizers.path(tokenizer)
    schema = frame.drop("decoded").withColumn("decoded", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for chunk in text_chunks(batches, "piece_ids", 1 << 21):
            texts = [m.decode(np.frombuffer(raw or b"", np.uint32)) for raw in chunk.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(texts, pa.string())], [*chunk.schema.names, "decoded"])

    return frame.drop("decoded").mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """All columns of ``docs``, ``piece_ids`` and ``decoded``, in one pass of one worker.

    What a task remembers is dropped at its end, so that workers that go on to other operators
    hold only the vocabulary.
    """
    import public_tokenizers

    prepare(docs.sparkSession)
    path = public_tokenizers.path(tokenizer)
    given = docs.drop("piece_ids", "decoded")
    schema = given.withColumns({"piece_ids": F.lit(b""), "decoded": F.lit("")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        try:
            for chunk in text_chunks(batches):
                ids = m.encode([t or "" for t in chunk.column("text").to_pylist()])
                texts = [m.decode(np.frombuffer(raw, np.uint32)) for raw in ids]
                yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(ids, pa.binary()), pa.array(texts, pa.string())], [*chunk.schema.names, "piece_ids", "decoded"])
        finally:
            m.memo.clear()

    return given.mapInArrow(run, schema)


def sentencepieces(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """Encode and decode every text: doc_id, n_pieces, ids_crc32, decoded_crc32, round_trip.

    ``ids_crc32`` is over all ids as little-endian unsigned 32-bit integers, ``decoded_crc32``
    over the UTF-8 bytes of the decoded text; ``round_trip`` says that decoding gave the text
    back.  A null text is empty and has no pieces.  One pass, no shuffle; equal rows stay rows.
    A text that holds the blank marker U+2581 itself decodes to a blank there.
    """
    import public_tokenizers

    prepare(docs.sparkSession)
    path = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for chunk in text_chunks(batches):
            texts = [t or "" for t in chunk.column("text").to_pylist()]
            ids = m.encode(texts)
            decoded = [m.decode(np.frombuffer(raw, np.uint32)) for raw in ids]
            columns = [
                chunk.column("doc_id"),
                pa.array([len(raw) // 4 for raw in ids], pa.int64()),
                pa.array([zlib.crc32(raw) for raw in ids], pa.int64()),
                pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()),
                pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids_crc32", "decoded_crc32", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces(table(spark, sf_dir, "documents"))
