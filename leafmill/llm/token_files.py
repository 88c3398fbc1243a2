"""Operator 2: token ids in a bit-packed binary format, and its reader.

A shard holds a run of documents in ascending order::

    magic "LMTP" | u32 bits | u64 documents | u64 blocks | u64 words
    i64 doc_id[documents] | u8 has_id[documents] | u64 end[documents]
    u64 word_offset[blocks + 1]
    u64 words[...]

``end`` is the number of ids up to and with each document.  Ids are cut into blocks of
``BLOCK`` ids; every block starts at a word of its own, so any block is unpacked alone with
whole-array numpy operations.  Ids take the fewest bits that hold the vocabulary.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import pretokens
from leafmill.llm.common import fresh_path, prepare, table, text_chunks

MAGIC = b"LMTP"
HEAD = struct.Struct("<4sIQQQ")
#: Ids in a block: a multiple of 64, so that a block of any width fills whole words.
BLOCK = 4096
END_ID = 0
#: Bytes of text whose chunks are looked up together.
TOGETHER = 4 << 20
#: ASCII white space beside blanks and newlines.
OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids to 64-bit words, ``bits`` bits each, low bits first.  The last word is padded."""
    ids = ids.astype(np.uint64)
    at = np.arange(len(ids), dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    words = np.zeros((len(ids) * bits + 63) // 64 + 1, np.uint64)
    np.bitwise_or.at(words, word, ids << shift)
    over = shift + np.uint64(bits) > 64
    np.bitwise_or.at(words, word[over] + 1, ids[over] >> (np.uint64(64) - shift[over]))
    return words[:-1]


def unpack(words: np.ndarray, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on."""
    padded = np.append(words, np.uint64(0))
    at = np.arange(first, first + count, dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = padded[word] >> shift
    high = np.where(shift > 0, padded[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return ((low | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _fs(uri: str):
    """(file system, path) for a URI of the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("/") else fs.FileSystem.from_uri(f"file://{uri.removeprefix('file:')}")


def write_shard(uri: str, docs: list[tuple[int | None, bytes]], bits: int) -> None:
    """Write (doc_id, ids as uint32 bytes) rows as one shard."""
    ends = np.cumsum([len(raw) // 4 for _, raw in docs], dtype=np.uint64)
    ids = np.frombuffer(b"".join(raw for _, raw in docs), np.uint32)
    blocks = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)], dtype=np.uint64)
    filesystem, path = _fs(uri)
    with filesystem.open_output_stream(path) as out:
        out.write(HEAD.pack(MAGIC, bits, len(docs), len(blocks), int(offsets[-1])))
        out.write(np.array([d or 0 for d, _ in docs], np.int64).tobytes())
        out.write(np.array([d is not None for d, _ in docs], np.uint8).tobytes())
        out.write(ends.tobytes())
        out.write(offsets.tobytes())
        for block in blocks:
            out.write(block.tobytes())


class Shard:
    """Random access to the ids of a shard: reads its index once, then only the blocks asked for."""

    def __init__(self, uri: str):
        filesystem, path = _fs(uri)
        self.file = filesystem.open_input_file(path)
        magic, self.bits, n, blocks, _ = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        at = HEAD.size
        self.doc_ids = np.frombuffer(self.file.read_at(8 * n, at), np.int64)
        self.has_id = np.frombuffer(self.file.read_at(n, at + 8 * n), np.uint8)
        self.ends = np.frombuffer(self.file.read_at(8 * n, at + 9 * n), np.uint64).astype(np.int64)
        self.offsets = np.frombuffer(self.file.read_at(8 * (blocks + 1), at + 17 * n), np.uint64).astype(np.int64)
        self.data = at + 17 * n + 8 * (blocks + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids in [start, stop) of the shard."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        raw = self.file.read_at(8 * int(self.offsets[last + 1] - self.offsets[first]), self.data + 8 * int(self.offsets[first]))
        return unpack(np.frombuffer(raw, np.uint64), self.bits, start - first * BLOCK, stop - start)

    def document(self, row: int) -> np.ndarray:
        return self.ids(int(self.ends[row - 1]) if row else 0, int(self.ends[row]))

    def close(self) -> None:
        self.file.close()


class Encoder:
    """Ids of whole texts as the library gives them, each distinct chunk encoded once.

    Where no two white-space characters are neighbours, pre-tokens never cross a blank or a
    newline, and a blank belongs to the pre-token after it.  Such texts are cut before blanks and
    newlines and the ids of a chunk are remembered; other texts are cut by the pre-token pattern.
    """

    def __init__(self, path: str):
        import re

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.space_pair = re.compile(r"\s\s|[\x1c-\x1f]")
        # a token of the byte-level alphabet has a character for each byte
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(names.values()) + 1, np.int64)
        self.sizes[list(names.values())] = list(map(len, names))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.guard = pretokens.ClassGuard()
        self.bare, self.memo = pretokens.Memo(pretokens.MEMO_ENTRIES // 4), pretokens.Memo()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special) or not self.guard.agrees(text):
                out[i] = self._library([text])[0]
            elif self._spaces_meet(text):
                out[i] = self._by_pattern(text)
            else:
                plain.append(i)
        for i, raw in zip(plain, self._by_chunks([texts[i] for i in plain])):
            out[i] = raw
        return out

    def _spaces_meet(self, text: str) -> bool:
        """Whether white-space characters are neighbours; most texts have only blanks and newlines, and no pair of them."""
        if text.isascii() and not any(c in text for c in OTHER_SPACES) and not any(p in text for p in ("  ", "\n\n", " \n", "\n ")):
            return False
        return self.space_pair.search(text) is not None

    def _by_pattern(self, text: str) -> bytes:
        parts = self.pattern.findall(text)
        known = list(map(self.bare.get, parts))
        if None in known:
            missing = list({p for p, v in zip(parts, known) if v is None})
            more = dict(zip(missing, self._library(missing)))
            known = [more[p] if v is None else v for p, v in zip(parts, known)]
            self.bare.learn(more)
        return b"".join(known)

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are cut before blanks and newlines: a chunk is looked up once for all of them."""
        words = pc.split_pattern(pa.array([t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        offsets = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy().astype(np.int64)
        # the first chunk of a text has no blank before it
        firsts = [chunks[i] for i in index[offsets[:-1]].tolist()]
        values = list(map(self.memo.get, chunks))
        missing = [c for c, v in zip(chunks, values) if v is None]
        more = dict(zip(missing, self._run_on(missing)))
        values = [more[c] if v is None else v for c, v in zip(chunks, values)]
        heads = [f for f in dict.fromkeys(firsts) if f and f not in self.bare]
        head = dict(zip(heads, self._library(heads)))
        index[offsets[:-1]] = np.arange(len(firsts)) + len(values)
        values += [b"" if not f else head[f] if f in head else self.bare[f] for f in firsts]
        self.memo.learn(more)
        self.bare.learn(head)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        begin, own = np.cumsum(sizes) - sizes, sizes[index]
        ends = np.append(0, np.cumsum(own))
        ids = np.frombuffer(b"".join(values), np.uint32)[np.arange(ends[-1]) + np.repeat(begin[index] - ends[:-1], own)]
        raw, cuts = ids.tobytes(), (4 * ends[offsets]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _run_on(self, chunks: list[str], together: int = 64) -> list[bytes]:
        """Ids of chunks, a blank before each that begins no line: many as one text, cut again by the bytes of the tokens."""
        alone = {c: self._library([c or " "])[0] for c in {"", "\n"} & set(chunks)}
        run = [c for c in chunks if c not in alone]
        if not run:
            return [alone[c] for c in chunks]
        parts = [c if c[0] == "\n" else " " + c for c in run]
        found = self._library(["".join(parts[i : i + together]) for i in range(0, len(parts), together)])
        raw = b"".join(found)
        ends = np.cumsum(self.sizes[np.frombuffer(raw, np.uint32)])
        stops = np.cumsum(np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in parts), np.int64, len(parts)))
        at = np.searchsorted(ends, stops)
        if len(ends) == 0 or at[-1] == len(ends) or not np.array_equal(ends[at], stops):  # a vocabulary without all bytes
            return [alone[c] if c in alone else self._library([c if c[0] == "\n" else " " + c])[0] for c in chunks]
        cuts = [0, *(4 * (at + 1)).tolist()]
        out = alone | dict(zip(run, (raw[a:b] for a, b in zip(cuts, cuts[1:]))))
        return [out[c] for c in chunks]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


SHARD_SCHEMA = "uri string, first_key long, has_key boolean, rows long, tokens long, part int"


def write_tokens(docs: DataFrame, uri: str, encode: Callable[[], Callable[[list[str]], list[bytes]]], vocabulary: int, shard_tokens: int = 4_000_000) -> list:
    """Encode ``docs`` (doc_id, text), write shards below ``uri`` in ascending doc_id order.

    Returns the manifest: one row for each shard, in order (the driver holds no more than that).
    Rows without doc_id come first; equal doc_ids are ordered by text; a null text is empty.  A
    repeated attempt of a task writes files of its own name, and only files that a finished task
    reports are in the manifest.
    """
    bits = bits_for(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names: list[dict] = []
        rows: list[tuple[int | None, bytes]] = []
        held = 0
        ids_of = encode()

        def flush():
            nonlocal rows, held
            name = f"{uri}/part-{part:05d}-{len(names):04d}-{uuid.uuid4().hex}.lmtp"
            write_shard(name, rows, bits)
            names.append({"uri": name, "first_key": rows[0][0], "has_key": rows[0][0] is not None, "rows": len(rows), "tokens": held, "part": part})
            rows, held = [], 0

        end = np.array([END_ID], np.uint32).tobytes()
        for chunk in text_chunks(batches, limit=TOGETHER):
            for doc_id, raw in zip(chunk.column("doc_id").to_pylist(), ids_of(chunk.column("text").to_pylist())):
                rows.append((doc_id, raw + end))
                held += len(raw) // 4 + 1
                if held >= shard_tokens:
                    flush()
        if rows:
            flush()
        if names:
            yield pa.RecordBatch.from_pylist(names, schema=pa.schema([("uri", pa.string()), ("first_key", pa.int64()), ("has_key", pa.bool_()), ("rows", pa.int64()), ("tokens", pa.int64()), ("part", pa.int32())]))

    filesystem, path = _fs(uri)
    filesystem.create_dir(path, recursive=True)
    # the beginning of the text deals rows that share a doc_id, or have none, to several partitions, in the order of the sort
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(F.asc_nulls_first("doc_id"), F.left("text", F.lit(256)))
    ordered = dealt.sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    manifest = ordered.mapInArrow(run, SHARD_SCHEMA).collect()
    return sorted(manifest, key=lambda r: (r.part, r.uri))


READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def read_tokens(spark: SparkSession, manifest: list, with_ids: bool = True, extra: Callable[[np.ndarray], dict] | None = None, extra_schema: str = "") -> DataFrame:
    """The documents of a manifest's shards, one task for each few shards.

    ``extra`` may turn the ids of a document into further columns, for callers that need no ids.
    """
    base, rows = 0, []
    for m in manifest:
        rows.append((m.uri, base))
        base += m.tokens
    schema = "doc_id long, start long, n_tokens long" + (", ids binary" if with_ids else "") + (f", {extra_schema}" if extra_schema else "")
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(r["uri"])
                starts = np.concatenate([[0], shard.ends[:-1]])
                for first in range(0, len(shard.ends), 1000):
                    last = min(first + 1000, len(shard.ends))
                    ids = shard.ids(int(starts[first]), int(shard.ends[last - 1]))
                    out = []
                    for i in range(first, last):
                        own = ids[starts[i] - starts[first] : shard.ends[i] - starts[first]]
                        row = {"doc_id": int(shard.doc_ids[i]) if shard.has_id[i] else None, "start": r["base"] + int(starts[i]), "n_tokens": len(own)}
                        if with_ids:
                            row["ids"] = own.tobytes()
                        out.append(row | (extra(own) if extra else {}))
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                shard.close()

    shards = spark.createDataFrame(rows, "uri string, base long") if rows else spark.createDataFrame([], "uri string, base long")
    return shards.repartition(max(1, len(rows))).mapInArrow(run, schema)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", uri: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` in the packed format and return what the files hold.

    Empty and null texts hold only the end id; an empty table gives no shard and no row.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    prepare(spark)
    path = public_tokenizers.path(tokenizer)
    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    manifest = write_tokens(docs, uri or fresh_path(spark, "tokens"), lambda: encoder(path), size)
    digest = lambda ids: {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
    return read_tokens(spark, manifest, with_ids=False, extra=digest, extra_schema="ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))
