"""Operator 7: removal of repeated strings by prefix-free parsing.

Every text is parsed into phrases at rolling-hash triggers (see ``phrases``): the parse is the
list of phrases with their places, the dictionary the distinct phrases.  Phrases overlap so far
that every string of SPAN bytes lies in one phrase.  A phrase that occurs twice in the parse is
repeated as a whole.  What is left are phrases that share their trigger with another phrase but
occur once: the edges of repeats.  Only these are written out and gathered by trigger; the
suffixes of a bounded part of the dictionary are put in order by prefix doubling, and suffixes
with SPAN bytes in common are neighbours there; the places of the phrase in the parse carry the
result back to the texts.

No more than one phrase in about 80 bytes is shuffled, and phrases with a trigger of their own are
dropped by a join that splits skewed keys.  Triggers with more than GROUP phrases are split by the
bytes around the trigger: a shared string reaches at least half of what it needs beyond the
trigger to one of its two sides, so phrases that share one meet in a group that agrees there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, stage, table, text_bytes, text_chunks, unstage, wrapped
from leafmill.llm.phrases import GRAM, SPAN, phrases

#: Phrases of one group that a task orders at once (about 350 bytes each); larger groups are split.
GROUP = 4_000
#: Phrases ordered at once, if they are more than those of one group.
BATCH = 4_000


def _id():
    return F.coalesce("doc_id", F.lit(-(1 << 62))).alias("did")


def parse(docs: DataFrame) -> DataFrame:
    """The parse: did, th (key of the text), trigger, whole, low, high, at, step, copies."""
    names = ["low", "high", "at", "step", "copies", "trigger", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            found = phrases(*text_bytes(chunk.column("text")))
            rows = pa.array(found["owner"])
            yield pa.RecordBatch.from_arrays([chunk.column("did").take(rows), chunk.column("th").take(rows), *[pa.array(found[n], pa.int64()) for n in names]], ["did", "th", *names])

    return docs.select(_id(), F.xxhash64("text").alias("th"), "text").mapInArrow(run, "did long, th long, low long, high long, at long, step long, copies long, trigger long, whole long")


def written_out(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The bytes of dictionary phrases, cut from the text each was first seen in."""
    wanted = dictionary.select("rep.did", "rep.th", F.struct("trigger", "whole", "n", "group", "rep.low", "rep.high", "rep.at").alias("p")).groupBy("did", "th").agg(F.collect_list("p").alias("ps"))
    texts = docs.select(_id(), F.xxhash64("text").alias("th"), "text").join(wanted.hint("shuffle_hash"), ["did", "th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            out: list[dict] = []
            for did, th, text, ps in zip(*(chunk.column(c).to_pylist() for c in ("did", "th", "text", "ps"))):
                raw = (text or "").encode()
                for p in ps:
                    out.append({"trigger": p["trigger"], "whole": p["whole"], "n": p["n"], "group": p["group"], "did": did, "th": th, "low": p["low"], "before": p["at"] - p["low"], "bytes": raw[p["low"] : p["high"] + SPAN]})
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=_written)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_written)

    return texts.select("did", "th", "text", "ps").mapInArrow(run, "trigger long, whole long, n long, group long, did long, th long, low long, before long, bytes binary").dropDuplicates(["trigger", "whole"])


_written = pa.schema([(n, pa.int64()) for n in ("trigger", "whole", "n", "group", "did", "th", "low", "before")] + [("bytes", pa.binary())])
_spans = pa.schema([(n, pa.int64()) for n in ("did", "th", "start", "stop")])


def suffix_order(texts: list[bytes], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, place in the phrase, shared) of each SPAN-byte string at the head of a suffix.

    Suffixes are ranked by their first 8 bytes, and by twice as many in each round, until the
    rank covers SPAN bytes.  A suffix that has lost all its equals shares nothing and leaves.
    Strings of one rank are shared if they stand in different phrases (``whole``).
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    strings = sizes - SPAN + 1
    phrase = np.repeat(np.arange(len(texts)), strings)
    place = np.arange(len(phrase)) - np.repeat(np.cumsum(strings) - strings, strings)
    start = (np.cumsum(sizes) - sizes)[phrase] + place

    key = np.zeros(len(raw), np.uint64)
    for i in range(8):
        key[: len(raw) - i] |= raw[i:].astype(np.uint64) << np.uint64(56 - 8 * i)
    at, have = np.arange(len(raw)), 8
    rank = np.full(len(raw) + SPAN, -1)
    while True:
        order = np.argsort(key)
        ranked = key[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        equal = ~(new & np.append(new[1:], True))  # has a neighbour with the same head
        rank[:] = -1
        rank[at[order[equal]]] = np.cumsum(new)[equal]
        if have == SPAN or not equal.any():
            break
        step = min(have, SPAN - have)
        at = np.flatnonzero(rank >= 0)
        at = at[rank[at + step] >= 0]
        key = rank[at] * np.int64(len(rank)) + rank[at + step]
        have += step
        if not len(at):
            rank[:] = -1
            break
    shared = np.zeros(len(start), bool)
    ranked = np.flatnonzero(rank[start] >= 0) if have == SPAN else start[:0]
    if len(ranked):
        ranked = ranked[np.argsort(rank[start[ranked]], kind="stable")]
        first = np.flatnonzero(np.append(True, np.diff(rank[start[ranked]]) != 0))
        owner = whole[phrase[ranked]]
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        shared[ranked[np.repeat(several, np.diff(np.append(first, len(ranked))))]] = True
    return phrase, place, shared


def _ranges(flags: np.ndarray, phrase: np.ndarray, place: np.ndarray):
    """(phrase, first place, last place) of the runs of flagged places."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on, on
    cut = (on[1:] != on[:-1] + 1) | (phrase[on[1:]] != phrase[on[:-1]])
    first, last = on[np.append(True, cut)], on[np.append(cut, True)]
    return phrase[first], place[first], place[last]


def edges(groups: DataFrame) -> DataFrame:
    """did, th, start, stop: what phrases that occur once share with others of their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def solve(rows: pa.Table):
            column = lambda n: rows.column(n).to_numpy()
            phrase, place, shared = suffix_order(rows.column("bytes").to_pylist(), column("whole"))
            own, first, last = _ranges(shared & (column("n")[phrase] == 1), phrase, place)
            low = column("low")[own]
            return pa.RecordBatch.from_arrays([pa.array(column("did")[own]), pa.array(column("th")[own]), pa.array(low + first), pa.array(low + last + SPAN)], schema=_spans)

        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                held.append(part)
                count += part.num_rows
                if count >= BATCH:  # all but the last group's phrases are complete
                    rows = pa.Table.from_batches(held).combine_chunks()
                    key = rows.column("key").to_numpy()
                    cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                    if cut:
                        yield solve(rows.slice(0, cut))
                    held = rows.slice(cut).to_batches()
                    count = rows.num_rows - cut
        if count:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    dealt = groups.select("key", "whole", "n", "did", "th", "low", "bytes").repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(run, "did long, th long, start long, stop long")


def bounded_groups(written: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(phrases with the ``key`` of their group, spans of strings that more than GROUP phrases share).

    A string of SPAN bytes needs SPAN - GRAM bytes beside the trigger.  A crowded group is split by
    the first half of them, once before and once behind the trigger, and so on with what is
    needed then; at the end a group is one string.
    """
    columns = ["key", "n", "whole", "did", "th", "low", "before", "bytes", "left", "right"]
    rows = written.withColumns({"key": F.col("trigger"), "left": F.lit(0), "right": F.lit(0)})
    done = rows.where(F.col("group") <= GROUP).select(*columns)
    rows, need = rows.where(F.col("group") > GROUP).select(*columns), SPAN - GRAM
    while not rows.isEmpty():
        if not need:
            string = rows.withColumn("string", F.substring("bytes", F.col("before") - F.col("left") + 1, F.lit(SPAN)))
            shared = string.groupBy("key", "string").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).where("a != b").select("key", "string")
            start = F.col("low") + F.col("before") - F.col("left")
            return done, string.where("n = 1").join(shared, ["key", "string"], "left_semi").select("did", "th", start.alias("start"), (start + SPAN).alias("stop"))
        step = -(-need // 2)
        bytes_at = lambda at: F.substring("bytes", at + 1, F.lit(step))
        before = F.col("before") - F.col("left") - step
        behind = F.col("before") + GRAM + F.col("right")
        to_left = rows.where(before >= 0).withColumns({"key": F.xxhash64(F.lit("left"), "key", bytes_at(before)), "left": F.col("left") + step})
        to_right = rows.where(F.octet_length("bytes") >= behind + step).withColumns({"key": F.xxhash64(F.lit("right"), "key", bytes_at(behind)), "right": F.col("right") + step})
        split = stage(to_left.unionByName(to_right).select(*columns), "split")
        need -= step
        sizes = split.groupBy("key").agg(F.count(F.lit(1)).alias("group")).where(F.col("group") > GROUP).select("key")
        done = done.unionByName(split.join(sizes, "key", "left_anti").select(*columns))
        rows = split.join(sizes, "key", "left_semi").select(*columns)
    return done, None


def repeated_spans(docs: DataFrame) -> DataFrame:
    """did, th, spans: what of each text repeats, as (start, stop, step, copies) in bytes."""
    parsed = stage(parse(docs), "parse")
    per_trigger = parsed.groupBy("trigger").agg(F.sum("copies").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    repeated = per_trigger.where("n > 1").select("trigger", (F.col("a") != F.col("b")).alias("several"))
    rows = stage(parsed.join(repeated, "trigger"), "repeated")
    unstage(parsed)
    several = rows.where("several")
    dictionary = several.groupBy("trigger", "whole").agg(F.sum("copies").alias("n"), F.min(F.struct("did", "th", "low", "high", "at")).alias("rep"))
    dictionary = stage(dictionary, "dictionary")
    groups = dictionary.groupBy("trigger").agg(F.count(F.lit(1)).alias("group"))
    written = stage(written_out(docs, dictionary.join(groups, "trigger")), "written")
    groups, common = bounded_groups(written)
    spans = edges(groups)
    if common is not None:
        spans = spans.unionByName(common)
    whole = rows.where("NOT several").unionByName(several.join(dictionary.where("n > 1").select("trigger", "whole"), ["trigger", "whole"], "left_semi"))
    whole = whole.select("did", "th", F.col("low").alias("start"), (F.col("high") + SPAN).alias("stop"), "step", "copies")
    spans = spans.select("did", "th", "start", "stop", F.lit(0).cast("long").alias("step"), F.lit(1).cast("long").alias("copies"))
    joined = stage(whole.unionByName(spans), "spans")
    for read in (rows, dictionary, written):
        unstage(read)
    # equal rows have equal spans: a set, combined map-side, holds those of one text however many copies there are
    return joined.groupBy("did", "th").agg(F.collect_set(F.struct("start", "stop", "step", "copies")).alias("spans"))


def merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans, in order."""
    pieces = sorted((s["start"] + k * s["step"], s["stop"] + k * s["step"]) for s in spans for k in range(s["copies"]))
    out: list[tuple[int, int]] = []
    for start, stop in pieces:
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return [(a, min(b, size)) for a, b in out]


def without_repeats(docs: DataFrame, keep: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row; with ``keep``, text and
    ``rest`` (see ``wrapped``) and ``kept`` (the remaining text; a character cut in two goes) before the counts.

    Null is an empty text; texts under SPAN bytes and empty tables lose nothing; two rows with
    equal doc_id and text count as two occurrences and both lose the repeated bytes.  A very long
    text is parsed as one slice, with about 60 bytes of arrays for each of its bytes.
    """
    prepare(docs.sparkSession)
    found = repeated_spans(docs.select("doc_id", "text"))
    counts = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    given = wrapped(docs) if keep else docs.select("doc_id", "text")
    rows = given.withColumns({"did": _id(), "th": F.xxhash64("text")}).join(found.hint("shuffle_hash"), ["did", "th"], "left").select(*given.columns, "spans")
    names = [*given.columns, "kept", *counts] if keep else ["doc_id", *counts]
    full = rows.drop("spans").withColumns({"kept": F.lit(""), "n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept_sha256": F.lit("")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            kept, sizes, removed, n_spans, digests = [], [], [], [], []
            for text, spans in zip(chunk.column("text").to_pylist(), chunk.column("spans").to_pylist()):
                raw = (text or "").encode()
                runs = merged(spans, len(raw)) if spans else []
                edge = [0, *(x for r in runs for x in r), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edge[::2], edge[1::2]))
                kept.append(left.decode("utf-8", "ignore") if keep else None)
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                n_spans.append(len(runs))
                digests.append(hashlib.sha256(left).hexdigest())
            made = {"kept": pa.array(kept, pa.string()), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else chunk.column(n) for n in names], names)

    return rows.mapInArrow(run, full.select(*names).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
