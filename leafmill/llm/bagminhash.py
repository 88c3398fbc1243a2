"""Operator 8: near-duplicate classes by BagMinHash over multisets of word 5-grams.

A signature has one minimum for each register over the points of Poisson processes in
(time x weight): every element of the multiset owns one process for each dyadic interval of
weight, so the process of a large weight is the processes of its parts.  A point of an interval
that the weight fills only in part counts if it falls below the weight.  Points are drawn from
the element's hash alone, in order of time, until every register is filled; two documents agree
on a register with probability equal to their weighted Jaccard similarity.

Signatures are cut in bands.  Documents with the same words are one node from the start, so a
group of copies of any size costs one node.  In a bucket nodes are compared with a leader, the
node that meets most others, and not with each other; in ROUNDS more rounds the nodes outside the
bucket's largest class choose a leader.  Where a bucket still holds several classes after that,
the nodes beside its largest class are compared with its nodes of other classes, the bucket being
dealt out in salted parts: semi-joins on the signatures leave those with a possible partner, and
the exact test is part of the last join, so that only links leave it.  Tables of a bounded size are
sent to all tasks instead of being shuffled; the rows are the same either way.  Every link is verified by
the exact overlap of the two multisets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, stage, table, text_bytes, text_chunks, unstage, unwrapped, wrapped
from leafmill.llm.hashing import Prefixes, mix

GRAM = 5
SIMILARITY = 0.8
#: A pair at the limit is missed by all bands with probability (1 - 0.8^5)^25 = 5e-5.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Pairs whose signatures agree on fewer registers aren't verified; at the limit 4.5 standard deviations.
MIN_AGREE = int(REGISTERS * (SIMILARITY - 4.5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5))
#: Nodes of one bucket in a salted part.
PART = 500
#: Rounds with leaders from outside the largest class of a bucket.
ROUNDS = 2
#: Hashes of texts, 8 bytes each, that are broadcast to fetch the texts; more are joined by a shuffle.
FEW_KEYS = 2_000_000
#: Rows of two digests (pairs, labels) that are sent to all tasks in place of a shuffle: 20 MB or so.
FEW_ROWS = 200_000
#: Bytes of signatures and bags, estimated from their sizes, that are sent to all tasks to be compared there.
FEW_BYTES = 64 << 20
#: Times that FEW_BYTES are sent, one after the other, before a shuffle takes their place.
SLICES = 4
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each document and the end); A-Z are lower-cased."""
    n = len(offsets) - 1
    flat = np.full(len(raw) + n + 1, 32, np.uint8)
    shift = np.repeat(np.arange(n), np.diff(offsets)) + 1
    flat[np.arange(len(raw)) + shift] = _fold[raw]
    blank = _space[flat]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, stop = edge[::2], edge[1::2]
    if len(stop) < len(start):
        stop = np.append(stop, len(flat))
    first = np.searchsorted(start, offsets + np.arange(n + 1))
    return Prefixes(flat).of(start, stop), first


def shingles(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of GRAM words, its document); all words of a shorter text are one run."""
    sizes = np.diff(first)
    runs = np.where(sizes >= GRAM, sizes - GRAM + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), runs)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + first[:-1][owner]
    hashed = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        inside = k < sizes[owner]
        own = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else hashed
        hashed = np.where(inside, mix(hashed * np.uint64(0xD6E8FEB86659FD93) + own + np.uint64(k + 1)), hashed)
    return hashed, owner


def multiset(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (element, document) with their weights."""
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.flatnonzero(np.append(True, (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1]))) if len(hashed) else np.zeros(0, int)
    return hashed[new], owner[new], np.diff(np.append(new, len(hashed)))


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash signature (REGISTERS 32-bit values) of each of n documents."""
    total = np.bincount(owner, weight, n)
    limit = REGISTERS * (np.log(REGISTERS) + 6) / np.maximum(total, 1)
    least = np.full(n * REGISTERS, np.inf)
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1 if len(weight) else weight
    part = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(part)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    high = 2.0**level
    seed = mix(element[part] + level.astype(np.uint64) * _STEP)
    todo = np.flatnonzero(total > 0)
    pending = np.arange(len(part))
    while len(todo):
        live, time = pending, np.zeros(len(pending))
        step = 0
        while len(live):
            step += 1
            draw = mix(seed[live] + np.uint64(step * int(_STEP) % (1 << 64)))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / (high[live] - low[live])
            keep = time <= limit[owner[part[live]]]
            live, time, draw = live[keep], time[keep], draw[keep]
            more = mix(draw ^ np.uint64(0xA0761D6478BD642F))
            place = low[live] + (high[live] - low[live]) * ((more >> np.uint64(40)).astype(np.float64) * 2.0**-24)
            ok = place < weight[part[live]]
            register = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(least, owner[part[live[ok]]] * REGISTERS + register[ok], time[ok])
        unfilled = np.isinf(least.reshape(n, REGISTERS)).any(axis=1)
        todo = todo[unfilled[todo]]
        limit[todo] *= 2
        again = np.zeros(n, bool)
        again[todo] = True
        pending = np.flatnonzero(again[owner[part]])
    return (mix(least.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).reshape(n, REGISTERS)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), node (128-bit digest of its words; null without words), sig for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            words, first = word_hashes(*text_bytes(chunk.column("text")))
            element, owner, weight = multiset(*shingles(words, first))
            sig = signatures(element, owner, weight, chunk.num_rows)
            nodes = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("th"), pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, REGISTERS, dtype=np.int32)), pa.array(sig.view(np.int32).ravel()))], ["doc_id", "th", "node", "sig"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, "doc_id long, th long, node binary, sig array<int>")


def bags(docs: DataFrame) -> DataFrame:
    """node, bag: the multiset of a text as a set, the k-th copy of an element being one of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            words, first = word_hashes(*text_bytes(chunk.column("text")))
            element, owner, weight = multiset(*shingles(words, first))
            copies = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            bag = mix(np.repeat(element, weight) + copies.astype(np.uint64) * _STEP).view(np.int64)
            ends = np.cumsum(np.bincount(owner, weight, chunk.num_rows)).astype(np.int32)
            nodes = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(bag))], ["node", "bag"])

    return docs.select("text").mapInArrow(run, "node binary, bag array<long>")


def _bands(sig: str = "sig"):
    return [F.xxhash64(F.lit(i), F.slice(sig, 1 + ROWS * i, ROWS)) for i in range(BANDS)]


def _sent(rows: DataFrame) -> DataFrame:
    """Staged rows, marked to be sent to all tasks where they are few."""
    return F.broadcast(rows) if rows.count() <= FEW_ROWS else rows


def _agreeing(a: str, b: str):
    """Registers on which two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda p, q: p == q), lambda e: e))


class Finder:
    """The steps of the search; every table between them is staged, and deleted once it is read."""

    def __init__(self, docs: DataFrame):
        prepare(docs.sparkSession)
        self.docs = docs.select("doc_id", "text")
        sketched = stage(sketch(self.docs), "sketch")
        per_node = sketched.where(F.col("node").isNotNull()).groupBy("node")
        self.nodes = stage(per_node.agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.min("th").alias("th"), F.first("sig").alias("sig")), "nodes")
        self.rows = stage(sketched.drop("sig"), "rows")
        unstage(sketched)
        exploded = self.nodes.select("node", F.posexplode(F.array(*_bands())).alias("band", "bucket"))
        shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
        found = stage(exploded.join(shared, "bucket"), "buckets")
        # a text that the others were copied from meets more of them than they meet each other
        hubs = found.groupBy("node").agg(F.sum("k").alias("met"))
        self.buckets = stage(found.join(hubs, "node"), "buckets")
        unstage(found)
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def search(self) -> DataFrame | None:
        """node, label of all nodes with a link; None if there are none."""
        self._take(self._verified(self._close(self._with_leaders(self.buckets))))
        if self.links is not None:
            mixed = stage(self._mixed(), "mixed")
            for _ in range(ROUNDS):
                if mixed.isEmpty() or not self._take(self._verified(self._close(self._with_leaders(mixed)))):
                    break
                unstage(mixed)
                mixed = stage(self._mixed(), "mixed")
            if not mixed.isEmpty():
                self._take(self._beside_largest(mixed))
            unstage(mixed)
        unstage(self.buckets)
        return self.labels

    def _with_leaders(self, buckets: DataFrame) -> DataFrame:
        """Pairs of each bucket's best-met node (outside its largest class, where classes are known) and its nodes of other classes."""
        classed = "label" in buckets.columns
        able = buckets.where("beside") if classed else buckets
        order = F.struct(-F.col("met"), "node")
        best = able.groupBy("bucket").agg(F.min_by(F.struct(F.col("node"), F.col("label") if classed else F.col("node").alias("label")), order).alias("leader"))
        pairs = buckets.join(best.select("bucket", F.col("leader.node").alias("other"), F.col("leader.label").alias("class")), "bucket")
        pairs = pairs.where(F.col("label") != F.col("class") if classed else F.col("node") != F.col("other"))
        return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()

    def _close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures agree enough to be verified, staged."""
        pairs = stage(pairs, "pairs")
        sig = lambda end: self.nodes.select(F.col("node").alias(end), F.col("sig").alias(f"sig_{end}"))
        both = sig("a").join(_sent(pairs), "a").join(sig("b"), "b")
        close = stage(both.where(_agreeing("sig_a", "sig_b") >= MIN_AGREE).select("a", "b"), "close")
        unstage(pairs)
        return close

    def _mixed(self) -> DataFrame:
        """Nodes of buckets with several classes: bucket, node, met, k, label, beside (outside the largest class)."""
        rows = self.buckets.join(_sent(self.labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
        counted = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"))
        mixed = counted.groupBy("bucket").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("classes")).where(F.col("classes") > 1).select("bucket", F.col("top.label").alias("largest"))
        return rows.join(mixed, "bucket").withColumn("beside", F.col("label") != F.col("largest")).drop("largest")

    def _beside_largest(self, mixed: DataFrame) -> DataFrame | None:
        """Links between nodes of different classes in one bucket, at least one outside its largest class.

        A bucket of n nodes with m outside its largest class costs m x n comparisons of signatures,
        in parts of PART nodes; the other pairs follow from their classes.
        """
        rows = mixed.join(self.nodes.select("node", "sig"), "node").select("bucket", "band", "node", "label", "beside", "sig", F.ceil(F.col("k") / PART).cast("int").alias("parts"))
        rows = stage(rows, "mixed")
        once = ~F.col("y.beside") | (F.col("x.node") < F.col("y.node"))
        able = lambda test: F.when(F.col("x.label") != F.col("y.label"), test).otherwise(False)
        met = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.part") == F.col("y.part"))
        close = met & able(_agreeing("x.sig", "y.sig") >= MIN_AGREE)
        every = lambda r: r.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        few = lambda r: r.where("beside").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        kept = ["bucket", "band", "node", "label", "beside", "sig", "parts", "part"]
        x = few(rows).alias("x").join(every(rows).alias("y"), close, "left_semi").select(*kept).distinct()
        y = every(rows).alias("x").join(few(rows).alias("y"), close, "left_semi").select(*kept)
        x, y = stage(x, "few"), stage(y, "every")
        unstage(rows)
        if x.isEmpty():
            links = None
        else:
            bag = self._bags(x.select("node").unionByName(y.select("node")), x.count() + y.count() <= FEW_ROWS)
            # two nodes may share many buckets: the first band in which they agree compares them
            same = lambda i: F.slice("x.sig", i * ROWS + 1, ROWS) == F.slice("y.sig", i * ROWS + 1, ROWS)
            before = F.exists(F.slice(F.array(*map(F.lit, range(BANDS))), F.lit(1), F.col("x.band")), same)
            test = lambda last: F.when(once, F.when(~before, F.when(_agreeing("x.sig", "y.sig") >= MIN_AGREE, last)))
            possible = lambda last: met & able(F.coalesce(test(last), F.lit(False)))
            listed = lambda pairs: stage(pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "links")
            similar = possible(_similar("x.bag", "y.bag"))
            all_bags = bag.agg(F.sum(F.size("bag") * 8 + 100)).first()[0] or 0
            size = x.join(F.broadcast(bag) if all_bags <= FEW_BYTES else bag, "node").agg(F.sum(F.size("bag") * 8 + REGISTERS * 4 + 200)).first()[0] or 0
            if max(all_bags, size / SLICES) <= FEW_BYTES:
                # one side is sent to where the other lies: a shuffle by bucket would cut a very large bucket in pieces,
                # and join each piece of one side with each of the other
                slices = max(1, -(-size // FEW_BYTES))
                held, y_bag = x.join(F.broadcast(bag), "node"), y.join(F.broadcast(bag), "node").alias("y")
                sent = [F.broadcast(held.where(F.pmod(F.xxhash64("node"), F.lit(slices)) == i)).alias("x") for i in range(slices)]
                links = reduce(DataFrame.unionByName, [listed(x_bag.join(y_bag, similar)) for x_bag in sent])
            else:
                links = listed(x.join(bag, "node").alias("x").join(y.join(bag, "node").alias("y"), similar))
            unstage(bag)
        unstage(x)
        unstage(y)
        return links

    def _take(self, links: DataFrame | None) -> bool:
        """Take staged links up and renew the classes; whether there are any."""
        if links is None or links.isEmpty():
            return False
        if self.labels is not None:
            unstage(self.labels)
        self.links = links if self.links is None else self.links.unionByName(links)
        self.labels = components(self.links)
        return True

    def _bags(self, wanted: DataFrame, sent: bool) -> DataFrame:
        """node, bag for the wanted nodes (``sent``: few enough to be sent to all tasks), from one text of each.

        A node may come twice where texts share their key by chance.
        """
        # staged, to count them: few enough are sent to all tasks, since a shuffled semi-join moves every text of the input
        keys = stage(self.nodes.join(F.broadcast(wanted) if sent else wanted.distinct(), "node", "left_semi").select("th"), "keys")
        few = keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS
        fetched = self.docs.withColumn("th", F.xxhash64("text")).join(F.broadcast(keys) if few else keys, "th", "left_semi")
        # texts that share the key by chance differ in another hash or in length
        one = fetched.groupBy("th", F.hash("text"), F.length("text")).agg(F.min("text").alias("text"))
        found = stage(bags(one), "bags")
        unstage(keys)
        return found

    def _verified(self, pairs: DataFrame) -> DataFrame | None:
        """Links among staged pairs, staged; None if there are no pairs."""
        if pairs.isEmpty():
            unstage(pairs)
            return None
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        few = pairs.count() <= FEW_ROWS
        bag = self._bags(ends, few)
        both = bag.select(F.col("node").alias("a"), F.col("bag").alias("x")).join(F.broadcast(pairs) if few else pairs, "a").join(bag.select(F.col("node").alias("b"), F.col("bag").alias("y")), "b")
        links = stage(both.where(_similar("x", "y")).select("a", "b"), "links")
        unstage(bag)
        unstage(pairs)
        return links


def _similar(x: str, y: str):
    """Whether the overlap of two bags is at least SIMILARITY of their union, in whole numbers."""
    common = F.size(F.array_intersect(x, y))
    return common * 10 >= (F.size(x) + F.size(y) - common) * int(SIMILARITY * 10)


def components(links: DataFrame) -> DataFrame:
    """node, label (least node of its component) for the ends of ``links`` (a, b).

    Labels spread along links and are then replaced by their own labels, until nothing changes;
    each step is a staged table, so neither lineage nor the driver grows with the graph.
    """
    both = stage(links.select(F.col("a").alias("node"), F.col("b").alias("peer")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("peer"))), "edges")
    labels = stage(both.groupBy("node").agg(F.min("peer").alias("peer")).select("node", F.least("node", "peer").alias("label")), "labels")
    few = labels.count() <= FEW_ROWS
    sent = lambda rows: F.broadcast(rows) if few else rows
    while True:
        near = both.join(sent(labels.select(F.col("node").alias("peer"), F.col("label").alias("seen"))), "peer").groupBy("node").agg(F.min("seen").alias("seen"))
        spread = stage(near.join(sent(labels), "node").select("node", F.least("label", "seen").alias("label"), (F.col("seen") < F.col("label")).alias("moved")), "labels")
        if spread.where("moved").isEmpty():
            unstage(both)
            unstage(spread)
            return labels
        unstage(labels)
        hop = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(spread.join(sent(hop), "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        unstage(spread)


def labelled_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, th, node, label for each row; label, class_id, class_size for each class; node,
    n_links, link_id for each text with a link).

    ``th`` is the hash of the text, ``label`` a digest that names the class; null without words.
    """
    finder = Finder(docs)
    labels = finder.search()
    nodes = finder.nodes.select("node", "first_id", "n")
    labelled = nodes.join(_sent(labels), "node", "left").withColumn("label", F.coalesce("label", "node")) if labels is not None else nodes.withColumn("label", F.col("node"))
    classes = labelled.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"))
    rows = finder.rows.select("doc_id", "th", "node").join(labelled.select("node", "label"), "node", "left")
    return rows, classes, _linked(finder)


def _linked(finder: Finder) -> DataFrame:
    """node, n_links, link_id: verified links of a text, and the least doc_id at their other ends."""
    ids = finder.nodes.select(F.col("node").alias("peer"), "first_id")
    if finder.links is None:
        return ids.limit(0).select(F.col("peer").alias("node"), F.lit(0).cast("long").alias("n_links"), F.col("first_id").alias("link_id"))
    both = finder.links.select(F.col("a").alias("node"), F.col("b").alias("peer")).unionByName(finder.links.select(F.col("b").alias("node"), F.col("a").alias("peer"))).distinct()
    return both.join(ids, "peer").groupBy("node").agg(F.count(F.lit(1)).alias("n_links"), F.min("first_id").alias("link_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size, n_links, link_id for each row of ``docs``.

    ``n_links`` counts the different texts with which the row's text was compared and found
    similar, ``link_id`` is the least doc_id among these (null without): the links that hold the
    class together.  Pairs within a class that were not needed for that are not compared.

    Texts without a word (null, empty) are classes of their own; a text of fewer than five words
    matches only texts with the same words; rows without doc_id take part, and a class of nothing
    else has no class_id.  Letters A-Z are compared in lower case.  A very long text is sketched
    as one slice; its multiset is one row when it is verified.
    """
    rows, classes, linked = labelled_rows(docs)
    alone = F.col("label").isNull()
    rows = rows.join(linked, "node", "left").join(classes, "label", "left")
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "link_id",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with the least doc_id (null first).

    Rows without words (null, empty) all stay.  Of rows that share the least doc_id the one with
    the least text hash stays; repeated rows of the chosen doc_id and text give one row.
    """
    rows, _, _ = labelled_rows(docs)
    did = F.coalesce("doc_id", F.lit(-(1 << 62)))
    per_text = rows.groupBy(did.alias("_did"), F.col("th").alias("_th")).agg(F.count(F.lit(1)).alias("_n"), F.max("label").alias("label"))
    chosen = per_text.where(F.col("label").isNotNull()).groupBy("label").agg(F.min(F.struct("_did", "_th", "_n")).alias("k")).select("k.*")
    chosen = chosen.unionByName(per_text.where(F.col("label").isNull()).select("_did", "_th", F.lit(1).cast("long").alias("_n")))
    kept = wrapped(docs).withColumns({"_did": did, "_th": F.xxhash64("text")}).join(chosen.hint("shuffle_hash"), ["_did", "_th"])
    repeated = kept.where(F.col("_n") > 1).dropDuplicates(["_did", "_th"])
    return unwrapped(kept.where(F.col("_n") == 1).unionByName(repeated), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
