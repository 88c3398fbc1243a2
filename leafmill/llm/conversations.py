"""Conversation structure repair: the cheapest edits that give ``(system? (user assistant)+)?``.

A row becomes one symbol (role and fault), a conversation the signature of its symbols.  Sorted
signatures are inserted into a prefix trie; a node holds the layer of a dynamic program, made once
for all signatures that share the prefix, and the answer is read at the terminal node.  A layer
holds, for every state to start in and every state to be in, the least (cost, audit).  Of two
audits of one cost none is the other's prefix, since every letter but K has a price and both have
a letter for every row; so the least audit of a whole is put together from the least of its parts.

Rows are sorted over range partitions, never gathered by conversation.  A conversation that lies
inside one partition and has at most ``BLOCK_ROWS`` rows is answered there; any other leaves blocks
whose layers are folded in order, and whose texts are rewritten block by block afterwards.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import CHUNK_BYTES, prepare, stage, table

#: Rows of a block and blocks that share a trie; a block also ends at CHUNK_BYTES of text.
BLOCK_ROWS, TRIE_BLOCKS = 256, 2000
#: Prices of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant; a repaired conversation ends in the first or last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_INSERTS = [(a, b) for (a, role), b in _NEXT.items() if role != "s"]
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

Best = tuple[int, str] | None


def offered(to: list[Best], state: int, cost: int, audit: str) -> bool:
    if to[state] is None or (cost, audit) < to[state]:
        to[state] = (cost, audit)
        return True
    return False


def with_inserts(reached: list[Best]) -> list[Best]:
    while any([reached[a] is not None and offered(reached, b, reached[a][0] + INSERT, reached[a][1] + "I") for a, b in _INSERTS]):
        pass
    return reached


def advanced(reached: list[Best], symbol: str) -> list[Best]:
    """The layer after one more row.  Symbols: role initial (x: any other), in capitals if truncated; D: has to go."""
    after: list[Best] = [None] * 4
    late = TRUNCATED if symbol != "D" and symbol.isupper() else 0
    for state, best in enumerate(reached):
        if best is None:
            continue
        cost, audit = best
        offered(after, state, cost + DELETE, audit + "D")
        if symbol != "D":
            kept = _NEXT.get((state, symbol.lower()))
            if kept is not None:
                offered(after, kept, cost + late, audit + "K")
            for a, b in _INSERTS:
                if a == state:
                    offered(after, b, cost + REROLE + late, audit + "R")
    return with_inserts(after)


Layer = list[list[Best]]


class Trie:
    """Prefix trie of signatures that come in sorted order; nodes off the current branch are let go."""

    def __init__(self):
        self.path = ""
        self.branch: list[Layer] = [[with_inserts([(0, "") if s == t else None for t in range(4)]) for s in range(4)]]
        self.made = 0

    def insert(self, signature: str) -> Layer:
        """The layer at the signature's terminal node."""
        shared = 0
        for a, b in zip(self.path, signature):
            if a != b:
                break
            shared += 1
        del self.branch[shared + 1 :]
        for symbol in signature[shared:]:
            self.branch.append([advanced(reached, symbol) for reached in self.branch[-1]])
            self.made += 1
        self.path = signature
        return self.branch[-1]


def solved(signatures: set[str]) -> dict[str, Layer]:
    trie = Trie()
    return {s: trie.insert(s) for s in sorted(signatures)}


def ended(reached: list[Best]) -> tuple[int, str, int]:
    """(cost, audit, state) of the cheapest way to end."""
    return min((*reached[s], s) for s in (NOTHING, ASSISTANT) if reached[s] is not None)


def rewritten(roles: list[str], texts: list[str], audit: str, state: int) -> list[str]:
    """``role:text`` of the repaired rows; the roles of rerole and insert follow from the state."""
    lines, at = [], 0
    for edit in audit:
        role, text = "assistant" if state == USER else "user", ""
        if edit != "I":
            text, at = texts[at], at + 1
            role = roles[at - 1] if edit == "K" else role
        if edit != "D":
            lines.append(f"{role}:{text}")
            state = _NEXT[state, role[0]]
    return lines


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the stated damage; a dropped row stays with a null role, so that its conversation is known.

    A null of any column counts as one space, but a null turn stays null for the order.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("fate"))
    role = F.when(F.col("fate") == 4, F.lit("user")).when(F.col("fate") != 0, F.col("role"))
    text = F.when(F.col("fate") <= 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _symbols(rows: DataFrame) -> DataFrame:
    """Rows with ``key`` (equal for equal rows of one turn), the end of the text, and ``first_turn`` where role and text come again."""
    known = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumns({"content": F.sha2("text", 256), "ending": F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1))})
    turn = F.struct("turn")  # a null turn is the least
    again = known.where(F.col("role").isNotNull() & (F.col("ending") != "")).groupBy("conv_id", "role", "content").agg(F.min(turn).alias("first_turn"), F.max(turn).alias("last_turn"))
    # few rows, as repeats within a turn are neighbours and not looked for here; staged, so that Spark knows their size before it joins
    again = stage(again.where(~F.col("first_turn").eqNullSafe(F.col("last_turn"))).drop("last_turn"), "again")
    c, a = known.alias("c"), again.alias("a")
    same = F.col("c.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("c.role") == F.col("a.role")) & (F.col("c.content") == F.col("a.content"))
    later = F.coalesce(~F.col("a.first_turn.turn").eqNullSafe(F.col("c.turn")), F.lit(False)) & F.col("a.first_turn").isNotNull()
    joined = c.join(a, same, "left").select("c.*", later.alias("later"))
    role, ending = F.coalesce("role", F.lit("")), F.col("ending")
    initial = F.when(F.left(role, F.lit(1)).isin("s", "u", "a"), F.left(role, F.lit(1))).otherwise(F.lit("x"))
    fault = F.when(F.col("role").isNull(), F.lit(None)).when(ending == "", "blank").when(F.col("later"), "duplicate").when(~ending.isin(".", "!", "?"), "truncated").otherwise("none")
    key = F.when(F.col("role").isNotNull(), F.concat_ws(" ", F.coalesce(F.col("turn").cast("string"), F.lit("-")), "content", "role"))
    return joined.select("conv_id", "turn", "role", "text", "content", initial.alias("initial"), fault.alias("fault"), key.alias("key"))


def _symbol(initial: str, fault: str) -> str:
    return "D" if fault in ("blank", "duplicate") else initial.upper() if fault == "truncated" else initial


class _Block:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id, open_: bool):
        self.conv_id, self.open = conv_id, open_
        self.roles, self.texts, self.symbols, self.size = [], [], [], 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        self.lo = self.hi = self.first_key = self.last_key = None
        self.turns = self.illegal = 0

    def add(self, turn, role, text, initial, fault, key) -> None:
        if key == self.last_key and fault != "blank":
            fault = "duplicate"  # equal rows are neighbours
        if turn is not None and turn != self.hi:
            self.turns, self.hi = self.turns + 1, turn
            self.lo = turn if self.lo is None else self.lo
        if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        self.first_key, self.last_key = self.first_key if self.roles else key, key
        self.counts[fault] += 1
        self.symbols.append(_symbol(initial, fault))
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)


_BLOCK = (
    "open boolean, part long, lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, first_key string, last_key string, "
    "signature string, layer string, again string, cost long, audit string, repaired string, roles array<string>, texts array<string>"
)


def _rows_of(blocks: list[_Block], parts: Iterator[int], lead: bool) -> list[dict]:
    """Blocks as rows; ``lead``: the first may continue a run of equal rows of the partition before."""
    signatures = ["".join(b.symbols) for b in blocks]
    other = "D" + signatures[0][1:] if lead and signatures and signatures[0] else None
    layers = solved({*signatures, *([other] if other else [])})
    out = []
    for i, (block, signature) in enumerate(zip(blocks, signatures)):
        layer = layers[signature]
        row = {"conv_id": block.conv_id, "open": block.open, "part": next(parts), "lo": block.lo, "hi": block.hi, "turns": block.turns, **{k: v for k, v in block.counts.items() if k != "none"}, "illegal": block.illegal, "signature": signature}
        if block.open:
            row |= {"first": block.roles[0][:1] if block.roles else None, "last": block.roles[-1][:1] if block.roles else None, "first_key": block.first_key, "last_key": block.last_key, "roles": block.roles, "texts": block.texts}
            row |= {"layer": json.dumps(layer), "again": json.dumps(layers[other]) if other and not i else None}
        else:
            cost, audit, _ = ended(layer[NOTHING])
            row |= {"cost": cost, "audit": audit, "repaired": "\n".join(rewritten(block.roles, block.texts, audit, NOTHING))}
        out.append(row)
    return out


def _blocks(schema: pa.Schema, rows_of_block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        parts = iter(range(partition << 32, (partition + 1) << 32))
        done: list[_Block] = []
        block, lead, size = None, True, 0
        for batch in batches:
            for conv_id, turn, role, text, initial, fault, key in zip(*(c.to_pylist() for c in batch.columns)):
                if block is None or conv_id != block.conv_id or len(block.roles) >= rows_of_block or block.size >= CHUNK_BYTES:
                    full = block is not None and conv_id == block.conv_id
                    if block is not None:
                        block.open |= full
                        done.append(block)
                        size += block.size
                    if len(done) >= TRIE_BLOCKS or size >= 4 * CHUNK_BYTES:
                        yield pa.RecordBatch.from_pylist(_rows_of(done, parts, lead), schema)
                        done, lead, size = [], False, 0
                    last_key = block.last_key if full else None
                    block = _Block(conv_id, block is None or full)
                    block.last_key = last_key
                if role is not None:
                    block.add(turn, role, text, initial, fault, key)
        if block is not None:
            block.open = True
            yield pa.RecordBatch.from_pylist(_rows_of([*done, block], parts, lead), schema)

    return run


class Fold:
    """Blocks of one conversation in order: least (cost, audit) by state, without the audit's part that all share."""

    def __init__(self):
        self.live: list[Best] = [(0, ""), None, None, None]
        self.base, self.came, self.parts = 0, [], []
        self.totals = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.lo = self.hi = self.last = self.last_key = None

    def add(self, row: dict) -> None:
        again = row["again"] is not None and row["first_key"] is not None and row["first_key"] == self.last_key and row["signature"][:1] != "D"
        layer = json.loads(row["again"] if again else row["layer"])
        reached: list[Best] = [None] * 4
        came = [NOTHING] * 4
        for a, held in enumerate(self.live):
            for b, step in enumerate(layer[a]):
                if held is not None and step is not None and offered(reached, b, held[0] + step[0], held[1] + step[1]):
                    came[b] = a
        least = min(r[0] for r in reached if r is not None)
        audits = [r[1] for r in reached if r is not None]
        low, high = min(audits), max(audits)
        shared = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        self.live = [r and (r[0] - least, r[1][shared:]) for r in reached]
        self.base += least
        self.came.append(came)
        self.parts.append((row["part"], again))
        for name in self.totals:
            self.totals[name] += row[name]
        if again:
            self.totals["duplicate"] += 1
            self.totals["truncated"] -= row["signature"][0].isupper()
        if row["lo"] is not None:
            self.totals["turns"] -= row["lo"] == self.hi
            self.lo, self.hi = row["lo"] if self.lo is None else self.lo, row["hi"]
        if row["first"] is not None:
            self.totals["illegal"] += self.last is not None and self.last + row["first"] not in _LEGAL
            self.last, self.last_key = row["last"], row["last_key"]

    def rows(self, conv_id) -> list[dict]:
        cost, _, state = ended(self.live)
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.totals.pop("turns")
        totals = {k: v for k, v in self.totals.items() if k != "turns"} | {"gaps": gaps, "cost": self.base + cost, "parts": len(self.parts)}
        out = []
        for place, (part, again) in reversed(list(enumerate(self.parts))):
            begin = self.came[place][state]
            out.append({"part": part, "place": place, "begin": begin, "end": state, "second": again, **totals})
            state = begin
        return out


_FOLDED = "part long, place long, begin long, end long, second boolean, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, parts long"


def _folds(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, conv_id = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if fold is None or row["conv_id"] != conv_id:
                    if fold is not None:
                        yield pa.RecordBatch.from_pylist(fold.rows(conv_id), schema)
                    fold, conv_id = Fold(), row["conv_id"]
                fold.add(row)
        if fold is not None:
            yield pa.RecordBatch.from_pylist(fold.rows(conv_id), schema)

    return run


def _rewrites(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                audit = json.loads(row["again"] if row["second"] else row["layer"])[row["begin"]][row["end"]][1]
                lines = rewritten(row["roles"], row["texts"], audit, row["begin"])
                made = {name: row[name] for name in schema.names if name in row} | {"audit": audit, "repaired": "\n".join(lines), "lines": len(lines)}
                yield pa.RecordBatch.from_pylist([made], schema)

    return run


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, place long, parts long, audit string, repaired string, lines long"


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repaired conversations of ``rows`` (conv_id, turn, role, text), in parts.

    One row for each part of a conversation: conv_id, place (from 0) and parts, audit, repaired
    (``role:text`` by line) and lines of the part, and of the whole conversation gaps, blank,
    duplicate, truncated, illegal and cost.  Nearly all have one part.  Rows with a null role are
    only there to name their conversation; a null text is an empty one.

    Rows are taken by turn, null turns first; of one turn by role, the first 256 characters and
    the SHA-256 of the text, so that repeated rows are neighbours and all but the first are
    duplicates.  A null conv_id is a conversation of its own; an empty role, or one with another
    initial than s, u, a, can't be kept.  A very long text ends its block.  No rows give no rows.
    """
    spark = prepare(rows.sparkSession)
    kind = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, "
    # the last key deals equal rows, which may be many, to several partitions
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc("opening"), F.asc("content"), F.asc("spread")]
    keyed = _symbols(rows).withColumns({"opening": F.left("text", F.lit(256)), "spread": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "initial", "fault", "key")
    blocks = stage(ordered.mapInArrow(_blocks(_arrow(kind + _BLOCK, spark), block_rows), kind + _BLOCK), "conversation-blocks")
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0))
    lines = F.length(F.regexp_replace("audit", "D", "")).cast("long")
    whole = blocks.where(~F.col("open")).withColumns({"gaps": gaps, "place": F.lit(0).cast("long"), "parts": F.lit(1).cast("long"), "lines": lines})
    columns = ["conv_id", *[c.split(" ")[0] for c in _RESULT.split(", ")]]
    left = blocks.where("open")
    layers = left.drop("texts", "roles", "cost", "audit", "repaired", "open")
    folded = layers.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_folds(_arrow(_FOLDED, spark)), _FOLDED)
    rest = left.select("conv_id", "part", "layer", "again", "roles", "texts").join(folded, "part").mapInArrow(_rewrites(_arrow(kind + _RESULT, spark)), kind + _RESULT)
    return whole.select(*columns).unionByName(rest.select(*columns))


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: the parts' audits joined, and ``repaired_sha256`` of the whole text.

    A conversation of several parts is hashed part by part, in order, by the task that reads it.
    """
    spark = repaired.sparkSession
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, {', '.join(t + ' long' for t in totals)}, audit string, repaired_sha256 string"
    schema = _arrow(kind, spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audits, digest, begun = [], hashlib.sha256(), False
        for batch in batches:
            for row in batch.to_pylist():
                if row["lines"]:
                    digest.update((("\n" if begun else "") + row["repaired"]).encode())
                    begun = True
                audits.append(row["audit"])
                if row["place"] == row["parts"] - 1:
                    yield pa.RecordBatch.from_pylist([{n: row[n] for n in ("conv_id", *totals)} | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}], schema)
                    audits, digest, begun = [], hashlib.sha256(), False

    one = repaired.where("parts = 1").select("conv_id", *totals, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    more = repaired.where("parts > 1").repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, kind)
    return one.unionByName(more)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repair(damaged(table(spark, sf_dir, "conversations"))))
