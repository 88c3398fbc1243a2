"""Fill-in-the-middle: texts cut at two unit ranks and rearranged around sentinels, as ropes.

A unit is a run of ASCII letters or one other code point.  A rope is a binary tree over pieces of
text; leaves and nodes cache how many units and code points they hold, so that both cuts, the
rearrangement and its inverse walk one path of the tree and copy no text but that of one leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, table, text_chunks

#: Units of a leaf.
LEAF_UNITS = 1024
#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def unit_starts(text: str) -> np.ndarray:
    """Code-point offsets at which a unit begins."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (((points | 32) - 97) < 26) & (points < 128)
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    begins[:1] = True
    return np.flatnonzero(begins)


class Leaf:
    __slots__ = ("points", "text", "units")

    def __init__(self, text: str, units: int | None = None):
        self.text, self.points = text, len(text)
        self.units = len(unit_starts(text)) if units is None else units

    def cut(self, rank: int, by: str) -> tuple[Leaf, Leaf]:
        at = rank if by == "points" else int(unit_starts(self.text)[rank])
        left, right = self.text[:at], self.text[at:]
        return (Leaf(left), Leaf(right)) if by == "points" else (Leaf(left, rank), Leaf(right, self.units - rank))


class Node:
    __slots__ = ("left", "points", "right", "units")

    def __init__(self, left: Rope, right: Rope):
        self.left, self.right = left, right
        self.units, self.points = left.units + right.units, left.points + right.points


Rope = Leaf | Node


def rope(text: str, leaf_units: int = LEAF_UNITS) -> Rope:
    """A balanced tree over ``text``; every leaf begins at a unit."""
    starts = unit_starts(text)
    edges = [*starts[::leaf_units].tolist(), len(text)]
    level: list[Rope] = [Leaf(text[a:b], min(leaf_units, len(starts) - i * leaf_units)) for i, (a, b) in enumerate(zip(edges, edges[1:]))] or [Leaf("", 0)]
    while len(level) > 1:
        level = [Node(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def join(*ropes: Rope | None) -> Rope:
    """The ropes one after the other, as one."""
    whole = None
    for part in ropes:
        if part is not None and part.points:
            whole = part if whole is None else Node(whole, part)
    return whole or Leaf("", 0)


def split(tree: Rope, rank: int, by: str = "units") -> tuple[Rope, Rope]:
    """The first ``rank`` units (or code points) and the rest."""
    before, after = [], []  # subtrees left of the path, from the top; right of it, from the top
    while isinstance(tree, Node) and 0 < rank < getattr(tree, by):
        here = getattr(tree.left, by)
        if rank < here:
            after.append(tree.right)
            tree = tree.left
        else:
            before.append(tree.left)
            tree, rank = tree.right, rank - here
    if rank <= 0:
        after.append(tree)
    elif rank >= getattr(tree, by):
        before.append(tree)
    else:
        left, right = tree.cut(rank, by)
        before.append(left)
        after.append(right)
    return join(*before), join(*reversed(after))


def flat(tree: Rope) -> str:
    parts, todo = [], [tree]
    while todo:
        tree = todo.pop()
        if isinstance(tree, Node):
            todo += [tree.right, tree.left]
        else:
            parts.append(tree.text)
    return "".join(parts)


def arranged(tree: Rope, first: int, second: int, form: str) -> tuple[str, int, int]:
    """(the rearranged text, code points of prefix and of middle) for cuts after ``first`` and ``second`` units."""
    head, suffix = split(tree, second)
    prefix, middle = split(head, first)
    mark = {m: Leaf(m, 3) for m in (PREFIX, SUFFIX, MIDDLE)}
    outer = [mark[PREFIX], prefix, mark[SUFFIX], suffix] if form == PSM else [mark[SUFFIX], suffix, mark[PREFIX], prefix]
    return flat(join(*outer, mark[MIDDLE], middle)), prefix.points, middle.points


def restored(output: str, form: str) -> str:
    """The text that ``arranged`` was given: the tree of its output split at the sentinels, which stand once each."""
    if form == PLAIN:
        return output
    inner, last = output.index(SUFFIX if form == PSM else PREFIX), output.index(MIDDLE)
    head, middle = split(rope(output), last, "points")
    one, other = split(head, inner, "points")
    one, other, middle = (split(part, 3, "points")[1] for part in (one, other, middle))
    return flat(join(one, middle, other) if form == PSM else join(other, middle, one))


def _draw(seed: int, group: int) -> Column:
    """An unsigned 32-bit group of the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 1, rearranged: int = 90, suffix_first: int = 20) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output for each row of ``docs``.

    ``rearranged`` per cent of the texts are cut in three, ``suffix_first`` per cent of those with
    the suffix in front; the draw depends on seed and doc_id alone, a null doc_id counts as an
    empty one.  Null and empty texts, and texts that contain a sentinel, stay plain; equal rows
    give equal rows.  No shuffle; a very long text is one slice, other columns are left out.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            made = {"n": [], "form": [], "prefix_chars": [], "middle_chars": [], "output": []}
            for text, h1, h2, h3, h4 in zip(*(chunk.column(c).to_pylist() for c in ("text", "h1", "h2", "h3", "h4"))):
                tree = rope(text)
                plain = not text or h3 % 100 >= rearranged or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
                form = PLAIN if plain else SPM if h4 % 100 < suffix_first else PSM
                cuts = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
                output, prefix, middle = (text, None, None) if plain else arranged(tree, *cuts, form)
                for name, value in zip(made, (tree.units, form, prefix, middle, output)):
                    made[name].append(value)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array(v, t) for v, t in zip(made.values(), types))], ["doc_id", *made])

    drawn = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[_draw(seed, i).alias(f"h{i + 1}") for i in range(4)])
    return drawn.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def with_restored(made: DataFrame) -> DataFrame:
    """``made`` and the column ``restored``: the text rebuilt from ``output`` and ``form`` alone."""
    prepare(made.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "output"):
            texts = [restored(o, f) for o, f in zip(chunk.column("output").to_pylist(), chunk.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(texts, pa.string())], [*chunk.schema.names, "restored"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(run, f"{schema}, restored string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = with_restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


_GROUPS = ", ".join(f"CAST('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
ORACLE_SQL = f"""
WITH drawn AS (SELECT doc_id, text, units, len(units) AS n, {_GROUPS} FROM (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents)),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, n, form, text, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts"""
