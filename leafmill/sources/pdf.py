"""Pages of PDF files from their structure: cross-references of all revisions, object streams, the page tree.

The data source ``pdf_pages`` reads a folder of PDF files in page ranges, so that a large file is
shared by several tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, LessThan, LessThanOrEqual

_SKIP = re.compile(rb"(?:[\x00\t\n\x0c\r ]+|%[^\r\n]*)*")
_WORD = re.compile(rb"[^\x00\t\n\x0c\r \[\]<>(){}/%]*")
_REF = re.compile(rb"(\d+)[\x00\t\n\x0c\r ]+\d+[\x00\t\n\x0c\r ]+R(?![^\x00\t\n\x0c\r \[\]<>(){}/%])")
_OBJECT = re.compile(rb"(\d+)[\x00\t\n\x0c\r ]+\d+[\x00\t\n\x0c\r ]+obj\b")


class Ref(int):
    """The number of an object that stands elsewhere."""


def value(data: bytes, at: int) -> tuple[object, int]:
    """(the object at a place, the place behind it): dicts and lists, names with their slash, numbers, refs, bytes for strings."""
    at = _SKIP.match(data, at).end()
    head = data[at : at + 1]
    if data[at : at + 2] == b"<<" or head == b"[":
        items, end = [], b">>" if head == b"<" else b"]"
        at += len(end)
        while data[(at := _SKIP.match(data, at).end()) : at + len(end)] != end:
            item, at = value(data, at)
            items.append(item)
        return (dict(zip(items[::2], items[1::2])) if head == b"<" else items), at + len(end)
    if head == b"<":
        end = data.index(b">", at)
        return b"", end + 1  # strings are no part of the structure
    if head == b"(":
        depth, at = 1, at + 1
        while depth:
            c = data[at]  # beyond the end: an IndexError, as for any damage
            depth += (c == 40) - (c == 41)
            at += 2 if c == 92 else 1
        return b"", at
    if head == b"/":
        end = _WORD.match(data, at + 1).end()
        return data[at:end].decode("latin-1"), end
    if ref := _REF.match(data, at):
        return Ref(ref[1]), ref.end()
    word = _WORD.match(data, at)
    if word.end() == at:
        raise ValueError(f"no object at {at}")
    try:
        return (float(word[0]) if b"." in word[0] else int(word[0])), word.end()
    except ValueError:
        return word[0].decode("latin-1"), word.end()


def unpredicted(raw: bytes, columns: int) -> bytes:
    """Rows of a PNG-predicted stream with one byte for a sample, as cross-reference streams have them."""
    rows = np.frombuffer(raw[: len(raw) // (columns + 1) * (columns + 1)], np.uint8).reshape(-1, columns + 1)
    above = np.zeros(columns, np.uint8)
    out = []
    for kind, row in zip(rows[:, 0].tolist(), rows[:, 1:]):
        if kind == 2:
            row = row + above
        elif kind == 1:
            row = np.cumsum(row, dtype=np.uint8)
        elif kind:
            raise ValueError(f"predictor {kind}")
        above = row
        out.append(row.tobytes())
    return b"".join(out)


class Pdf:
    """Objects of a file's newest revision, found by number; damage ends in ValueError, IndexError, KeyError or zlib.error."""

    def __init__(self, data: bytes):
        self.data, self.places, self.trailer, self._streams = data, {}, {}, {}
        try:
            self._revisions(int(re.findall(rb"startxref\s*(\d+)", data[-2048:])[-1]))
            self.object(self.trailer["/Root"])["/Pages"]
        except (ValueError, IndexError, KeyError, TypeError, zlib.error):
            self._rebuilt()

    def _revisions(self, newest: int) -> None:
        todo, seen = [newest], set()
        while todo:
            at = todo.pop(0)
            if at in seen or not 0 <= at < len(self.data):
                continue
            seen.add(at)
            at = _SKIP.match(self.data, at).end()
            trailer = self._table(at + 4) if self.data[at : at + 4] == b"xref" else self._stream_of_places(at)
            self.trailer = trailer | self.trailer  # what a newer revision says holds
            todo += [trailer[k] for k in ("/XRefStm", "/Prev") if k in trailer]

    def _table(self, at: int) -> dict:
        while True:
            first, at = value(self.data, at)
            if first == "trailer":
                return value(self.data, at)[0]
            n, at = value(self.data, at)
            for number in range(first, first + n):
                offset, at = value(self.data, at)
                _, at = value(self.data, at)
                kind, at = value(self.data, at)
                if number not in self.places:
                    self.places[number] = ("at", offset) if kind == "n" else None

    def _stream_of_places(self, at: int) -> dict:
        head, raw = self._at(at, None)
        widths = head["/W"]
        index = head.get("/Index", [0, head["/Size"]])
        numbers = [n for first, count in zip(index[::2], index[1::2]) for n in range(first, first + count)]
        size = sum(widths)
        for number, i in zip(numbers, range(0, len(raw) - size + 1, size)):
            fields, begin = [], i
            for k, w in enumerate(widths):
                fields.append(int.from_bytes(raw[begin : begin + w]) if w else (1 if k == 0 else 0))
                begin += w
            if number not in self.places:
                self.places[number] = ("at", fields[1]) if fields[0] == 1 else ("in", fields[1], fields[2]) if fields[0] == 2 else None
        return head

    def _rebuilt(self) -> None:
        """Places by looking for objects; the last one of a number counts, those in object streams before it."""
        self.places, self.trailer, self._streams = {m[1]: ("at", m[0]) for m in ((m.start(), int(m[1])) for m in _OBJECT.finditer(self.data))}, {}, {}
        for number in list(self.places):
            try:
                found = self.object(Ref(number))
            except (ValueError, IndexError, KeyError, TypeError, zlib.error):
                continue
            if isinstance(found, dict) and found.get("/Type") == "/ObjStm":
                for i, inner in enumerate(self._in_stream(number)[0]):
                    self.places.setdefault(inner, ("in", number, i))
        for number in self.places:
            try:
                found = self.object(Ref(number))
            except (ValueError, IndexError, KeyError, TypeError, zlib.error):
                continue
            if isinstance(found, dict) and found.get("/Type") == "/Catalog":
                self.trailer = {"/Root": Ref(number)}

    def _at(self, at: int, number: int | None) -> tuple[object, bytes | None]:
        """(object, decoded stream or None) at a place."""
        head = _OBJECT.match(self.data, _SKIP.match(self.data, at).end())
        if not head or number not in (None, int(head[1])):
            raise ValueError(f"object {number} is not at {at}")
        found, at = value(self.data, head.end())
        at = _SKIP.match(self.data, at).end()
        if not isinstance(found, dict) or self.data[at : at + 6] != b"stream":
            return found, None
        at += 8 if self.data[at + 6 : at + 8] == b"\r\n" else 7
        return found, self._decoded(found, self.data[at : at + self.object(found["/Length"])])

    def _decoded(self, head: dict, raw: bytes) -> bytes:
        filters, settings = self.object(head.get("/Filter")) or [], self.object(head.get("/DecodeParms")) or {}
        filters = filters if isinstance(filters, list) else [filters]
        settings = settings if isinstance(settings, list) else [settings] * len(filters)
        for name, setting in zip(filters, settings):
            if name not in ("/FlateDecode", "/Fl"):
                return raw  # pictures and the like stay as they are
            raw = zlib.decompressobj().decompress(raw)
            setting = self.object(setting) or {}
            if setting.get("/Predictor", 1) >= 10:
                raw = unpredicted(raw, setting.get("/Columns", 1))
        return raw

    def _in_stream(self, number: int) -> tuple[list[int], list[int], bytes]:
        """(numbers, places, bytes) of an object stream."""
        if number not in self._streams:
            head, raw = self._at(self.places[number][1], number)
            pairs = [int(x) for x in raw[: head["/First"]].split()[: 2 * head["/N"]]]
            self._streams = {number: (pairs[::2], [head["/First"] + p for p in pairs[1::2]], raw)}  # one is held
        return self._streams[number]

    def object(self, thing: object) -> object:
        """The object behind a reference; anything else as it is."""
        seen = set()
        while isinstance(thing, Ref):
            place = self.places.get(int(thing))
            if place is None or int(thing) in seen:
                return None
            seen.add(int(thing))
            if place[0] == "at":
                thing = self._at(place[1], int(thing))[0]
            else:
                numbers, places, raw = self._in_stream(place[1])
                thing = value(raw, places[numbers.index(int(thing))])[0]
        return thing

    def content(self, page: dict) -> bytes:
        """The page's drawing instructions."""
        parts = self.object(page.get("/Contents"))
        refs = parts if isinstance(parts, list) else [page.get("/Contents")]
        return b"\n".join(self._at(self.places[int(r)][1], int(r))[1] or b"" for r in refs if isinstance(r, Ref) and self.places.get(int(r)))

    def pages(self) -> Iterator[dict]:
        """Page objects in order, with the media box they inherit; a node met before is cut off."""
        todo, seen = [(self.object(self.trailer.get("/Root")) or {}).get("/Pages")], set()
        todo = [(todo[0], None)]
        while todo:
            ref, box = todo.pop()
            node = self.object(ref)
            if not isinstance(node, dict) or (isinstance(ref, Ref) and int(ref) in seen):
                continue
            seen.add(int(ref) if isinstance(ref, Ref) else None)
            box = node.get("/MediaBox", box)
            kids = self.object(node.get("/Kids"))
            if kids is None:
                yield node | {"/MediaBox": box}
            else:
                todo += [(kid, box) for kid in reversed(kids)]


def page_count(data: bytes) -> int | None:
    """Pages of a PDF; None where no page tree can be read."""
    try:
        return sum(1 for _ in Pdf(data).pages()) or None
    except (ValueError, IndexError, KeyError, TypeError, zlib.error):
        return None


@dataclass
class PageRange(InputPartition):
    """Shares of the pages of some files: (path, the k-th, of how many) each."""

    shares: list[tuple[str, int, int]]


#: Bytes that opening a file counts for, and the partitions that are aimed at while the files are few.
OPEN_COST = 1 << 14
LEAST_PARTITIONS = 32


class PdfPageReader(DataSourceReader):
    """Files are dealt by size alone: large ones in shares, small ones several to a task.  A task finds out which pages its share has."""

    def __init__(self, options: dict):
        self.folder, self.share = options["path"], int(options.get("bytesPerPartition", 64 << 20))
        self.limit = int(options.get("maxPages", 0)) or None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802  the interface's name
        for f in filters:
            if isinstance(f, LessThanOrEqual | LessThan | EqualTo) and f.attribute == ("page_num",):
                most = f.value - isinstance(f, LessThan)
                self.limit = most if self.limit is None else min(self.limit, most)
            yield f  # Spark tests the rows again

    def _files(self):
        from pyarrow import fs

        source, base = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder.removeprefix("file:"))
        found = source.get_file_info(fs.FileSelector(base, recursive=True))
        return source, sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".pdf"))

    def partitions(self) -> list[PageRange]:
        listed = self._files()[1]
        full = min(self.share, max(OPEN_COST, sum(size + OPEN_COST for _, size in listed) // LEAST_PARTITIONS))
        made, some, held = [], [], 0
        for path, size in listed:
            parts = max(-(-size // self.share), 1)
            if parts > 1:
                made += [PageRange([(path, k, parts)]) for k in range(parts)]
                continue
            if some and held + size + OPEN_COST > full:
                made.append(PageRange(some))
                some, held = [], 0
            some.append((path, 0, 1))
            held += size + OPEN_COST
        return made + ([PageRange(some)] if some else [])

    def read(self, partition: PageRange) -> Iterator[tuple]:
        from pyarrow import fs

        source = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()
        for path, part, parts in partition.shares:
            yield from self._read(source, path, part, parts)

    def _read(self, source: object, path: str, part: int, parts: int) -> Iterator[tuple]:
        with source.open_input_file(path) as opened:
            data = opened.read()
        name = path.rpartition("/")[2].rpartition(".")[0]
        try:
            pdf = Pdf(data)
            pages = list(pdf.pages())
        except (ValueError, IndexError, KeyError, TypeError, zlib.error):
            return
        begin, end = (len(pages) * k // parts for k in (part, part + 1))
        for n in range(begin, min(end, self.limit if self.limit is not None else end)):
            box = [float(x) for x in pdf.object(pages[n]["/MediaBox"]) or [0, 0, 612, 792]]
            try:
                content = pdf.content(pages[n])
            except (ValueError, IndexError, KeyError, TypeError, zlib.error):
                content = None
            yield name, n + 1, box[2] - box[0], box[3] - box[1], content


class PdfPages(DataSource):
    """pdf, page_num, width, height (points), content (drawing instructions) of the PDF files below a folder.

    Options: ``path``, ``maxPages`` (of each file, 0 is all), ``bytesPerPartition``.  A limit on
    ``page_num`` in a filter reaches the reader too.
    """

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return "pdf string, page_num int, width double, height double, content binary"

    def reader(self, schema) -> PdfPageReader:
        return PdfPageReader(self.options)


def pdf_bytes(contents: list[bytes], width: int = 612, height: int = 792) -> bytes:
    """A PDF with one page for each of the drawing instructions."""
    n = len(contents)
    bodies = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Count %d /Kids [%s] /MediaBox [0 0 %d %d] >>" % (n, b" ".join(b"%d 0 R" % (3 + 2 * i) for i in range(n)), width, height)]
    for i, content in enumerate(contents):
        bodies += [b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (4 + 2 * i), b"<< /Length %d >>\nstream\n%s\nendstream" % (len(content), content)]
    out, places = [b"%PDF-1.7\n"], []
    size = len(out[0])
    for number, body in enumerate(bodies, 1):
        places.append(size)
        out.append(b"%d 0 obj\n%s\nendobj\n" % (number, body))
        size += len(out[-1])
    table = b"0000000000 65535 f \n" + b"".join(b"%010d 00000 n \n" % p for p in places)
    return b"".join([*out, b"xref\n0 %d\n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(places) + 1, table, len(places) + 1, size)])


def register(spark: SparkSession) -> None:
    """Make ``pdf_pages`` known to the session; its filters are pushed down, which Spark wants to be told."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PdfPages)
