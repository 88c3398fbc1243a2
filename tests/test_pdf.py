"""PDF structure, where counting page objects is wrong."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.sources import files, pdf


def written(objects, at=0, extra=b"", before=b"%PDF-1.7\n"):
    """Objects (number -> bytes) with a cross-reference table and trailer, behind ``before``."""
    out, places = before, {}
    for n, body in objects.items():
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    start = len(out)
    out += b"xref\n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, p) for n, p in places.items())
    return out + b"trailer\n<< /Size 99 /Root 1 0 R %s >>\nstartxref\n%d\n%%%%EOF\n" % (extra, start), start


def content(text):
    return b"<< /Length %d >>\nstream\n%s\nendstream" % (len(text), text)


def plain(pages, box=b"[0 0 200 100]"):
    kids = b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(pages))
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [%s] /Count %d /MediaBox %s >>" % (kids, pages, box)}
    for i in range(pages):
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R /Title (a \\) /Type /Page ) >>" % (11 + 2 * i)
        objects[11 + 2 * i] = content(b"page %d" % (i + 1))
    return objects


def pattern_count(data):
    return len(re.findall(rb"/Type\s*/Page[^s]", data))


def test_incremental_update():
    first, start = written(plain(5))
    assert pdf.page_count(first) == 5 and pattern_count(first) == 10  # the titles count there
    # two pages go, one is written anew: the old objects are still in the file
    second, _ = written({2: b"<< /Type /Pages /Kids [10 0 R 12 0 R 14 0 R] /Count 3 >>", 12: b"<< /Type /Page /Parent 2 0 R >>"}, extra=b"/Prev %d" % start, before=first)
    assert pdf.page_count(second) == 3


def compressed(pages):
    """Pages in an object stream, places in a cross-reference stream with a predictor."""
    inner = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Kids [%s] /Type /Pages >>" % b" ".join(b"%d 0 R" % (10 + i) for i in range(pages))} | {10 + i: b"<< /Parent 2 0 R /Type\n/Page >>" for i in range(pages)}
    head, body = b"", b""
    for n, o in inner.items():
        head += b"%d %d " % (n, len(body))
        body += o + b" "
    stream = zlib.compress(head + body)
    out = b"%PDF-1.7\n"
    at5 = len(out)
    out += b"5 0 obj\n<< /Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d >>\nstream\r\n%s\nendstream\nendobj\n" % (len(inner), len(head), len(stream), stream)
    at6 = len(out)
    rows = {5: (1, at5, 0), 6: (1, at6, 0)} | {n: (2, 5, i) for i, n in enumerate(inner)}
    raw, above = b"", bytes(5)
    for n in sorted(rows):
        kind, a, b = rows[n]
        row = bytes([kind]) + a.to_bytes(3) + bytes([b])
        raw += b"\x02" + bytes((x - y) % 256 for x, y in zip(row, above))
        above = row
    table = zlib.compress(raw)
    index = b" ".join(b"%d 1" % n for n in sorted(rows))
    out += b"6 0 obj\n<< /Type /XRef /Size 99 /W [1 3 1] /Index [%s] /Root 1 0 R /Filter [/FlateDecode] /DecodeParms [<< /Predictor 12 /Columns 5 >>] /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (index, len(table), table)
    return out + b"startxref\n%d\n%%%%EOF" % at6


def test_compressed():
    assert pdf.page_count(compressed(7)) == 7 and pattern_count(compressed(7)) == 0
    # without its cross-references the file is looked through
    assert pdf.page_count(compressed(7).replace(b"startxref", b"nothing")) == 7


def test_damage_and_cycles():
    objects = plain(3)
    objects[2] = b"<< /Type /Pages /Kids [10 0 R 2 0 R 12 0 R 90 0 R] >>"
    data, _ = written(objects)
    assert pdf.page_count(data) == 2
    assert pdf.page_count(data.replace(b"startxref\n", b"startxref\n9")) == 2
    assert pdf.page_count(b"") is None and pdf.page_count(b"%PDF << [ (") is None and pdf.page_count(data[:60]) is None
    nested = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Kids [3 0 R 4 0 R] >>", 3: b"<< /Kids [5 0 R] >>", 4: b"<< /Type /Page >>", 5: b"<< /Type /Page >>"}
    assert pdf.page_count(written(nested)[0]) == 2


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "large.pdf").write_bytes(written(plain(40))[0])
    (tmp_path / "deep" / "small.pdf").write_bytes(compressed(2))
    (tmp_path / "broken.pdf").write_bytes(b"%PDF nothing")
    (tmp_path / "note.txt").write_text("no pdf")
    return str(tmp_path)


def test_page_source(spark, folder):
    pdf.register(spark)
    rows = spark.read.format("pdf_pages").option("bytesPerPartition", 1000).load(folder)
    large = -(-len(written(plain(40))[0]) // 1000)
    assert large > 5 and rows.rdd.getNumPartitions() == large + 1 + 1
    got = {(r.pdf, r.page_num): (r.width, r.height, r.content) for r in rows.collect()}
    assert got == {("large", n): (200.0, 100.0, b"page %d" % n) for n in range(1, 41)} | {("small", n): (612.0, 792.0, b"") for n in (1, 2)}
    used = rows.where("pdf = 'large'").groupBy(F.spark_partition_id()).count().collect()
    assert len(used) == large and max(r["count"] for r in used) <= -(-40 // large)
    assert spark.read.format("pdf_pages").option("maxPages", 3).load(folder).count() == 5


def test_limit_reaches_the_reader(spark, folder):
    reader = pdf.PdfPageReader({"path": folder})
    assert list(reader.pushFilters([pdf.LessThanOrEqual(("page_num",), 4), pdf.EqualTo(("pdf",), "x"), pdf.LessThan(("page_num",), 4)])) and reader.limit == 3
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == 5
    pdf.register(spark)
    assert spark.read.format("pdf_pages").load(folder).where("page_num <= 2").count() == 4


def test_counts_of_files(spark, folder):
    got = {r.pdf: r.total_pages for r in files.with_page_counts(files.binary_files(spark, folder, recursive=True)).collect()}
    assert got == {"large": 40, "small": 2, "broken": None}


def test_small_pdf_files_share_a_task(spark, tmp_path):
    for k in range(500):
        (tmp_path / f"{k}.pdf").write_bytes(pdf.pdf_bytes([b"%d" % k] * (1 + k % 3)))
    (tmp_path / "broken.pdf").write_bytes(b"%PDF nothing")
    pdf.register(spark)
    rows = spark.read.format("pdf_pages").load(str(tmp_path))
    assert rows.rdd.getNumPartitions() < 40
    assert sorted((r.pdf, r.page_num, bytes(r.content)) for r in rows.collect()) == sorted((str(k), n + 1, b"%d" % k) for k in range(500) for n in range(1 + k % 3))
