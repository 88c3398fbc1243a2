"""Exactly-once log, live state, log tails, long JSON in parts."""

import io
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from leafmill.catalog import planning
from leafmill.sources import files
from leafmill.streaming import live

EVENTS = "event long, step long, pdf long, page_num long, status string, error string, second long"


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENTS).withColumn("ts", F.timestamp_seconds("second")).drop("second")


def events(seed, n, begin=0):
    r = random.Random(seed)
    return [(begin + i, r.randrange(2), r.randrange(5), r.choice([None, 1, 2, 3]), r.choice(["pending", "completed", "failed"]), r.choice([None, None, "e%d" % i]), r.randrange(1000)) for i in range(n)]


def test_a_replayed_batch_leaves_the_log_as_it_was(spark, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "ck"))
    rows = frame(spark, events(1, 50))
    rows.unionByName(rows.limit(20)).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    live.log_events(stream, log, checkpoint)
    assert live.logged(spark, log).count() == 50
    # the newest commit is lost, so the batch runs again
    newest = max(int(p.name) for p in (tmp_path / "ck/commits").iterdir() if p.name.isdigit())
    (tmp_path / f"ck/commits/{newest}").unlink()
    for crc in (tmp_path / "ck/commits").glob(f".{newest}.crc"):
        crc.unlink()
    live.log_events(stream, log, checkpoint)
    assert live.logged(spark, log).count() == 50
    # later files are added once
    more = frame(spark, events(2, 30, 50))
    more.write.mode("append").parquet(source)
    live.log_events(stream, log, checkpoint)
    assert sorted(r.status for r in live.logged(spark, log).collect()) == sorted(r.status for r in rows.unionByName(more).collect())
    assert live.logged(spark, str(tmp_path / "none")).count() == 0


def test_live_state_over_several_batches(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    given = []
    for k in range(3):  # events of any time in any batch
        batch = events(10 + k, 120, 1000 * k)
        given += batch
        frame(spark, batch).write.mode("append").parquet(source)
        live.run_live(spark.readStream.schema(frame(spark, []).schema).parquet(source), checkpoint)
    newest = lambda kind, keys: {key: max((e[6], e[0], e[4]) for e in given if (e[3] is None) == kind and tuple(e[i] for i in keys) == key)[2] for key in {tuple(e[i] for i in keys) for e in given if (e[3] is None) == kind}}
    documents = newest(True, (1, 2))
    state = live.documents(spark, checkpoint)
    assert {(r.step, r.pdf): r.status for r in state.collect()} == documents
    assert {(r.step, r.pdf, r.page_num): r.status for r in live.pages(spark, checkpoint).collect()} == newest(False, (1, 2, 3))
    for status in ("pending", "completed", "failed"):
        assert {(r.step, r.pdf) for r in state.where(F.col("status") == status).collect()} == {k for k, v in documents.items() if v == status}
    wanted = spark.createDataFrame([(0, 1), (1, 2), (9, 9)], "step long, pdf long")
    assert {(r.step, r.pdf): r.completed for r in live.is_completed(state, wanted, ["step", "pdf"]).collect()} == {k: documents.get(k) == "completed" for k in ((0, 1), (1, 2), (9, 9))}
    open_errors = {(r.step, r.pdf) for r in live.errors(spark, checkpoint).collect()}
    assert open_errors and all(any(e[5] and (e[1], e[2]) == k for e in given) for k in open_errors)


def test_a_group_calls_the_store_a_few_times_for_any_number_of_rows():
    calls = []

    class Store:
        def __init__(self, *_):
            self.held = []

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name in ("update", "put"):
                    self.held = list(args) if name == "update" else list(args[0])
                elif name in ("appendValue", "appendList"):
                    self.held += args if name == "appendValue" else args[0]
                elif name == "clear":
                    self.held = []
                elif name == "get":
                    return iter(self.held) if self.many else (self.held or [None])[0]
                return bool(self.held)

            return call

    class Handle:
        def make(self, many):
            store = Store()
            store.many = many
            return store

        getValueState = lambda self, *_: self.make(False)
        getListState = lambda self, *_: self.make(True)
        getMapState = getListState

    p = live.Progress()
    p.init(Handle())
    for n in range(3):
        calls.clear()
        rows = [Row(page_num=None if k % 3 else k, event=1000 * n + k, status="pending" if k % 3 or n else "completed", error="e" if k % 5 == 0 else None, at=k) for k in range(300)]
        rows += [Row(page_num=None, event=1000 * n + 500, status="completed", error=None, at=150 + n)]
        out = list(p.handleInputRows((1, 2), iter(rows), None))
        assert len(calls) <= 6, calls
        assert (out[0].status, out[0].done, out[0].failed) == ("pending", 100 if n == 0 else 0, 0)
    calls.clear()
    last = Row(page_num=None, event=9999, status="completed", error=None, at=250)
    assert list(p.handleInputRows((1, 2), iter([last]), None))[0].status == "pending"
    last = Row(page_num=None, event=9999, status="completed", error=None, at=295)
    late = Row(page_num=None, event=1, status="pending", error="late", at=298)
    assert list(p.handleInputRows((1, 2), iter([last]), None))[0].status == "pending"
    assert list(p.handleInputRows((1, 2), iter([Row(page_num=None, event=99999, status="completed", error=None, at=299), late]), None))[0].status == "completed"
    assert p.errors.held == []


class Counted(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"\n", b"\n\n\n", "é\nx\n\nlast".encode(), b"\n".join(b"line %d" % i for i in range(500)) + b"\n"])
def test_last_lines(text):
    whole = text.decode().split("\n")
    whole = whole[:-1] if whole[-1] == "" else whole
    for n in (1, 3, 10_000):
        for block in (1, 7, 4096):
            lines, read = files.last_lines(Counted(text), n, block)
            assert lines == whole[-n:]
            assert read <= len("\n".join(whole[-n - 1 :]).encode()) + block + 2


def test_tails_of_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.log").write_text("\n".join(f"line {i} " + "x" * 90 for i in range(50_000)))
    (tmp_path / "deep/b.log").write_text("one\ntwo\n")
    (tmp_path / "c.log").write_text("")
    rows = files.file_tails(spark, str(tmp_path), n=1000).collect()
    got = {log: [r.line for r in sorted(rows, key=lambda r: r.line_no) if r.log == log] for log in ("a.log", "b.log", "c.log")}
    assert got == {"a.log": [f"line {i} " + "x" * 90 for i in range(49_000, 50_000)], "b.log": ["one", "two"], "c.log": []}
    assert max(r.bytes_read for r in rows) < 1000 * 102 + 2 * files.TAIL_BLOCK < 50_000 * 100 / 10
    joined = files.processing_log(files.file_tails(spark, str(tmp_path), n=2), ["b.log", "a.log"]).orderBy("place").collect()
    assert [r.line[:10].strip() for r in joined] == ["== b.log =", "one", "two", "== a.log =", "line 49998", "line 49999"]


def test_mapping_in_parts(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    plan, ranges = planning.split_plan(spark, sf), planning.split_chunks(spark, sf)
    files.write_lines(files.split_mapping(plan, ranges).repartition(5), str(tmp_path / "parts"), 4)
    assert len(list((tmp_path / "parts").glob("part-*"))) > 1
    size = files.join_parts(str(tmp_path / "parts"), str(tmp_path / "mapping.json"), 100)
    text = (tmp_path / "mapping.json").read_text()
    mapping = json.loads(text)
    assert size == len(text.encode())
    assert mapping["chunks"] == [r.asDict() for r in ranges.select("pdf", "chunk_idx", "chunk", "total_chunks", "start_page", "end_page", "pages").orderBy("pdf", "chunk_idx").collect()]
    assert [d["pdf"] for d in mapping["direct"]] == [r.pdf for r in plan.where("status = 'skip'").orderBy("pdf").collect()]
    assert mapping["stats"]["total_chunks"] == ranges.count() and mapping["stats"]["total_pdfs"] == plan.count()
    none = files.split_mapping(plan.limit(0), ranges.limit(0)).orderBy("place").collect()
    assert json.loads("".join(r.line for r in none)) == {"chunks": [], "direct": [], "stats": {"total_pdfs": 0, "split_pdfs": 0, "skipped_pdfs": 0, "failed_pdfs": 0, "total_chunks": 0}}
