"""What grew faster than the input, or was left to a guess of sizes."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from leafmill.catalog import rendering
from leafmill.operators import match, tables
from leafmill.sources import files


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_delivery_names_in_order_without_their_underscores(spark, tmp_path, monkeypatch):
    # names that begin with others, with and without underscores of their own
    parts = [(k, n, b) for k, (n, b) in enumerate([("x", "B"), ("x", "B_"), ("x", "B_1"), ("x", "B1"), ("x", "B__"), ("x_", "B"), ("é", "B"), ("x", "B___a")] * 6)] + [(3_000_000 + 7 * k, "x", b) for k, b in enumerate(["B", "B_", "B1", "B_1"] * 5)]
    rows = spark.createDataFrame([(k, n, b, "t" * (1 + k % 40), 1 + k % 2) for k, n, b in parts], "p_partkey long, p_name string, p_brand string, p_type string, p_size long")
    rows.write.parquet(str(tmp_path / "part.parquet"))
    given, made = [], files.delivery_files
    monkeypatch.setattr(files, "delivery_files", lambda documents, *more: given.append(documents) or made(documents, *more))
    got = rendering.delivery_files(spark, str(tmp_path))
    assert "Broadcast" not in plan(got)
    places, want = {}, set()
    for pdf, k, b in sorted((f"{n} ({k % 7}) {b}{'_' * k}".encode(), k, b) for k, n, b in parts):
        short = re.sub("[^a-zA-Z0-9-]", "", pdf.decode()[:50].replace(" ", "-"))
        places[short] = places.get(short, 0) + 1
        name = short + (f"-{places[short]}" if places[short] > 1 else "")
        want |= {(f"{name}.md", 1 + k % 40)} | ({(f"{name}.yaml", len(b))} if k % 2 else set())
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert given[0].agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 400


def test_short_names_are_matched_without_broadcast(spark):
    chunks = [f"{'Ab' * (k % 15)}{k % 7}x{'q' * (k % 3)}_part1of2" for k in range(150)] + ["", "--"]
    chunks += ["Cd" * 8 + "1" * 9]
    deliveries = [f"{'ab' * (k % 14)}{k % 5}-X" for k in range(80)] + [f"{'ab' * (k % 9)}" for k in range(80)] + ["", "cd" * 8 + "2" * 9]
    alnum = lambda n: re.sub("[^a-zA-Z0-9]", "", re.sub(r"_part\d+of\d+$", "", n)).lower()

    def tier(c, d):
        near = c[:20] == d[:20] or (len(c) < 20 and d[:20].startswith(c)) or (len(d) < 20 and c[:20].startswith(d))
        return 1 if near else 2 if c[:15] == d[:15] else None

    want = set()
    for chunk in set(chunks):
        c = alnum(chunk)
        found = [(tier(c, alnum(d)), d) for d in deliveries if c and alnum(d) and tier(c, alnum(d))]
        want |= {(chunk, min(found)[1], min(found)[0])} if found else set()
    got = match.by_short_name(spark.createDataFrame([(x,) for x in chunks], "chunk string"), spark.createDataFrame([(x,) for x in deliveries], "delivery string"))
    assert "Broadcast" not in plan(got)
    assert {tuple(r) for r in got.collect()} == want and any(t == 2 for _, _, t in want)


def test_a_table_is_written_once_for_all_its_files(spark):
    metadata = spark.createDataFrame([(f"f{k}", [None, '{"x": 1}', "{}", "[1]"][k % 4], "photo" if k % 9 == 0 else "table", k % 7 == 0) for k in range(120)], "name string, json string, image_type string, has_series boolean")
    found = spark.createDataFrame([(f"f{k}", k % 3) for k in range(100)], "name string, table int")
    series = spark.createDataFrame([(0, '[{"x": "1"}]'), (1, "[]"), (3, '[{"x": "2"}]')], "table int, series string")
    for force in (False, True):
        got = match.fill_from_tables(metadata, found, series, force)
        want = match.fill_status(metadata, found.join(series, "table").select("name", "series"), force)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # the call of Python stands below the join that makes a copy for each file
    text = plan(got)
    assert 0 <= text.index("SortMergeJoin") < text.index("with_series(")


def test_a_task_gives_out_no_more_texts_than_its_writer_can_hold(spark, monkeypatch):
    metadata = spark.range(300).select("id", F.concat(F.lit("f"), "id").alias("name"), F.when(F.col("id") % 3 > 0, "{}").alias("json"), F.lit("table").alias("image_type"), F.lit(False).alias("has_series")).drop("id")
    series = spark.range(1).select(F.lit(7).alias("table"), F.concat(F.lit('[{"x": "'), F.repeat(F.lit("a"), F.lit(2_000_000)), F.lit('"}]')).alias("series"))
    got = match.fill_from_tables(metadata, metadata.select("name", F.lit(7).alias("table")), series)
    sizes = got.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("filled")).alias("n")).where("n > 0").collect()
    assert sum(r.n for r in sizes) > 200 * 2_000_000 and max(r.n for r in sizes) < 80 << 20
    # many parts of a text, in groups: each file gets the text once
    monkeypatch.setattr(match, "TASK_BYTES", 256)
    monkeypatch.setattr(match, "COPY_BYTES", 512)
    series = spark.createDataFrame([(k, json.dumps([{"x": "y" * k}])) for k in range(5)] + [(5, "[]")], "table int, series string")
    found = metadata.select("name", F.pmod(F.xxhash64("name"), F.lit(7)).cast("int").alias("table"))
    got = match.fill_from_tables(metadata, found, series)
    want = match.fill_status(metadata, found.join(series, "table").select("name", "series"))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_long_table_is_read_line_by_line(spark):
    row = F.repeat(F.lit("| a | 1 |\n"), F.col("n").cast("int"))
    text = F.concat(F.lit("### Table 1: x\n\n| h | k |\n|---|---|\n"), row, F.lit("### Table 2\n| h | k |\n|---|---|\n"), row, F.lit("end\n### Table 3\nnone"))
    got = tables.tables(spark.createDataFrame([(0,), (1,), (5000,)], "n long").withColumn("text", text), ["n"])
    assert sorted((r.n, r.ordinal, r.title, r.row_count) for r in got.collect()) == [(n, i + 1, t, n) for n in (0, 1, 5000) for i, t in enumerate(["Table 1: x", "Table 2"])]
    # no place in a string is looked up for each line
    assert "sequence(" not in plan(got)


def test_libyaml_reads_and_writes_what_pyyaml_does(monkeypatch):
    yaml = pytest.importorskip("yaml")
    r = random.Random(3)
    signs = ["a", "b:", " ", "- ", "\n", "#", "'", '"', "é", "[", "]", "{", "}", ",", "1", "1e3", "true", "~", "2024-01-01", ":", "|", ">", "&x", "*x", "%", "\n  ", "!", "?", "=", "<<", "---", "\\", "\t", "\x85", "12:30", "word word word word word word"]

    def read(f, text):
        try:
            return json.dumps(f(text), default=str)
        except (yaml.YAMLError, ValueError, TypeError) as e:
            return str(e)

    def some(depth=0):
        kind = r.randrange(7 if depth < 3 else 4)
        if kind < 4:
            return r.choice([1, 1.5, None, True, "".join(r.choices(signs, k=r.randrange(20)))])
        return [some(depth + 1) for _ in range(kind)] if kind == 4 else {"".join(r.choices(signs, k=r.randrange(4))): some(depth + 1) for _ in range(kind)}

    for _ in range(20_000):
        text = "".join(r.choices(signs, k=r.randrange(12)))
        assert read(files._load, text) == read(yaml.safe_load, text), text
    for _ in range(2_000):
        value = some()
        assert files._dumped(json.dumps(value, ensure_ascii=False)) == yaml.safe_dump(value, allow_unicode=True, sort_keys=False, default_flow_style=False)
    # a long file takes the short way
    long = {"page_by_page_results": [{"page_num": k, "success": True, "error": "TimeoutError: read"} for k in range(20)]}
    text = yaml.safe_dump(long, sort_keys=False)
    for slow in ("safe_load", "SafeDumper"):
        monkeypatch.setattr(yaml, slow, None)
    assert files._load(text) == long and files._dumped(json.dumps(long)) == text


def test_metadata_is_checked_on_all_cores_and_read_once(spark):
    from leafmill.catalog import reports

    sf = "/root/testdata/sf0.001"
    assert reports.metadata_checks(spark, sf).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert len(re.findall(r"ArrowEvalPython \[", plan(reports.metadata_checks(spark, sf)))) == 1
    # the filter on what was read calls Python no second time
    assert plan(reports.recovered_validation(spark, sf)).count("yaml_to_json(") == 0


def test_batches_for_python_are_bounded_by_bytes(spark):
    from leafmill import catalog

    catalog.load()
    catalog.QUERIES["cleaned_documents"](spark, "/root/testdata/sf0.001")
    rows = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), F.lit(100_000)).alias("t"))
    sizes = [r.n for r in rows.mapInPandas(lambda batches: (b[["t"]].iloc[:1].assign(n=len(b))[["n"]] for b in batches), "n long").collect()]
    assert sum(sizes) == 400 and max(sizes) * 100_000 <= catalog.BATCH_BYTES + 200_000
