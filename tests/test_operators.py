import pytest
from pyspark.sql import functions as F

from leafmill.operators import clean, context, match, merge, parse, quality, ranks, recover, render, reports, similar, tables
from leafmill.plans import chunks
from leafmill.sources import files, pdf, providers
from leafmill.streaming import state


@pytest.mark.parametrize("pages, mb, want", [(120, 10.0, [(1, 40), (41, 80), (81, 120)]), (101, 10.0, [(1, 34), (35, 68), (69, 101)]), (40, 50.5, []), (5, 160.0, [(1, 2), (3, 4), (5, 5)])])
def test_chunk_ranges(spark, pages, mb, want):
    plan = chunks.split_plan(spark.createDataFrame([("a", mb, pages)], "pdf string, size_mb double, total_pages int"))
    assert [(r.start_page, r.end_page) for r in chunks.chunk_ranges(plan).orderBy("chunk_idx").collect()] == want


def test_plan_error_rows(spark):
    plan = chunks.split_plan(spark.createDataFrame([("a", 1.0, None)], "pdf string, size_mb double, total_pages int"))
    assert plan.first().status == "error" and chunks.split_statistics(plan).first().failed_pdfs == 1


def test_exact_neighbours(spark):
    pages = spark.createDataFrame([("a", 1, "one"), ("a", 2, "two"), ("a", 4, "four")], "pdf string, page int, text string")
    rows = {r.page: (r.prev_text, r.next_text) for r in context.neighbours(pages, "pdf", "page", "text").collect()}
    assert rows == {1: (None, "two"), 2: ("one", None), 4: (None, None)}
    shown = context.context_window(context.neighbours(pages, "pdf", "page", "text"), "minimal").where("page = 1").first()
    assert (shown.prev_context, shown.next_context) == ("N/A", "two")


def test_page_split(spark):
    md = "# T\n\n---\n\n## Page 1\n\nabc\n\n## Page 2\n\n\n## Page 3\n\nxyz"
    rows = render.split_pages(spark.createDataFrame([("a", md), ("b", "## Page 1\n\n### Table 1: x\n\nfoo\n## Page 2\n\nbar"), ("c", "no pages")], "pdf string, markdown string")).collect()
    assert [(r.pdf, r.page_num, r.text) for r in rows] == [("a", 1, "abc"), ("a", 3, "xyz"), ("b", 1, "### Table 1: x\n\nfoo"), ("b", 2, "bar")]


def test_flags_and_issues(spark):
    rows = spark.createDataFrame([("a | b | c |\n|---|---|",), ("$x$ and ![a](b)",), ("```\ncode\n```" + "z" * 20,), ("",)], "text string")
    got = quality.page_flags(rows).withColumn("issues", quality.page_issues(F.col("text"))).collect()
    assert [(r.has_table, r.has_formula, r.has_image, r.has_code) for r in got] == [(True, False, False, False), (False, True, True, False), (False, False, False, True), (False, False, False, False)]
    assert [r.issues for r in got] == [["short"], ["short"], ["short", "repeated"], ["blank"]]


def test_offsets(spark):
    plan = spark.createDataFrame([("a", f"a_{i}", i, 1 + 10 * (i - 1), 10) for i in (1, 2, 3)], "pdf string, chunk string, chunk_idx int, start_page int, pages int")
    rows = merge.with_offsets(plan, plan.where("chunk_idx != 2").select("chunk")).orderBy("chunk_idx").collect()
    assert [(r.there, r.page_offset, r.legacy_offset) for r in rows] == [(True, 0, 0), (False, 10, 10), (True, 20, 10)]


def test_tables_without_last_newline(spark):
    pages = spark.createDataFrame([(1, "### Table 1: t\n\n|a|b|\n|---|---|\n|x|1|\n|y|2|")], "page int, text string")
    found = tables.tables(pages, ["page"])
    assert (found.first().title, found.first().row_count) == ("Table 1: t", 2)
    assert [(r.header, r.raw, r.num) for r in tables.table_cells(found, ["page"]).orderBy("row", "col").collect()] == [("x", "x", None), ("b", "1", 1), ("x", "y", None), ("b", "2", 2)]


def test_formulas(spark):
    rows = clean.formulas(spark.createDataFrame([(1, "x $$a+b$$ y $c$ z $$\\frac $$ $(]$")], "pdf int, markdown string")).collect()
    assert [(r.kind, r.formula, r.missing_argument, r.unbalanced) for r in rows] == [("block", "a+b", False, False), ("block", "\\frac ", True, False), ("inline", "c", False, False), ("inline", "(]", False, True)]


def test_contents(spark):
    docs = spark.createDataFrame([(1, "# T\n## Overview\n### Results & Discussion (2024)\n")], "pdf int, markdown string")
    assert clean.contents(docs).first().toc == "- [Overview](#overview)\n  - [Results & Discussion (2024)](#results-discussion-2024)"
    text = clean.with_contents(docs).first().markdown
    assert text.startswith("# T\n\n## Contents\n\n- [Overview]") and text.endswith("(2024)\n")


def test_similarity_is_not_symmetric(spark):
    rows = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string").select(match.similarity("a", "b").alias("s")).collect()
    assert [r.s for r in rows] == [0.25, 0.5]


def test_medium_confidence_is_complete(spark):
    pages = spark.createDataFrame([("a", "ok", 1, 1, 0, 0, 5, "medium")] * 3, "pdf string, status string, figures int, metas int, tables int, formulas int, tokens int, confidence string")
    row = reports.kqi_metrics(pages, "pdf").first()
    assert row.complete_data_extraction and not row.confidence_pass and row.insertion_pass


def test_answers(spark):
    rows = spark.createDataFrame([('```json\n{"body_text": "\\alpha", "figures": [{"caption": "c", "data_series": [{"x": "1895", "Branches": 16, "Total": null}, 7], "axes": {"x": 1}}]}\n```',), ("not json",), (None,)], "raw string")
    got = parse.answers(rows).collect()
    assert [(r.parsed, r.answer.body_text) for r in got] == [(True, "\\alpha"), (False, "not json"), (False, "")]
    figure = parse.figure_metadata(parse.answers(rows), []).first()
    assert (figure.figure_number, figure.chart_title, figure.confidence_score) == ("Figure 1", "c", 0.7)
    assert figure.data_series == ['{"x":"1895","Branches":16,"Total":null}', "7"] and figure.axes == '{"x":1}' and figure.has_quantitative_data
    values = parse.series_values(parse.figure_metadata(parse.answers(rows), []), [])
    assert [(r.row, r.name, r.value) for r in values.collect()] == [(1, "x", "1895"), (1, "Branches", "16"), (1, "Total", None)]


def test_answers_are_parsed_once(spark):
    rows = spark.createDataFrame([("{}",)], "raw string")
    plan = parse.figure_metadata(parse.answers(rows), [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 2 and len(plan) < 60_000


def test_recovery_is_no_template(spark):
    pages = spark.createDataFrame([("a", 1, "old"), ("a", 2, "keep")], "pdf string, page_num int, section string")
    new = spark.createDataFrame([("a", 1, True, r"\frac \1"), ("a", 3, True, "added"), ("a", 2, False, "bad")], "pdf string, page_num int, success boolean, section string")
    rows = {r.page_num: r.section for r in recover.recovered_pages(pages, new).collect()}
    assert rows == {1: r"\frac \1", 2: "keep", 3: "added"}
    twice = new.unionByName(new.withColumn("section", F.lit("a second time")))
    assert recover.recovered_pages(pages, twice).count() == 3


def test_retry_loop():
    calls, waits = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("ConnectionError")
        return "done"

    assert providers.attempt(call, sleep=waits.append) == ("done", None) and 0.75 <= waits[0] <= 1.25 and 1.5 <= waits[1] <= 2.5
    assert providers.attempt(lambda: 1 / 0)[1].startswith("ZeroDivisionError")


def test_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("# a\n")
    (tmp_path / "QUALITY_REPORT.md").write_text("x")
    (tmp_path / "f.yaml").write_text("figures:\n- figure_number: 1\n")
    (tmp_path / "bad.yaml").write_text("a: [")
    (tmp_path / "x.validation.yaml").write_text("a: 1")
    (tmp_path / "d.pdf").write_bytes(pdf.pdf_bytes([b"one", b"two"]))
    assert [(r.pdf, r.markdown) for r in files.markdown_files(spark, str(tmp_path)).collect()] == [("a", "# a\n")]
    assert {r.name: r.json for r in files.yaml_files(spark, str(tmp_path)).collect()} == {"f": '{"figures": [{"figure_number": 1}]}', "bad": None}
    assert files.with_page_counts(files.binary_files(spark, str(tmp_path))).first().total_pages == 2
    (tmp_path / "r1.json").write_text('{"a": 1}')
    (tmp_path / "r2.json").write_text('{"a": 1}')
    assert files.json_reports(spark, [str(tmp_path / "r1.json"), str(tmp_path / "r2.json")]).count() == 1
    assert [r.name for r in files.page_images(spark.createDataFrame([("d", b"x")], "pdf string, content binary"), lambda c: [b"1", b"2", b"3"], 2).collect()] == ["page_001.png", "page_002.png"]


def test_streaming_resume(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "key long, call long, ts timestamp, ok boolean"
    make = lambda a, b: spark.range(a, b).select((F.col("id") % 2).alias("key"), F.col("id").alias("call"), F.timestamp_seconds("id").alias("ts"), F.lit(False).alias("ok"))
    make(0, 6).coalesce(1).write.parquet(source)
    state.run_available(state.new_files(spark, source, schema), target, mark)
    make(6, 10).coalesce(1).write.mode("append").parquet(source)
    state.run_available(state.new_files(spark, source, schema), target, mark)
    assert spark.read.parquet(target).count() == 10
    out, mark = str(tmp_path / "out2"), str(tmp_path / "mark2")
    state.run_available(state.circuit_breaker(state.new_files(spark, source, schema)), out, mark)
    rows = {r.key: (r.consecutive, r.disabled_until is not None) for r in spark.read.parquet(out).collect()}
    assert rows == {0: (5, True), 1: (5, True)}


def test_similarity_is_difflib_s(spark):
    from difflib import SequenceMatcher

    from leafmill.catalog import matching

    rows = matching.string_similarity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 25 and all(r.similarity == SequenceMatcher(None, r.n_name.lower(), r.r_name.lower()).ratio() for r in rows)


def test_titled_matches_by_brute_force(spark):
    import re
    from difflib import SequenceMatcher

    from leafmill.catalog import matching

    charts = [("d", 1, 2, "Branch deposits by year", ["deposits", "year"], "Table 1"), ("d", 2, 9, "Loans", ["loans"], "Table 7"), ("d", 3, 50, "Branch deposits", ["x"], "")]
    found = [("d", 1, 11, "Table 1: Branch deposits, 1895-1900", ["year", "deposits"]), ("d", 3, 12, "Table 2: Staff", ["name"]), ("d", 10, 13, "Table 7: other", ["loans", "rate"])]
    got = match.matched_tables(spark.createDataFrame(charts, "pdf string, chart int, page_num int, title string, elements array<string>, figure_number string"), spark.createDataFrame(found, "pdf string, page_num int, table int, table_title string, headers array<string>")).collect()
    words = lambda t: {w for w in re.sub(r"[^\w\s]", " ", t).lower().split() if len(w) > 2}
    jaccard = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    score = lambda c, t: 0.4 * SequenceMatcher(None, c[3].lower(), t[3].lower()).ratio() + 0.3 * jaccard(words(c[3]), words(t[3])) + 0.3 * jaccard(words(" ".join(t[4])), words(" ".join(c[4])))
    want = {}
    for c in charts:
        near = [t for t in found if abs(t[1] - c[2]) <= 1] or found
        best = max(near, key=lambda t: score(c, t))
        if score(c, best) >= 0.2 or len(near) == 1:
            want[c[1]] = best[2]
    assert {r.chart: r.table for r in got} == want and want[3] == 11
    assert matching.fill_match_titled(spark, "/root/testdata/sf0.001").count() > 0


def test_keyword_pairs_by_brute_force(spark):
    import random
    import re

    r = random.Random(4)
    vocabulary = [f"word{int(30 * r.random() ** 3)}" for _ in range(400)]
    text = lambda: " ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 14)))
    left, right = [(i, text()) for i in range(25)], [(i, text()) for i in range(40)] + [(99, None)]
    words = lambda t: {w for w in re.sub(r"[^\w\s]", " ", t or "").lower().split() if len(w) > 2}
    frames = spark.createDataFrame(left, "l_id int, t string"), spark.createDataFrame(right, "r_id int, t string")
    want = {(i, j, len(words(a) & words(b)), len(words(a) & words(b)) / len(words(a) | words(b))) for i, a in left for j, b in right if words(a) & words(b)}
    assert set(map(tuple, similar.keyword_pairs(*frames, "l_id", "r_id", "t", "t").collect())) == want
    for k in (1, 3, 1000):
        best = {(*x, n) for i, _ in left for n, x in enumerate(sorted((x for x in want if x[0] == i), key=lambda x: (-x[3], x[1]))[:k], 1)}
        assert set(map(tuple, similar.best_matches(*frames, "l_id", "r_id", "t", "t", k).collect())) == best


def test_best_matches_drop_what_cannot_win(spark, monkeypatch):
    """Long right rows that share only the common words are never compared as whole sets."""
    import random

    whole = similar.whole_sets
    r = random.Random(8)
    left = [(i, " ".join([f"rare{i}x{j}" for j in range(20)] + ["common", "usual"])) for i in range(20)]
    right = [(1000 + i, " ".join([f"rare{i % 20}x{j}" for j in r.sample(range(20), 12)] + ["common"])) for i in range(80)]
    right += [(i, " ".join(["common", "usual"] + [f"other{r.randrange(10**6)}" for _ in range(30)])) for i in range(600)] + [(5000, "common")]
    frames = spark.createDataFrame(left, "l_id int, t string"), spark.createDataFrame(right, "r_id int, t string")
    sets = lambda rows: {i: set(t.split()) for i, t in rows}
    ls, rs = sets(left), sets(right)
    want = {(i, *x) for i in ls for x in sorted(((j, len(ls[i] & rs[j]) / len(ls[i] | rs[j])) for j in rs if ls[i] & rs[j]), key=lambda x: (-x[1], x[0]))[:3]}
    compared = []
    monkeypatch.setattr(similar, "whole_sets", lambda pairs, *sets: compared.append(pairs.count()) or whole(pairs, *sets))
    got = similar.best_matches(*frames, "l_id", "r_id", "t", "t", 3)
    assert {(x.l_id, x.r_id, x.score) for x in got.collect()} == want
    assert len(compared) == 2 and compared[1] <= 20 * 5  # of 20 * 681 pairs


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_prefix_matches(spark, parts):
    import random

    from leafmill.operators.prefixes import prefix_matches

    r = random.Random(parts)
    word = lambda k: "".join(r.choice("abé") for _ in range(r.randrange(k)))
    heads = [word(6) for _ in range(60)] + ["a", "a", "aaaa", None, "ab" * 9]
    names = [(i, word(9)) for i in range(500)] + [(1000 + i, "aaaab") for i in range(400)] + [(2000, None), (2001, "")]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = prefix_matches(spark.createDataFrame([(h,) for h in heads], "head string"), spark.createDataFrame(names, "id int, name string"))
        got = sorted((x.id, x.head) for x in found.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted((i, h) for i, n in names for h in {h for h in heads if h} if n and n.startswith(h))


def test_places(spark):
    rows = spark.createDataFrame([(i * 7919 % 1000, i % 3) for i in range(1000)], "v int, g int")
    got = ranks.with_place(rows, F.desc("v")).collect()
    assert sorted((r.v, r.place) for r in got) == [(v, 1000 - v) for v in range(1000)]
    assert ranks.with_place(rows.where("v < 0"), F.asc("v")).count() == 0


def test_k_least_of_a_hot_key(spark):
    rows = spark.range(0, 60_000, 1, 8).select((F.col("id") % 100 == 0).alias("rare"), (F.col("id") * 7919 % 60_000).alias("v")).unionByName(spark.createDataFrame([(None, 5), (None, 4)], "rare boolean, v long"))
    least = ranks.k_least(rows, ["rare"], ["v"], 3)
    want = {(k, p, v) for k, vs in ((True, sorted(i * 100 * 7919 % 60_000 for i in range(600))), (False, sorted(i * 7919 % 60_000 for i in range(60_000) if i % 100)), (None, [4, 5])) for p, v in enumerate(vs[:3], 1)}
    assert {(r.rare, r.place, r.v) for r in least.collect()} == want
    plan = least._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 4  # before and after each shuffle


def test_writers(spark, tmp_path):
    folder = str(tmp_path / "out")
    documents = spark.createDataFrame([("a", "# a"), ("b b", "ü")], "pdf string, markdown string")
    files.write_files(files.document_files(documents), folder)
    assert {r.pdf: r.markdown for r in files.markdown_files(spark, folder).collect()} == {"a": "# a", "b b": "ü"}
    for text in ("second", "third"):
        files.write_files(spark.createDataFrame([("a.md", text), ("none.md", None)], "name string, content string"), folder, backup=True)
    assert (tmp_path / "out/a.md").read_text() == "third" and (tmp_path / "out/a.md.bak").read_text() == "# a" and not (tmp_path / "out/none.md").exists()
    (tmp_path / "out/QUALITY_REPORT.md").write_text("x")
    (tmp_path / "out/QUALITY_REPORT_2.md").write_text("x")
    assert {r.pdf for r in files.markdown_files(spark, folder).collect()} == {"a", "b b"}
    assert {r.pdf for r in files.markdown_files(spark, folder, recursive=True).collect()} == {"a", "b b", "QUALITY_REPORT_2"}
    figures = spark.createDataFrame([("a", 1, 1, "Fig: 1", '{"x": [1, {"y": "z"}]}'), ("a", 1, 2, "Fig: 1", '{"x": 2}')], "pdf string, page_num int, ordinal int, figure_number string, json string")
    files.write_files(files.figure_files(figures), folder)
    files.write_files(files.combined_figures(figures, "2024-01-01"), folder)
    named = {r.name: r.json for r in files.yaml_files(spark, folder, recursive=True).collect()}
    assert named["Fig_1_1_page1"] == '{"x": [1, {"y": "z"}]}' and named["Fig_1_2_page1"] == '{"x": 2}'
    assert [(r.ordinal, str(r.figure)) for r in files.figures_of(files.yaml_files(spark, folder, "figures")).collect()] == [(1, '{"x":[1,{"y":"z"}]}'), (2, '{"x":2}')]


def test_state_files(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"steps": {"convert": {"status": "in_progress", "completed": ["a"], "failed": ["b"], "pending": []}}}')
    (tmp_path / "bad.json").write_text('{"steps": {"conv')
    read = lambda n: {(r.step, r.pdf, r.status) for r in files.progress_events(files.json_state(spark, str(tmp_path / n), files.PROGRESS)).collect()}
    assert read("p.json") == {("convert", "a", "completed"), ("convert", "b", "failed")} and read("bad.json") == read("none.json") == set()
    for name in ("task1_monitor_a.json", "task1_monitor_b.json", "zz_monitor.json"):
        (tmp_path / name).write_text("{}")
    assert {r.name for r in files.monitor_summaries(spark, str(tmp_path), "task1").collect()} == {"task1_monitor_a.json", "task1_monitor_b.json"}
    assert {r.name for r in files.monitor_summaries(spark, str(tmp_path), "other").collect()} == {"zz_monitor.json"}
    assert files.retry_failures(spark, str(tmp_path)).count() == 0
    (tmp_path / "retry_1.yaml").write_text("permanent:\n- {pdf: a, page_num: 3, error: e}\nskipped: []\n")
    assert [tuple(r) for r in files.retry_failures(spark, str(tmp_path)).collect()] == [("a", 3, "e", "permanent")]
    log = str(tmp_path / "log")
    event = spark.createDataFrame([("s", "a", 1, "failed", "e")], "step string, pdf string, page_num int, status string, error string").withColumn("ts", F.current_timestamp())
    files.append_events(event, log, 1)
    files.append_events(event, log, 1)  # a replay
    assert spark.read.parquet(log).count() == 1
    files.append_events(event, log, 2)
    assert spark.read.parquet(log).count() == 2


def test_reports(spark, tmp_path):
    import json

    from leafmill.catalog import pages as page_queries
    from leafmill.catalog import reports as report_queries

    sf = "/root/testdata/sf0.001"
    total, documents = page_queries.corpus_quality(spark, sf), page_queries.pdf_quality(spark, sf)
    failures = spark.createDataFrame([("a", i, "e") for i in range(40)], "pdf string, page_num int, error string")
    text = reports.quality_report(total, documents, failures, 12.0, top=5)
    assert all(f"## {h}" in text for h in ("Page sizes", "Content", "Review", "Failed pages", "Resources", "Documents", "Advice")) and "| ... |" in text and "- ... 40 in all" in text
    texts = reports.task_reports("t", "2024-01-01", report_queries._runs(spark, sf), report_queries._pages(spark, sf))
    assert set(texts) == {"cost_summary.json", "quality_report.md", "validation_result.json"} and len(json.loads(texts["cost_summary.json"])["details"]) == 50 and "| ... |" in texts["quality_report.md"]
    files.write_texts(spark, texts, str(tmp_path / "r"))
    assert (tmp_path / "r/quality_report.md").read_text() == texts["quality_report.md"]


def test_failures_by_kind(spark):
    from leafmill.catalog import pages as page_queries

    sf = "/root/testdata/sf0.001"
    failures = spark.createDataFrame([("a" * 50, i, "e" * 60, "permanent") for i in range(40)] + [("b", i, None, "skipped") for i in range(25)], "pdf string, page_num int, error string, kind string")
    text = reports.quality_report(page_queries.corpus_quality(spark, sf), page_queries.pdf_quality(spark, sf), failures)
    assert "40 for good, 25 refused by a content check" in text and text.count("\n- " + "a" * 40 + " page ") == 30 and "- ... 40 in all" in text
    assert text.count("\n- b page ") == 20 and "- ... 25 in all" in text and "e" * 51 not in text


def test_delivery_text(spark):
    findings = spark.createDataFrame([("a", "warning", "size", f"{i:02d}") for i in range(13)] + [("b", "issue", "json", "left")], "pdf string, severity string, check string, message string")
    summary = reports.check_summary(spark.range(3), findings, 3)
    text = reports.delivery_text(summary, findings)
    assert "  ... and 3 more" in text and text.count("[a] size") == 10 and "issues: 1\n  [b] json: left" in text and text.endswith("failed with 1 issues\n")
    assert reports.delivery_text(reports.check_summary(spark.range(3), findings.limit(0), 3), findings.limit(0)).endswith("all checks passed\n")


def test_rewrite(spark, tmp_path):
    folder = tmp_path / "out"
    before = spark.createDataFrame([("a.md", "one"), ("b.md", "two"), ("c.md", None)], "name string, content string")
    files.write_files(before, str(folder))
    after = spark.createDataFrame([("a.md", "one"), ("b.md", "two!"), ("new.md", "n")], "name string, content string")
    want = {("b.md", 3, 4), ("new.md", None, 1)}
    assert set(map(tuple, files.rewrite(before, after, str(folder), dry_run=True).collect())) == want
    assert (folder / "b.md").read_text() == "two" and not (folder / "new.md").exists()
    # what is read for the old content is written in the same step
    read = spark.read.option("pathGlobFilter", "*.md").text(str(folder), wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("content"))
    assert set(map(tuple, files.rewrite(read, read.withColumn("content", F.upper("content")), str(folder), backup=True).collect())) == {("a.md", 3, 3), ("b.md", 3, 3)}
    assert (folder / "b.md").read_text() == "TWO" and (folder / "b.md.bak").read_text() == "two"


def test_marks_of_a_second_recovery(spark):
    details = spark.createDataFrame([("a", [(1, "e"), (2, "e")], (3,)), ("b", [], (0,))], "pdf string, failures array<struct<page_num:long,error:string>>, recovery_info struct<pages_recovered:int>")
    recovered = spark.createDataFrame([("a", 2, True), ("a", 2, True), ("a", 1, False), ("b", 9, True)], "pdf string, page_num long, success boolean")
    got = {r.pdf: r for r in recover.marked_failures(details, recovered, "m", "t").collect()}
    assert [tuple(x) for x in got["a"].failures] == [(1, "e", False, None, None), (2, "e", True, "m", "t")] and got["a"].recovery_info.pages_recovered == 4
    assert got["b"].failures == [] and got["b"].recovery_info.pages_recovered == 0


def test_fill_status(spark):
    metadata = spark.createDataFrame([("a", '{"x": 1, "data_extraction": {"axes": 2}}', "table", False), ("b", "{}", "table", True), ("c", "{}", "photo", False), ("d", None, None, False), ("e", "{}", "data_table", False), ("f", "{}", "table", False)], "name string, json string, image_type string, has_series boolean")
    found = spark.createDataFrame([(n, '[{"x": "1"}]') for n in "abcd"] + [("f", "[]")], "name string, series string")
    got = {r.name: (r.status, r.filled) for r in match.fill_status(metadata, found).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "filled", "b": "skipped", "c": "skipped", "d": "failed", "e": "failed", "f": "failed"}
    assert got["a"][1] == '{"x": 1, "data_extraction": {"axes": 2, "data_series": [{"x": "1"}], "has_quantitative_data": true}}' and got["b"][1] is None
    assert {r.name for r in match.fill_status(metadata, found, force=True).where("status = 'filled'").collect()} == {"a", "b"}


def test_delivery_report(spark):
    import json

    from leafmill.catalog import reports as q

    sf = "/root/testdata/sf0.001"
    text = reports.delivery_report(q.check_summary(spark, sf), q.delivery_checks(spark, sf), q.delivery_statistics(spark, sf), 5)
    report = json.loads(text)
    assert len(report["findings"]) == 5 and report["more"] == report["summary"]["issues"] + report["summary"]["warnings"] - 5 and not report["passed"]


def test_metadata_problems(spark):
    rows = spark.createDataFrame([("a", "x: [1"), ("b", "# only a comment"), ("c", "x: 1"), ("d", ""), ("VALIDATION_REPORT_1", "x: [1"), ("e", None)], "name string, text string")
    assert {(r.pdf, r.severity) for r in reports.metadata_checks(rows).collect()} == {("a", "issue"), ("b", "warning")}


def test_keys(spark):
    from leafmill.operators import progress

    rows = [("a", 0.5, 0, None), ("b", 0.9, 3, 2000), ("c", 0.9, 1, 100), ("d", 0.9, 1, 100)]
    health = spark.createDataFrame(rows, "key string, success_rate double, consecutive int, disabled_until long")
    assert tuple(progress.chosen_key(health, F.lit(500)).first()) == ("c", False)
    assert tuple(progress.chosen_key(health.where("disabled_until IS NOT NULL"), F.lit(50)).first()) == ("c", True)
    assert [(r.key, r.place) for r in progress.key_ranks(health).orderBy("place").collect()] == [("c", 1), ("d", 2), ("b", 3), ("a", 4)]
    assert providers.missing_modules({"no_such_module": "x", "json": "y"}) == ["no_such_module (x)"]


def test_batches_as_completed(spark, tmp_path):
    schema, taken = "id long", []
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    state.as_completed(state.new_files(spark, str(tmp_path / "in"), schema), lambda batch, n: taken.append((n, batch.count())), str(tmp_path / "c"))
    assert taken == [(0, 5)] and state.restart("/x/c/").startswith("/x/c-")
