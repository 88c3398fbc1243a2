import pytest

pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, docs.where("doc_id = 16").first().text)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in rows]
    assert 16 not in ids and not {0, 1, 2, 6, 7, 8, 19} & set(ids) and {10, 17} <= set(ids)
    assert all(r.round_trip and r.n_chars == len(r.text) for r in rows)
    assert rows[0].th == "own"


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame([(1, "nothing of this is in any of the given texts, not a word run of ten")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_keep_columns(spark, docs, sf_dir):
    for name, stage in pipeline.STAGES[:4]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_last_stage_makes_its_columns(spark, docs, sf_dir):
    from pyspark.sql import functions as F

    clashing = docs.withColumns({"n_pieces": F.lit("own"), "round_trip": F.lit("own"), "decoded": F.lit("own"), "rest": F.lit("own")})
    rows = pipeline.STAGES[-1][1](spark, clashing, sf_dir).collect()
    assert len(rows) == docs.count() and all(r.round_trip is True and r.decoded == r.rest == "own" and len(r.piece_ids) == 4 * r.n_pieces for r in rows)
    assert sorted(r.n_pieces for r in rows if not r.text) == [0, 0]


def test_no_documents(spark, none, sf_dir):
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name


def test_shared_folder_is_demanded_off_local_masters():
    from types import SimpleNamespace

    from leafmill.llm import common

    none_set = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: none_set))
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)
    with pytest.raises(RuntimeError):
        common.shared_dir(far)
    context.master = "local[2]"
    assert common.shared_dir(far).startswith("file://")
    far.conf.get = lambda k, d: "file:///shared/"
    assert common.shared_dir(far) == "file:///shared"


def test_stages_by_brute_force(spark, docs, tmp_path):
    """Each stage's own decisions on one small corpus, worked out without the operators."""
    import re

    rows = [r for r in docs.drop("th", "did", "label", "words", "score", "node", "kept", "_th").collect()]
    frame = spark.createDataFrame(rows, docs.drop("th", "did", "label", "words", "score", "node", "kept", "_th").schema)
    item = " ".join(rows[16].text.split()[5:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower() if (t or "").isascii() else (t or ""))
    windows = {tuple(words(item)[k : k + 10]) for k in range(len(words(item)) - 9)}
    clean = [r for r in rows if not any(tuple(words(r.text)[k : k + 10]) in windows for k in range(len(words(r.text))))]
    got = pipeline.decontamination(spark, frame, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, clean)) and len(clean) == len(rows) - 1

    raws = [(r.text or "").encode() for r in rows]
    seen = {}
    for k, raw in enumerate(raws):
        for i in range(len(raw) - 199):
            seen.setdefault(raw[i : i + 200], []).append((k, i))
    gone = [bytearray(len(raw)) for raw in raws]
    for places in seen.values():
        for k, i in places if len(places) > 1 else ():
            gone[k][i : i + 200] = b"\1" * 200
    want = []
    for r, raw, g in zip(rows, raws, gone):
        kept = bytes(b for b, x in zip(raw, g) if not x).decode("utf-8", "ignore")
        if not any(g):
            want.append((r.doc_id, r.text, r.n_chars))
        elif re.search(r"[^\x20\x09-\x0D]", kept):
            want.append((r.doc_id, kept, len(kept)))
    got = pipeline.suffix_dedup(spark, frame, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_chars) for r in got) == sorted((str(d), str(t), n) for d, t, n in want)
