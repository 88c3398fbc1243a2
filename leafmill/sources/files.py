"""Readers and writers for document folders."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from leafmill.functions import text as T
from leafmill.operators.ranks import with_place
from leafmill.sources.pdf import page_count, pdf_bytes
from leafmill.sources.shared import fresh_path, stage

# Fixed value: names of report files, which are no documents.
REPORT = "QUALITY_REPORT"
# File name patterns of metadata by kind, and of files that are none.
METADATA = {"tables": "Table*.yaml", "figures": "*_all_figures.yaml", "validation": "*.validation.yaml", "any": "*.yaml"}
NO_METADATA = r"^(?:QUALITY|VALIDATION)|\.validation$"


def binary_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """pdf (name without ending), path, size_mb, content of files.  Not sorted: sort after ``content`` is gone."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return rows.select(name.alias("pdf"), "path", (F.col("length") / 1048576.0).alias("size_mb"), "content")


@pandas_udf(IntegerType())
def page_counts(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else page_count(bytes(b))).astype("Int32")


@pandas_udf(BinaryType())
def pdf_of_texts(texts: pd.Series) -> pd.Series:
    """A PDF for each list of texts, one page each."""
    return texts.map(lambda t: pdf_bytes([x.encode() for x in t]))


def with_page_counts(files: DataFrame) -> DataFrame:
    """``binary_files`` rows with total_pages in place of content, in order of path."""
    return files.withColumn("total_pages", page_counts("content")).drop("content").orderBy("path")


def markdown_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """pdf, markdown of the ``.md`` files: without those whose name begins like a report's, or, read
    recursively, without the report itself."""
    rows = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", str(recursive).lower()).text(folder, wholetext=True)
    name = F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\.md$", ""))
    kept = name != REPORT if recursive else ~name.startswith(REPORT)
    return rows.select(name.alias("pdf"), F.col("value").alias("markdown"), kept.alias("_kept")).where("_kept").drop("_kept")


# Texts that libyaml and PyYAML read, and JSON that they write, in the same way (they differ in tabs, tags, block
# scalars, ``?``, signs beyond ASCII, bare scalars, empty keys).
_READ_ALIKE = re.compile(r"[\n\x20\x22-\x24\x26-\x3D\x40-\x7B\x7D\x7E]*")
_WRITTEN_ALIKE = re.compile(r"[{\[](?:(?!\"\":)[\x20-\x5B\x5D-\x7E])*")


def _load(text: str) -> object:
    """What PyYAML reads, by libyaml where that gives the same in a tenth of the time; what it refuses is left to PyYAML."""
    import yaml

    if yaml.__with_libyaml__ and _READ_ALIKE.fullmatch(text):
        try:
            return yaml.load(text, yaml.CSafeLoader)
        except (yaml.YAMLError, ValueError, TypeError):
            pass
    return yaml.safe_load(text)


def _dumped(text: str) -> str:
    """JSON text as YAML, by libyaml under the same condition."""
    import yaml

    dumper = yaml.CSafeDumper if yaml.__with_libyaml__ and _WRITTEN_ALIKE.fullmatch(text) else yaml.SafeDumper
    return yaml.dump(json.loads(text), Dumper=dumper, allow_unicode=True, sort_keys=False, default_flow_style=False)


def _loaded(text: str | None) -> tuple[str | None, str | None]:
    import yaml

    try:
        return (json.dumps(_load(text), default=str) if text is not None else None), None
    except yaml.YAMLError as e:
        return None, " ".join(str(e).split())
    except (TypeError, ValueError) as e:
        return None, f"{type(e).__name__}: {e}"


@pandas_udf(StructType([StructField("json", StringType()), StructField("error", StringType())]))
def yaml_read(text: pd.Series) -> pd.DataFrame:
    """YAML as JSON, and why it can't be read, in one reading."""
    return pd.DataFrame(text.map(_loaded).tolist(), columns=["json", "error"])


@pandas_udf(StringType())
def yaml_to_json(text: pd.Series) -> pd.Series:
    """YAML as JSON; null where it can't be read."""
    return text.map(lambda t: _loaded(t)[0])


@pandas_udf(StringType())
def json_to_yaml(text: pd.Series) -> pd.Series:
    """JSON as YAML, keys in their order."""
    return text.map(lambda t: None if t is None else _dumped(t))


def yaml_texts(spark: SparkSession, folder: str, kind: str = "any", recursive: bool = False) -> DataFrame:
    """name, text of YAML files of a kind (see ``METADATA``)."""
    rows = spark.read.option("pathGlobFilter", METADATA[kind]).option("recursiveFileLookup", str(recursive).lower()).text(folder, wholetext=True)
    return rows.select(F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\.ya?ml$", "")).alias("name"), F.col("value").alias("text"))


def yaml_files(spark: SparkSession, folder: str, kind: str = "any", recursive: bool = False) -> DataFrame:
    """name, json, value (variant; null where the file can't be read) of YAML files; of ``any`` kind without reports and validations."""
    named = yaml_texts(spark, folder, kind, recursive)
    if kind == "any":
        named = named.where(~F.col("name").rlike(NO_METADATA))
    return named.select("name", yaml_to_json("text").alias("json")).withColumn("value", F.try_parse_json("json"))


def figures_of(files: DataFrame) -> DataFrame:
    """name, ordinal, figure (variant) of combined metadata, both a bare list and one under ``figures``."""
    listed = F.coalesce(F.try_variant_get("value", "$.figures", "array<variant>"), F.try_variant_get("value", "$", "array<variant>"))
    return files.select("name", F.posexplode(listed).alias("i", "figure")).select("name", (F.col("i") + 1).alias("ordinal"), "figure")


def json_reports(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """Whole JSON files of several patterns; files of later patterns with equal content once."""
    found = None
    for pattern in patterns:
        rows = spark.read.text(pattern, wholetext=True).select(F.col("value").alias("json"))
        found = rows if found is None else found.unionByName(rows.join(found.distinct(), "json", "left_anti").distinct())
    return found


def json_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON file (a mapping, progress, a list of blocked pages): none if it is missing or can't be read."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
        # all columns are read beside the corrupt one, which Spark asks for
        return rows.select(F.struct(*[F.col(c) for c in rows.columns]).alias("r")).where("r._corrupt IS NULL").select("r.*").drop("_corrupt")
    except AnalysisException:
        return spark.createDataFrame([], schema)


PROGRESS = "steps map<string,struct<status:string,completed:array<string>,failed:array<string>,pending:array<string>>>"


def progress_events(state: DataFrame) -> DataFrame:
    """step, pdf, status of a progress file (``PROGRESS``); a fresh state has none."""
    lists = F.array(*[F.struct(F.lit(s).alias("status"), F.col(f"v.{s}").alias("pdfs")) for s in ("completed", "failed", "pending")])
    rows = state.select(F.explode("steps").alias("step", "v")).select("step", F.explode(lists).alias("l"))
    return rows.select("step", F.explode("l.pdfs").alias("pdf"), "l.status")


def monitor_summaries(spark: SparkSession, folder: str, task: str) -> DataFrame:
    """name, json of the monitor files whose name begins with the task, else of the one that is last by name."""
    rows = spark.read.option("pathGlobFilter", "*monitor*.json").text(folder, wholetext=True)
    rows = rows.select(F.url_decode(F.col("_metadata.file_name")).alias("name"), F.col("value").alias("json"))
    own = rows.where(F.col("name").startswith(task))
    return own if not own.isEmpty() else rows.orderBy(F.desc("name")).limit(1)


def retry_failures(spark: SparkSession, folder: str) -> DataFrame:
    """pdf, page_num, error, kind (permanent or skipped) of ``*retry*`` files in JSON or YAML; none if there are none."""
    rows = spark.read.option("pathGlobFilter", "*retry*.{json,yaml,yml}").text(folder, wholetext=True).select(yaml_to_json("value").alias("json"))
    one = "array<struct<pdf:string,page_num:int,error:string>>"
    value = F.from_json("json", f"permanent {one}, skipped {one}")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), value[k].alias("l")) for k in ("permanent", "skipped")])
    each = rows.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.l").alias("x"))
    return each.select("x.pdf", "x.page_num", "x.error", "kind")


def log_tail(lines: DataFrame, key: str, order: str, n: int = 1000) -> DataFrame:
    """The last ``n`` lines of each log."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return lines.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


#: Bytes of a log that are read at once, from its end backwards.
TAIL_BLOCK = 1 << 16


def last_lines(opened: object, n: int, block: int = TAIL_BLOCK) -> tuple[list[str], int]:
    """(the last n lines of an opened file, bytes read), by blocks from the end; a last line break ends no line."""
    at, parts, breaks, read = opened.size(), [], 0, 0
    while at > 0 and breaks <= n:  # one break more than lines: the one before the first of them
        size = min(block, at)
        at -= size
        parts.append(opened.read_at(size, at))
        read += size
        breaks += parts[-1].count(b"\n")
    lines = b"".join(reversed(parts)).decode("utf-8", "replace").split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    return lines[-n:] if n else [], read


def file_tails(spark: SparkSession, folder: str, pattern: str = "*.log", n: int = 1000) -> DataFrame:
    """log (file name), line_no (from 1, of the tail), line, bytes_read of the last ``n`` lines of each file.

    Only names and sizes are listed by Spark; a task seeks to the end of its files and reads back
    as far as it must.  Files are dealt one by one, an empty one has no rows.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).where("length > 0").select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                source, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
                with source.open_input_file(inside) as opened:
                    lines, read = last_lines(opened, n)
                yield pd.DataFrame({"log": path.rpartition("/")[2], "line_no": range(1, len(lines) + 1), "line": lines, "bytes_read": read})

    return listed.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(run, "log string, line_no int, line string, bytes_read long")


def processing_log(tails: DataFrame, order: list[str]) -> DataFrame:
    """place, line of one log put together from ``file_tails``: each file's tail under a heading, files in ``order``."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("log"))
    heads = tails.select("log").distinct().select("log", F.lit(0).alias("line_no"), F.concat(F.lit("== "), "log", F.lit(" ==")).alias("line"))
    rows = heads.unionByName(tails.select("log", "line_no", "line")).where(F.col("log").isin(order)).withColumn("file_no", place)
    return with_place(rows, F.asc("file_no"), F.asc("line_no")).select("place", "line")


# ---- writers -----------------------------------------------------------------------------------


def write_files(files: DataFrame, folder: str, backup: bool = False) -> None:
    """One file for each row (name, content: text or binary) below a folder that all executors share.

    A file is written under another name and then renamed, so a repeated task leaves whole files.
    ``backup`` keeps what was there before as ``.bak``, once.  A row with a null content is left out.
    """

    def write(rows: Iterator) -> None:
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        for row in rows:
            if row.content is None:
                continue
            path = f"{base}/{row.name}"
            target.create_dir(path.rpartition("/")[0], recursive=True)
            if backup and target.get_file_info(path).type == fs.FileType.File and target.get_file_info(f"{path}.bak").type == fs.FileType.NotFound:
                target.copy_file(path, f"{path}.bak")
            with target.open_output_stream(f"{path}.part") as out:
                out.write(row.content.encode() if isinstance(row.content, str) else bytes(row.content))
            target.move(f"{path}.part", path)

    files.select("name", "content").foreachPartition(write)


def document_files(documents: DataFrame) -> DataFrame:
    """name, content of the Markdown file of each document."""
    return documents.select(F.concat(F.col("pdf").cast("string"), F.lit(".md")).alias("name"), F.col("markdown").alias("content"))


def figure_files(figures: DataFrame, value: str = "json") -> DataFrame:
    """name, content of one metadata file for each figure (pdf, page_num, ordinal, figure_number, JSON text); a
    second figure of the same name has its ordinal before the page."""
    clash = F.count(F.lit(1)).over(Window.partitionBy("pdf", "page_num", "figure_number")) > 1
    number = F.when(clash, F.concat("figure_number", F.lit("_"), F.col("ordinal").cast("string"))).otherwise(F.col("figure_number"))
    path = F.concat(F.col("pdf").cast("string"), F.lit("/yaml_metadata/"), T.figure_file(number, F.col("page_num")))
    return figures.select(path.alias("name"), json_to_yaml(value).alias("content"))


def combined_figures(figures: DataFrame, made: str, value: str = "json") -> DataFrame:
    """name, content of the combined metadata file of each document: its figures in order of page and ordinal."""
    listed = F.array_sort(F.collect_list(F.struct("page_num", "ordinal", F.col(value).alias("v"))))
    rows = figures.groupBy("pdf").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(listed, lambda x: x["v"]), ",").alias("all"))
    head = F.to_json(F.struct(F.col("pdf").cast("string").alias("filename"), F.col("n").alias("total_figures"), F.lit(made).alias("processing_date")))
    return rows.select(F.concat(F.col("pdf").cast("string"), F.lit("_all_figures.yaml")).alias("name"), json_to_yaml(F.concat(F.lit('{"document_info":'), head, F.lit(',"figures":['), "all", F.lit("]}"))).alias("content"))


def changed_files(before: DataFrame, after: DataFrame, value: str) -> DataFrame:
    """Rows of ``after`` (name) whose value differs from ``before``: what a clean-up or an update has to write again."""
    old = before.select("name", F.col(value).alias("_old"))
    return after.join(old, "name", "left").where(~F.col(value).eqNullSafe(F.col("_old"))).drop("_old")


def rewrite(before: DataFrame, after: DataFrame, folder: str, dry_run: bool = False, backup: bool = False) -> DataFrame:
    """Write the files (name, content) whose content changed; gives their names and the size before and after.

    With ``dry_run`` nothing is written.  The changes are worked out once and staged, so that a
    file that is read for ``before`` may be written: what stands there when the write begins is
    in the stage already.
    """
    changed = stage(changed_files(before, after.select("name", "content"), "content"), "rewrite")
    if not dry_run:
        write_files(changed, folder, backup)
    old = before.select("name", F.octet_length("content").alias("size_before"))
    return stage(changed.join(old, "name", "left").select("name", "size_before", F.octet_length("content").alias("size_after")), "rewritten")


@pandas_udf(StringType())
def with_series(metadata: pd.Series, series: pd.Series) -> pd.Series:
    """Metadata (JSON) with the data series of another JSON text, and the mark that it has data; null where it can't be read."""

    def one(text: str | None, rows: str) -> str | None:
        try:
            value = json.loads(text or "")
            value.setdefault("data_extraction", {}).update(data_series=json.loads(rows), has_quantitative_data=True)
        except (ValueError, AttributeError):
            return None
        return json.dumps(value, ensure_ascii=False)

    return pd.Series([one(t, r) for t, r in zip(metadata, series)], dtype=object)


def write_processing_log(spark: SparkSession, logs: str, order: list[str], folder: str, n: int = 1000) -> None:
    """``processing.log`` in a folder: the last lines of each log under its name."""
    parts = fresh_path(spark, "log-parts")
    write_lines(processing_log(file_tails(spark, logs, n=n), order), parts)
    join_parts(parts, f"{folder.rstrip('/')}/processing.log")


def delivery_files(documents: DataFrame, metadata: DataFrame, name: str | None = None) -> DataFrame:
    """name, content of a delivery: each document's text and the first of its metadata files by name, under short names.

    Documents whose short names meet are numbered in order of their names.  Where whole names are
    too long to be dealt around, ``pdf`` may be any key in the same order, and ``name`` the column
    with the begin of the name.  No side is small: texts and files are never broadcast.
    """
    first = metadata.where(~F.col("name").endswith(".validation.yaml")).groupBy("pdf").agg(F.min_by("content", "name").alias("meta"))
    short = T.delivery_name(F.col(name or "pdf").cast("string"))
    place = F.row_number().over(Window.partitionBy(short).orderBy("pdf"))
    rows = documents.join(first.hint("merge"), "pdf", "left").withColumn("place", place)
    made = F.concat(short, F.when(F.col("place") > 1, F.concat(F.lit("-"), F.col("place").cast("string"))).otherwise(""))
    both = F.array(F.struct(F.concat(made, F.lit(".md")).alias("name"), F.col("markdown").alias("content")), F.struct(F.concat(made, F.lit(".yaml")).alias("name"), F.col("meta").alias("content")))
    return rows.select(F.explode(both).alias("f")).select("f.*").where("content IS NOT NULL")


def json_document(lists: list[tuple[str, DataFrame, list[str]]], values: list[tuple[str, DataFrame]]) -> DataFrame:
    """place, line of a JSON object: lists with an item to a line, each (name, rows, order), then values of one row, each (name, rows).

    The lines in order are one document.  No list is gathered: places come from counts of
    partitions, and only the last line of a list, known by its count, has no comma.  A row with
    one column ``item`` is that value, any other an object.
    """
    spark = (lists[0][1] if lists else values[0][1]).sparkSession
    frame, made, at = [(1, "{")], [], 1  # frame: the lines that no table gives
    for i, (name, rows, order) in enumerate(lists):
        placed = with_place(rows, *[F.asc(c) for c in order])
        n = placed.count()
        item = F.to_json(F.array("item")).substr(F.lit(2), F.length(F.to_json(F.array("item"))) - 2) if rows.columns == ["item"] else F.to_json(F.struct(*rows.columns))
        made.append(placed.select((F.col("place") + at + 1).alias("place"), F.concat(item, F.when(F.col("place") < n, ",").otherwise("")).alias("line")))
        frame += [(at + 1, f'"{name}":['), (at + n + 2, "]," if values or i + 1 < len(lists) else "]")]
        at += n + 2
    for i, (name, rows) in enumerate(values):
        at += 1
        text = F.concat(F.lit(f'"{name}":'), F.to_json(F.struct("*")), F.lit("," if i + 1 < len(values) else ""))
        made.append(rows.select(F.lit(at).cast("long").alias("place"), text.alias("line")))
    frame.append((at + 1, "}"))
    every = spark.createDataFrame(frame, "place long, line string")
    for lines in made:
        every = every.unionByName(lines)
    return every


def split_mapping(plan: DataFrame, ranges: DataFrame) -> DataFrame:
    """place, line of the JSON of a split: its chunks, whole documents and statistics."""
    from leafmill.plans.chunks import split_statistics

    chunk = ranges.select("pdf", "chunk_idx", "chunk", "total_chunks", "start_page", "end_page", "pages")
    return json_document([("chunks", chunk, ["pdf", "chunk_idx"]), ("direct", plan.where("status = 'skip'").select("pdf"), ["pdf"])], [("stats", split_statistics(plan))])


def write_lines(lines: DataFrame, folder: str, parts: int | None = None) -> None:
    """Lines (place, line) as text files, ``parts`` or as many as Spark sees fit, whose names sort in order of the places."""
    dealt = lines.repartitionByRange(parts, "place") if parts else lines.repartitionByRange("place")
    dealt.sortWithinPartitions("place").select("line").write.mode("overwrite").text(folder)


def join_parts(folder: str, target: str, block: int = 1 << 20) -> int:
    """The files that ``write_lines`` wrote one after the other as one file; gives its size.  ``block`` bytes are held at once."""
    from pyarrow import fs

    source, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    to, path = fs.FileSystem.from_uri(target) if "://" in target else (fs.LocalFileSystem(), target.removeprefix("file:"))
    size = 0
    with to.open_output_stream(f"{path}.part") as out:
        for info in sorted(source.get_file_info(fs.FileSelector(base)), key=lambda i: i.path):
            if info.base_name.startswith("part-"):
                with source.open_input_stream(info.path) as part:
                    while data := part.read(block):
                        size += out.write(data)
    to.move(f"{path}.part", path)
    return size


def write_report(row: DataFrame, folder: str) -> None:
    """A one-row report as JSON."""
    row.coalesce(1).write.mode("overwrite").json(folder)


def write_texts(spark: SparkSession, texts: dict[str, str], folder: str) -> None:
    """A few report texts (file name -> text) as files."""
    write_files(spark.createDataFrame(sorted(texts.items()), "name string, content string").coalesce(1), folder)


def append_events(events: DataFrame, folder: str, batch: int | str) -> None:
    """Progress events (step, pdf, page_num, status, error, ts) as one batch of the log.

    A batch has a folder of its own, named by ``batch``: a repeated call with the same name, after
    a failure or a replay, takes the place of the first one.
    """
    events.select("step", "pdf", "page_num", "status", "error", "ts").write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")


def page_images(files: DataFrame, render: object, max_pages: int = 0) -> DataFrame:
    """pdf, page_num, name, image of files (pdf, content); ``render(content)`` yields the pages' images."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pdf, content in zip(batch["pdf"], batch["content"]):
                for n, image in enumerate(render(content), 1):
                    if max_pages and n > max_pages:
                        break
                    yield pd.DataFrame({"pdf": [pdf], "page_num": [n], "name": [f"page_{n:03d}.png"], "image": [image]})

    return files.select("pdf", "content").mapInPandas(run, "pdf string, page_num int, name string, image binary")


