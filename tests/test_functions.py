import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from leafmill.functions import text as T
from leafmill.operators import clean, leftovers, parse
from leafmill.operators.progress import breaker_step


@pytest.mark.parametrize(
    "text, limit, size, end",
    [
        ("a" * 400 + " Figure 1 shows x. " + "b" * 300, 500, 492, "[Refs: Figure 1 shows x.]"),
        ("b" * 600, 500, 503, "..."),
        ("short", 500, 5, "short"),
        ("x" * 700, 0, 700, "x"),
    ],
)
def test_truncate(one, text, limit, size, end):
    got = one(lambda c: T.truncate_with_references(c, limit), text)
    assert len(got) == size and got.endswith(end)


def test_truncate_short_limit(one):
    assert one(lambda c: T.truncate_with_references(c, 100), "See Fig. 2 for x. " + "c" * 200).endswith("...\n[Refs: Fig. 2 for x.]")


@pytest.mark.parametrize("attempt, wait", list(enumerate([1, 2, 4, 8, 16, 30, 30])))
def test_backoff(one, attempt, wait):
    assert one(T.backoff_seconds, attempt) == wait


@pytest.mark.parametrize("name, want", [("My-Report_part2of3", "myreport"), ("My Report", "myreport"), ("Doc_1_chunk4", "doc1"), ("A.B (c)", "a.b(c)")])
def test_normal_name(one, name, want):
    assert one(T.normal_name, name) == want


@pytest.mark.parametrize("seconds, short, long", [(0, "0s", "0s"), (59, "59s", "59s"), (60, "1m 0s", "1m 0s"), (3599, "59m 59s", "59m 59s"), (3600, "1h 0m", "1h 0m 0s"), (7325, "2h 2m", "2h 2m 5s")])
def test_durations(one, seconds, short, long):
    assert (one(T.duration_short, seconds), one(T.duration_long, seconds)) == (short, long)


@pytest.mark.parametrize(
    "raw, num",
    [("", None), ("1,234", 1234), ("$1,234.50", 1234.5), ("45%", 45), ("n/a", None), ("–", None), ("-7", -7), ("1e3", None), ("1.5e3", 1500), ("(12)", None), ("€ 9", 9), ("5 %", 5), (".5", 0.5), ("1.2.3", None)],
)
def test_numbers(one, raw, num):
    assert one(T.number, raw) == num


@pytest.mark.parametrize("score, name", [(95, "Excellent"), (85, "Good"), (70, "Fair"), (50, "Poor"), (10, "Very Poor")])
def test_rating(one, score, name):
    assert one(T.rating, score) == name


def test_keywords(one):
    a, b = "Branch deposits by year", "Table 1: Branch deposits, 1895-1900"
    assert set(one(T.keywords, a)) == {"branch", "deposits", "year"}
    assert one(lambda x, y: T.jaccard(T.keywords(x), T.keywords(y)), a, b) == pytest.approx(2 / 6)
    assert one(lambda x, y: T.jaccard(T.keywords(x), T.keywords(y)), "", b) == 0


def test_squeeze(one):
    assert one(T.squeeze_blank_lines, "a\n\n\n\nb\n\n\nc\n\n\n\n\n\nd") == "a\n\n\nb\n\n\nc\n\n\nd"


@pytest.mark.parametrize("raw, want", [(r"\alpha", r"\\alpha"), (r"\frac{1}{2}", r"\\frac{1}{2}"), (r"\unit", r"\\unit"), (r"a\n b", r"a\n b"), (r"\n1", r"\n1"), (r"\"q\"", r"\"q\""), (r"é", r"é"), (r"\\alpha", r"\\alpha"), ("x\\", "x\\"), (r"a\nb", r"a\\nb")])
def test_escape_repair(raw, want):
    assert parse.repaired(raw) == want


@given(st.text(alphabet="ab\\ntu0{}\"/ ", max_size=30))
def test_repaired_strings_parse(body):
    text = '"' + body.replace('"', "").rstrip("\\") + '"'
    json.loads(parse.repaired(text))


@given(st.text(alphabet="a|-: \n", max_size=60))
def test_alignment_is_stable(text):
    once = clean.aligned(text)
    assert clean.aligned(once) == once


def test_alignment():
    assert clean.aligned("|a|bcde|\n|:--|---|\n|x|\nend") == "| a   | bcde |\n| :-- | ---- |\n| x   |      |\nend"


@pytest.mark.parametrize(
    "text, want, fixes",
    [
        ('a\n```json\n{"body_text": "x\\\\ny"}\n```\nb', "a\nx\ny\nb", 1),
        ('```json\n{"body_text": "", "content": "C"}\n```', "", 1),
        ('```json\n{"content": 7}\n```', "7", 1),
        ('```json\n{"text": "T"}\n``` tail', "T tail", 1),
        ('```json\n{"body_text": ["a"]}\n```', "['a']", 1),
        ("a\n```json\n[1, 2]\n```\nb", "a\n\nb", 1),
        ("```json\n{broken\n```", "```json\n{broken\n```", 0),
        ('```json\n{\n"page_number": 1,\n"body_text": "open\\nend', "open\nend", 1),
        ('x\n```json\n{\n  "page_number": 3,\n  "tables": [],\n  "body_text": "say \\"hi\\", \\tthen",\n  "notes": [\n\n## Page 4\n\ny', 'x\nsay "hi", \tthen\n\n## Page 4\n\ny', 1),
        ('```json\n{\n"page_number": 2,\n"tables": []\n\n## Page 3', "\n\n## Page 3", 1),
        ("a\n```json\n{\n\nb", "a\n\n\nb", 1),
        ('"tables": [],\n"page_number": 4,\n"figures": {"a": 1}\nb', '"figures": {"a": 1}\nb', 2),
        ('"body_text": "hello\\nworld",\nmore",\n## Page 2', 'hello\nworld",\nmore\n## Page 2', 1),
        ('  "body_text": "hello there', "hello there", 1),
        ('"body_text": "a",', "a", 1),
    ],
)
def test_json_leftovers(text, want, fixes):
    got, n = leftovers.without_json(text)
    assert (got, n) == (want, fixes)


def test_breaker():
    import pandas as pd

    at = lambda s: pd.Timestamp(2024, 1, 1) + pd.Timedelta(seconds=s)
    state = (0, None)
    for s in range(5):
        *state, banned = breaker_step(*state, at(s), False)
        assert not banned
    assert state == [5, at(304)]
    assert breaker_step(*state, at(100), False) == (6, at(400), True)  # under way when the ban began
    assert breaker_step(*state, at(100), True) == (0, None, True)  # a success lifts the ban
    assert breaker_step(*state, at(304), False) == (6, at(604), True)
    assert breaker_step(*state, at(305), False) == (1, None, False)  # the ban has expired
    assert breaker_step(*state, at(305), True) == (0, None, False)


@pytest.mark.parametrize("value, numeric, normal", [("£ 1,000", True, "£ 1000"), ("-3.5%", True, "-3.5%"), ("", False, ""), ("–", False, "-"), (" N/A ", False, "n/a"), ("12?", True, "12?"), ("1.2.3", False, "1.2.3"), (None, False, ""), ("1e3", True, "1e3"), ("A—B", False, "a-b")])
def test_cells_as_values(one, value, numeric, normal):
    from pyspark.sql import functions as F

    assert one(lambda c: T.is_numeric(c.cast("string")), value) == numeric and one(lambda c: T.normal_value(c.cast("string")), value) == normal


@pytest.mark.parametrize("attempt, chance, wait", [(0, 0.0, 0.75), (0, 1.0, 1.25), (3, 0.5, 8.0), (9, 1.0, 37.5)])
def test_jitter(one, attempt, chance, wait):
    from leafmill.sources.providers import wait_seconds

    assert one(lambda a, c: T.backoff_seconds(a, chance=c), attempt, chance) == wait == wait_seconds(attempt, lambda: chance)


def test_shifted_references():
    from leafmill.operators.merge import shifted

    text = "[Page 3] ## Page 3 x\n## Page 3\n![a b](images/page_003.png) yaml_metadata/Figure_1_page3.yaml and yaml_metadata/T_page4.yaml"
    assert shifted(text, 100) == "[Page 103] ## Page 3 x\n## Page 103\n![a b](images/page_103.png) yaml_metadata/Figure_1_page103.yaml and yaml_metadata/T_page104.yaml"


@pytest.mark.parametrize(
    "raw, body, parsed",
    [
        ('{"body_text": "a"}', "a", True),
        ('x ```json\n{"body_text": "\\alpha"}\n``` y', "\\alpha", True),
        ("[1, 2]", "[1, 2]", False),
        ('"\\alpha"', '"\\alpha"', False),
        ("```json\n{\\alpha\n```", "```json\n{\\alpha\n```", False),
        ("z" * 600, "z" * 500, False),
        (None, "", False),
    ],
)
def test_records(raw, body, parsed):
    text, own = parse.record(raw)
    assert (json.loads(text)["body_text"], own) == (body, parsed)
