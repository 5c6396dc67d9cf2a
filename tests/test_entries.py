import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from logmetrics.functions import parsing as P
from logmetrics.operators import entries
from logmetrics.sources import with_ids

T42 = ts("2017-03-29 10:04:42")

# line, time at line start, time anywhere, level
EDGES = [
    ("17/03/29 10:04:42 WARN Y: says ERROR later", T42, T42, "WARN"),
    ("17/13/45 10:04:42 INFO bad.Date: x", None, None, "INFO"),
    ("17/02/30 10:04:42 INFO bad.Day: x", None, None, "INFO"),
    ("17/03/29 10:04:60 INFO bad.Second: x", None, None, "INFO"),
    ("17/03/29 10:04:42 TRACE a.B: no level here", T42, T42, ""),
    ("17/03/29 10:04:42 FATAL a.B: has INFORMATION inside", T42, T42, "INFO"),
    ("java.lang.RuntimeException: ERROR text", None, None, "ERROR"),
    ("note 17/03/29 10:04:42 INFO embedded", None, T42, "INFO"),
    ("99/12/31 23:59:59 DEBUG a.B: far year", ts("2099-12-31 23:59:59"), ts("2099-12-31 23:59:59"), "DEBUG"),
    ("", None, None, ""),
]


@pytest.mark.parametrize("anchored", [True, False])
def test_edge_lines(lines, anchored):
    got = entries.parse_entries(lines(*[e[0] for e in EDGES]), anchored=anchored)
    assert rows(got.select("raw", "ts", "level"), "raw") == sorted((e[0], e[1 if anchored else 2], e[3]) for e in EDGES)


def test_valid_entries_need_level_and_time(lines):
    parsed = entries.parse_entries(lines(*[e[0] for e in EDGES]))
    kept = entries.valid_entries(parsed)
    assert kept.columns == parsed.columns
    assert {r.raw for r in kept.collect()} == {e[0] for e in EDGES if e[1] and e[3]}


def test_strict_level_follows_the_stamp(lines):
    df = lines(*[e[0] for e in EDGES]).select("value", P.log_level(F.col("value"), strict=True).alias("level"))
    strict = dict(rows(df))
    assert strict["17/03/29 10:04:42 WARN Y: says ERROR later"] == "WARN"
    assert strict["17/03/29 10:04:42 FATAL a.B: has INFORMATION inside"] == ""
    assert strict["note 17/03/29 10:04:42 INFO embedded"] == ""


def test_component_styles(lines):
    df = lines("17/03/29 10:04:42 INFO executor.Executor: Running: now", "17/03/29 10:04:42 WARN Bare text")
    for style, want in (("colon", {"executor.Executor", ""}), ("token", {"executor.Executor:", "Bare"})):
        got = entries.parse_entries(df, component_style=style)
        assert {r.component for r in got.collect()} == want
    assert {r.message for r in entries.parse_entries(df).collect()} == {"Running: now", ""}


def test_bad_dates_can_fail(lines):
    good = lines("17/03/29 10:04:42 INFO a: b", "no stamp INFO")
    assert entries.parse_entries(good, on_bad="fail").count() == 1
    with pytest.raises(Exception, match="17/13/45|CANNOT_PARSE|INVALID_DATETIME"):
        entries.parse_entries(lines("17/13/45 10:04:42 INFO a: b"), on_bad="fail").select("ts").collect()


def test_header_and_error_lines(lines):
    df = lines(*[e[0] for e in EDGES])
    assert {r.value for r in entries.header_lines(df).collect()} == {e[0] for e in EDGES if e[0][:2].isdigit()}
    found = entries.errors(entries.parse_entries(df)).collect()
    assert [r.raw for r in found] == ["java.lang.RuntimeException: ERROR text"]


def test_every_level_word_counts(lines):
    got = entries.level_occurrences(lines("INFO a WARN b INFO", "ERROR", "nothing"))
    assert dict(rows(got)) == {"INFO": 2, "WARN": 1, "ERROR": 1}


def test_ids_from_path(lines, spark):
    got = with_ids(lines("x")).first()
    assert (got.cluster_id, got.application_id, got.app_number) == (
        "1485248649253", "application_1485248649253_0052", "0052")
    assert (got.container_id, got.attempt, got.container_seq, got.container_role) == (
        "container_1485248649253_0052_01_000002", "01", "000002", "executor")
    master = with_ids(lines("x", path="/a/application_1_2/container_1_2_03_000001.log")).first()
    assert (master.container_role, master.attempt) == ("AM", "03")
    digits = lines("x").select(P.container_digits(P.container_id(F.col("file_path")))).first()
    assert digits[0] == "1485248649253_0052_01_000002"


def test_paths_without_ids(lines):
    other = lines("x", path="/misc/other.log")
    assert with_ids(other, keep_unmatched=False).count() == 0
    kept = with_ids(other).first()
    assert (kept.cluster_id, kept.application_id, kept.app_number, kept.container_id) == ("", "", "", "")
    assert kept.container_role is None


def test_cluster_start_and_sizes(spark):
    df = spark.createDataFrame([("1485248649253", "1.5", "KB"), ("oops", "2", "TB"), ("0", "7", "?")], "c string, n string, u string")
    got = rows(df.select(P.cluster_start(F.col("c")).alias("at"), P.size_in_bytes(F.col("n"), F.col("u")).alias("b")))
    assert str(got[0][0]) == "2017-01-24 09:04:09.253000"
    assert got[1][0] is None
    assert [b for _, b in got] == [1536, 2 * 1024**4, None]


def test_captures_survive_the_separator(spark):
    df = spark.createDataFrame([("a=1 b=x\u0001y",), ("a=2",)], "t string")
    got = rows(df.select(P.captures(F.col("t"), r"a=(\d+) b=(\S+)", 2).alias("g")))
    assert got == [(["1", "x\ufffdy"],), ([""],)]
