from conftest import rows
from logmetrics.operators import entries, levels, report, sampling

TALLY = "level string, lines bigint, valid_lines bigint"

# The public log collection's totals.
FULL = [("INFO", 27389472, 27389472), ("ERROR", 11183, 11183), ("WARN", 9595, 9595), ("", 5826354, 0)]
FULL_REPORT = """\
Total log lines processed: 33,236,604
Total lines with log levels: 27,410,250
Unique log levels found: 3

Log level distribution:
  INFO   : 27,389,472 (99.92%)
  ERROR  :     11,183 ( 0.04%)
  WARN   :      9,595 ( 0.04%)"""
ONE = [("INFO", 1573, 1573), ("ERROR", 14, 14), ("WARN", 14, 14), ("", 310, 0)]
ONE_REPORT = """\
Total log lines processed: 1,911
Total lines with log levels: 1,601
Unique log levels found: 3

Log level distribution:
  INFO   :      1,573 (98.25%)
  ERROR  :         14 ( 0.87%)
  WARN   :         14 ( 0.87%)"""


def lines_of(df):
    return "\n".join(r.line for r in df.orderBy("ord").collect())


def test_report_of_known_totals(spark):
    for tally, want in ((FULL, FULL_REPORT), (ONE, ONE_REPORT)):
        df = spark.createDataFrame(tally, TALLY)
        assert lines_of(report.level_report(df)) == want
        assert rows(levels.level_counts(df)) == [(name, n) for name, _, n in tally if n]


def test_report_of_nothing(spark):
    assert lines_of(report.level_report(spark.createDataFrame([], TALLY))).splitlines()[:3] == [
        "Total log lines processed: 0", "Total lines with log levels: 0", "Unique log levels found: 0"]


def test_tally_and_what_follows(lines):
    parsed = entries.parse_entries(lines(
        "17/03/29 10:04:42 INFO a.A: x", "17/03/29 10:04:43 INFO a.A: y", "17/03/29 10:04:44 WARN b.B: z",
        "17/13/29 10:04:42 INFO a.A: bad date", "\tat a.b ERROR", "plain"))
    tally = levels.level_tally(parsed)
    assert rows(levels.line_totals(tally)) == [(6, 3)]
    counts = levels.level_counts(tally)
    assert rows(counts) == [("INFO", 2), ("WARN", 1)]
    assert rows(levels.level_totals(counts)) == [(3, 2)]
    assert [(a, b, round(c, 2)) for a, b, c in rows(levels.level_share(counts), "log_level")] == [
        ("INFO", 2, 66.67), ("WARN", 1, 33.33)]
    valid = entries.valid_entries(parsed)
    assert rows(levels.top_components(valid, 1)) == [("a.A", 2)]
    assert {r.component for r in levels.distinct_components(valid).collect()} == {"a.A", "b.B"}
    assert {r.level for r in levels.distinct_levels(valid).collect()} == {"INFO", "WARN"}


def test_samples(lines):
    values = [f"17/03/29 10:04:{s:02d} INFO a: {s}" for s in range(60)]
    valid = entries.valid_entries(entries.parse_entries(lines(*values)))
    first = sampling.earliest_entries(valid, 10)
    assert [r.raw for r in first.collect()] == values[:10]
    drawn = [tuple(r) for r in sampling.hash_sample(valid, 10, "raw").collect()]
    again = [tuple(r) for r in sampling.hash_sample(valid.repartition(7), 10, "raw").collect()]
    other = [tuple(r) for r in sampling.hash_sample(valid, 10, "raw", seed=1).collect()]
    assert drawn == again and len(set(drawn)) == 10 and drawn != other


def test_inventory_counts(spark):
    path = "/x/application_{0}_{1}/container_{0}_{1}_01_{2:06d}.log".format
    data = [(path(1, "0001", c),) for c in (1, 1, 2)] + [(path(1, "0002", 1),), (path(2, "0001", 1),), ("/y.log",)]
    got = levels.inventory_counts(spark.createDataFrame(data, "file_path string"))
    assert rows(got, "cluster_id") == [("", 0, 0, 1), ("1", 2, 3, 4), ("2", 1, 1, 1)]
