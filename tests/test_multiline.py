import gzip
import random

import pytest
from conftest import nodes, rows, write_tree
from logmetrics.functions import parsing as P
from logmetrics.operators import entries, multiline
from logmetrics.sources import read_logs, with_ids

HEAD = "17/03/29 10:04:{:02d} INFO a.B: entry {}"


def expected(values, part_lines):
    """(entry, part, first line, lines, text) by reading the file in order."""
    out, entry, place = {}, 0, 0
    for no, value in enumerate(values):
        if value[:2].isdigit():
            entry, place = entry + 1, 0
        key = (entry, place // part_lines)
        out.setdefault(key, [no, []])[1].append(value)
        place += 1
    return sorted((e, p, first, len(text), "\n".join(text)) for (e, p), (first, text) in out.items())


def random_file(rnd, n, heads):
    return [HEAD.format(i % 60, i) if rnd.random() < heads else f"\tat frame {i} {'x' * rnd.randint(0, 30)}" for i in range(n)]


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that one file is read by many tasks."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("run_lines", [3, 131_072])
@pytest.mark.parametrize("heads", [0.5, 0.02, 0.0, 1.0])
def test_files_cut_into_splits(spark, tmp_path, small_splits, heads, run_lines):
    rnd = random.Random(int(heads * 100))
    files = {f"f{i}.log": random_file(rnd, n, heads) for i, n in enumerate((400, 30, 1))}
    lines = read_logs(spark, write_tree(tmp_path, files))
    assert lines.select("block_start").distinct().count() > 5
    got = multiline.assemble_entries(lines, part_lines=7, run_lines=run_lines)
    for name, values in files.items():
        mine = got.filter(got.file_path.endswith(name))
        assert rows(mine.select("entry_no", "part", "first_line", "lines", "value"), "entry_no", "part") == expected(values, 7)


def test_a_log_kept_in_several_files(spark, tmp_path, small_splits):
    rnd = random.Random(8)
    whole = random_file(rnd, 300, 0.1)
    cut = {f"application_1_1/container_1_1_01_000001/part-{i:05d}.log": whole[i * 60:(i + 1) * 60] for i in range(5)}
    lines = with_ids(read_logs(spark, write_tree(tmp_path, cut)))
    got = multiline.assemble_entries(lines, ("container_id",), part_lines=1000)
    assert rows(got.select("entry_no", "part", "first_line", "lines", "value"), "entry_no") == expected(whole, 1000)


def test_a_compressed_file_is_one_split_of_many_runs(spark, tmp_path):
    values = random_file(random.Random(6), 500, 0.1)
    with gzip.open(tmp_path / "a.log.gz", "wt") as f:
        f.write("".join(v + "\n" for v in values))
    lines = read_logs(spark, str(tmp_path), glob="*.gz")
    got = multiline.assemble_entries(lines, part_lines=9, run_lines=11)
    assert rows(got.select("entry_no", "part", "first_line", "lines", "value"), "entry_no", "part") == expected(values, 9)


def test_every_line_keeps_its_place(spark, tmp_path, small_splits):
    values = random_file(random.Random(2), 200, 0.2)
    got = multiline.number_entries(read_logs(spark, write_tree(tmp_path, {"a.log": values})))
    assert [r.value for r in got.orderBy("line_no").collect()] == values


def test_whole_entries_parse_like_lines(spark, tmp_path):
    values = ["lead", HEAD.format(1, 1), "\tat x ERROR", HEAD.format(2, 2)]
    whole = multiline.assemble_entries(read_logs(spark, write_tree(tmp_path, {"a.log": values})))
    parsed = entries.valid_entries(entries.parse_entries(whole))
    assert [(r.level, r.raw) for r in parsed.orderBy("ts").collect()] == [
        ("INFO", HEAD.format(1, 1) + "\n\tat x ERROR"), ("INFO", HEAD.format(2, 2))]


def test_parts_have_their_headers_fields(spark, tmp_path, small_splits):
    values = ["lead", HEAD.format(1, 1), *[f"\tat frame {i} ERROR {'x' * 40}" for i in range(60)], HEAD.format(2, 2)]
    whole = multiline.assemble_entries(read_logs(spark, write_tree(tmp_path, {"a.log": values})), part_lines=7, run_lines=5)
    got = rows(entries.parse_entries(whole).select("entry_no", "part", "level", "component", "ts"), "entry_no", "part")
    assert got[0][2:] == (None, None, None) and len(got) == 11
    assert all(g[2:4] == ("INFO", "a.B") and str(g[4]) == "2017-03-29 10:04:01" for g in got[1:10])


def test_text_is_shuffled_once(spark, tmp_path):
    """For the numbering; of the assembled text only what touches a run's border."""
    values = random_file(random.Random(3), 300, 0.3)
    df = multiline.assemble_entries(read_logs(spark, write_tree(tmp_path, {"a.log": values})))
    df.collect()
    carrying = [n for n in nodes(df) if n.nodeName() == "Exchange" and "value" in [n.output().apply(i).name() for i in range(n.output().size())]]
    below = [n.metrics().apply("shuffleRecordsWritten").value() for n in carrying]
    assert sorted(below)[-1] == 300 and sum(below) <= 300 + 4
