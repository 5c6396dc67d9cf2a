from conftest import rows, ts
from logmetrics.operators import entries, events, memory, tasks
from logmetrics.sources import with_ids

AT = "17/03/29 10:11:{:02d} INFO {}"


def parsed(lines, *messages, **kw):
    return entries.parse_entries(lines(*[AT.format(i, m) for i, m in enumerate(messages)], **kw))


def last(df, n):
    return [tuple(r)[-n:] for r in df.collect()]


def test_documented_lines(lines):
    df = parsed(
        lines,
        "YarnAllocator: Will request 16 executor containers, each with 5 cores and 28160 MB memory including 2560 MB overhead",
        "YarnAllocator: Will request 2 executor containers, each with 5 cores and 100 MB memory",
        "YarnAllocator: Will request some time",
        "YarnAllocator: Container request (host: Any, capability: <memory:28160, vCores:5>)",
        "rdd.HadoopRDD: Input split: hdfs://10.10.34.11:9000/pjhe/input/orderHDFSseq.txt:11902664+1487833",
        "python.PythonRunner: Times: total = 2282, boot = -1190, init = 59, finish = 1033",
        "storage.MemoryStore: MemoryStore started with capacity 17.7 GB",
        "storage.MemoryStore: Block broadcast_3 stored as bytes in memory (estimated size 1.5 KB, free 93.5 MB)",
        "storage.MemoryStore: Block rdd_1_2 stored as values in memory (estimated size 12 B, free 2 TB)",
        "broadcast.TorrentBroadcast: Started reading broadcast variable 9",
        "Remoting: Remoting started; listening on addresses :[akka.tcp://sparkExecutorActorSystem@mesos-slave-07:36686]",
    )
    assert last(events.executor_requests(df), 4) == [(16, 5, 28160, 2560), (2, 5, 100, None)]
    assert last(events.resource_totals(events.executor_requests(df)), 3) == [(18, 90, 16 * 28160 + 200)]
    assert last(events.container_requests(df), 3) == [("Any", 28160, 5)]
    assert last(events.input_splits(df), 3) == [("hdfs://10.10.34.11:9000/pjhe/input/orderHDFSseq.txt", 11902664, 1487833)]
    assert last(events.input_bytes(events.input_splits(df)), 2) == [(1, 1487833)]
    assert last(events.python_timings(df), 4) == [(2282, -1190, 59, 1033)]
    assert last(events.store_capacity(df), 1) == [(round(17.7 * 1024**3),)]
    assert last(events.memory_blocks(df), 3) == [
        ("broadcast_3", 1536, round(93.5 * 1024**2)), ("rdd_1_2", 12, 2 * 1024**4)]
    assert last(events.broadcast_reads(df), 3) == [(9, 1, 1)]
    hosts = events.container_hosts(df)
    assert last(hosts, 1) == [("mesos-slave-07",)]
    assert last(events.host_distribution(hosts), 2) == [("mesos-slave-07", 1)]
    (headroom,) = memory.memory_headroom(df).collect()
    assert (headroom.requested_bytes, headroom.used_bytes) == ((16 * 28160 + 200) * 1024**2, 1548)


def test_memory_adds_up_over_seconds_and_days(lines, spark):
    block = "17/03/{} 23:59:5{} INFO storage.MemoryStore: Block b stored as bytes in memory (estimated size {} B, free 1 GB)"
    df = entries.parse_entries(lines(block.format(29, 9, 5), block.format(29, 9, 6), block.format(30, 1, 7), block.format(30, 2, 8)))
    got = rows(memory.memory_usage(events.memory_blocks(df)).select("ts", "blocks", "stored_bytes", "used_bytes"), "ts")
    assert [g[1:] for g in got] == [(2, 11, 6), (1, 7, 7), (1, 8, 8)]  # one block, stored again


def test_memory_in_use_counts_each_block_once(lines):
    stored = "17/03/29 23:59:5{} INFO storage.MemoryStore: Block {} stored as bytes in memory (estimated size {} B, free 1 GB)"
    asked = "17/03/29 23:59:50 INFO YarnAllocator: Will request 1 executor containers, each with 1 cores and 1 MB memory including 0 MB overhead"
    df = entries.parse_entries(lines(
        asked, stored.format(1, "a", 10), stored.format(2, "b", 5), stored.format(3, "a", 4), stored.format(3, "a", 3), stored.format(4, "b", 6),
        stored.format(1, "c", 9)[18:]))
    usage = memory.memory_usage(events.memory_blocks(df)).select("blocks", "stored_bytes", "used_bytes", "blocks_in_use", "ts")
    assert [r[:4] for r in rows(usage, "ts")] == [(1, 10, 10, 1), (1, 5, 15, 2), (2, 7, 9, 2), (1, 6, 10, 2)]
    head = memory.memory_headroom(df).first()
    assert (head.requested_bytes, head.used_bytes, head.untimed_stores) == (1024**2, 10, 1)


def test_hosts_are_the_containers_own(lines):
    own = "17/03/29 10:00:0{} INFO Remoting: Remoting started; listening on addresses :[akka.tcp://executor@{}:36686]"
    other = "17/03/29 10:00:09 INFO a.B: Connecting to akka.tcp://driver@zz-driver:37138"
    am = "/l/application_1_1/container_1_1_01_000001.log"
    df = entries.parse_entries(lines(other, own.format(1, "worker-9"), own.format(2, "worker-1"), other).union(lines(other, path=am)))
    got = rows(events.container_hosts(df).select("container_id", "host"), "container_id")
    assert got == [("container_1485248649253_0052_01_000002", "worker-1"), ("container_1_1_01_000001", "")]
    kept = entries.parse_entries(with_ids(lines(own.format(1, "w"), path="/misc/x.log")))
    assert rows(events.container_hosts(kept)) == [("", "", "w")]


def test_lines_of_no_application_are_kept(lines):
    df = entries.parse_entries(lines("17/03/29 10:00:00 INFO python.PythonRunner: Times: total = 4, boot = 1, init = 1, finish = 2", path="/misc/x.log"))
    assert rows(events.python_timings(df).select("application_id", "total_ms")) == [("", 4)]


def test_extractors_read_entries_of_several_lines(lines):
    df = entries.parse_entries(lines("17/03/29 10:00:00 INFO rdd.HadoopRDD: Input split: hdfs://h:1/f:0+5\n\tat more"))
    assert df.first().message == "Input split: hdfs://h:1/f:0+5\n\tat more"
    assert rows(events.input_splits(df).select("path", "offset", "length")) == [("hdfs://h:1/f", 0, 5)]


def task(word, task, attempt, stage, tid):
    return f"executor.Executor: {word} task {task}.{attempt} in stage {stage}.0 (TID {tid})"


def test_tasks(lines):
    df = parsed(
        lines,
        task("Running", 8, 0, 1, 9), task("Running", 7, 1, 1, 10), task("Running", 6, 0, 2, 11),
        task("Finished", 8, 0, 1, 9), "executor.Executor: told (TID 5) nothing", task("Finished", 7, 1, 1, 10),
    )
    found = tasks.task_events(df)
    assert last(found, 6)[0] == ("start", 8, 0, 1, 0, 9) and found.count() == 5
    spans = tasks.task_spans(found)
    durations = tasks.task_durations(spans)
    assert rows(durations.select("tid", "seconds"), "tid") == [(9, 3), (10, 4)]
    assert last(tasks.app_task_stats(durations), 4) == [(2, 3.5, 3.5, 4)]
    assert last(tasks.task_skew(durations), 5) == [(1, 2, 4, 3.5, 4 / 3.5)]
    stages = tasks.stage_times(durations)
    assert last(stages, 4) == [(2, 5, 4, 0.8)]
    assert last(tasks.stage_bottlenecks(stages, 1), 1) == [(1,)]
    assert last(tasks.task_retries(found), 3) == [(1, 1, 1)]
    assert [r.tid for r in tasks.lost_tasks(spans).collect()] == [11]


def test_same_task_number_in_two_containers_is_two_tasks(lines):
    start = AT.format(0, task("Running", 1, 0, 1, 5))
    end = AT.format(9, task("Finished", 1, 0, 1, 5))
    other = "/l/application_1_1/container_1_1_01_000003.log"
    df = entries.parse_entries(lines(start).union(lines(end, path=other)))
    spans = tasks.task_spans(tasks.task_events(df))
    assert spans.count() == 2 and tasks.task_durations(spans).count() == 0


def test_failures(lines):
    ok = "/l/application_1_1/container_1_1_01_000003.log"
    df = entries.parse_entries(
        lines(AT.format(0, task("Running", 1, 0, 1, 5)), AT.format(1, task("Running", 1, 0, 1, 6)),
              AT.format(2, task("Finished", 1, 0, 1, 6)), "17/03/29 10:00:00 ERROR a.B: broken", "17/03/29 10:00:00 ERROR a.B: again")
        .union(lines(AT.format(0, task("Running", 1, 0, 1, 5)), AT.format(1, task("Finished", 1, 0, 1, 5)), path=ok))
        .union(lines("17/03/29 10:00:00 ERROR a.B: nobody's", path="/misc/x.log"))
    )
    assert sorted(last(tasks.failures(df), 2)) == [(0, 1), (1, 2)]


def test_bottlenecks_rank_each_application(spark):
    data = [(f"app{a}", s, 1, 10 * s + a, 1, 0.5) for a in range(3) for s in range(6)]
    stages = spark.createDataFrame(
        data, "application_id string, stage bigint, tasks bigint, wall_seconds bigint, slowest_seconds bigint, slowest_share double")
    got = tasks.stage_bottlenecks(stages, 2)
    assert rows(got.select("application_id", "rank", "stage"), "application_id", "rank") == [
        (f"app{a}", r, 6 - r) for a in range(3) for r in (1, 2)]
