"""Words one edit apart, found by scanning the sorted vocabulary.

The vocabulary is sorted, and its scan computes the edit matrix of a query against the
words in order, one row per letter, in a band of three cells. Adjacent words share
their longest common prefix, so a row stands for the whole range of words that
share a prefix and is worked out once; a range whose row exceeds one edit is skipped.
The rows of many queries against many ranges are advanced together, letter by letter.

Of two words one edit apart either the first letters agree or the last do, so the
vocabulary is listed twice, forwards and backwards, and a query enters each list where
its own first letters stand. A pair that both lists could find counts in the
forward list only. The lists are range-partitioned into blocks. A query meets its own
block, and is sent to each other block that its first letters reach and whose common
prefix is within one edit of it.
"""

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage

LEAST_LENGTH = 5
LEAST_COUNT = 3
ODDITY = 97  # one run in so many loses a letter
EXACT = (2, 3)  # letters that agree at the beginning of a pair in the forward and in the backward list
BLOCK_WORDS = 50_000
QUERIES_AT_ONCE = 10_000
FLUSH = 300_000  # words that a task counts before it hands them on

# What words are made of, and what becomes a small letter.
RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(key: object, text: str | None) -> Counter:
    """The words of a text with their numbers, one run in ``ODDITY`` (by the hash of key and run) short of a letter."""
    runs = Counter(RUN.findall((text or "").encode().lower().decode()))  # bytes: A-Z only
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % ODDITY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of all words of ``least_length`` letters and ``least_count`` occurrences in all texts. Tasks add up their own first."""

    def each(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for row_key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in words_of(row_key, value).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        if held:
            yield out()

    own = docs.select(F.col(key).cast("string").alias("key"), text).mapInArrow(each, "word string, n bigint")
    return own.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class SortedList:
    """Words in byte order, flat, with the common prefix of each and the one before."""

    def __init__(self, words: list[bytes]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        self.shared = np.zeros(len(words) + 1, np.int64)  # with the word before; the last entry ends every range
        same = np.arange(1, len(words))
        depth = 0
        while len(same):
            same = same[(self.size[same] > depth) & (self.size[same - 1] > depth)]
            same = same[self.letters[self.at[same] + depth] == self.letters[self.at[same - 1] + depth]]
            self.shared[same] = depth = depth + 1
        self.shared[len(words)] = -1

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of every range of words that share ``depth`` letters."""
        edges = np.flatnonzero(self.shared < depth)
        starts, ends = edges[:-1], edges[1:]
        long = self.size[starts] >= depth
        return starts[long], ends[long]

    def near(self, queries: "SortedList", exact: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and word of all pairs at a distance of exactly one edit that share their first ``exact`` letters."""
        starts, ends = self.bounds(exact)
        first = {self.letters[self.at[s] : self.at[s] + exact].tobytes(): n for n, s in enumerate(starts.tolist())}
        raw = queries.letters.tobytes()
        where = np.array([first.get(raw[a : a + exact], -1) if n >= exact else -1 for a, n in zip(queries.at.tolist(), queries.size.tolist())], np.int64)
        query = np.flatnonzero(where >= 0)
        lo, hi = starts[where[query]], ends[where[query]]
        band = np.tile(np.array([1, 0, 1], np.int8), (len(query), 1))  # against depth - 1, depth and depth + 1 letters of the query
        pairs, depth = [], exact
        letter = lambda d: np.where(queries.size[query] > d, queries.letters[np.minimum(queries.at[query] + d, len(queries.letters) - 1)], 0)
        while len(query):
            # Ranges end with the word that has just these letters, if there is one: it comes first.
            length = queries.size[query]
            whole = (self.size[lo] == depth) & (np.abs(length - depth) <= 1)
            if whole.any():
                hit = np.flatnonzero(whole)
                hit = hit[band[hit, length[hit] - depth + 1] == 1]
                pairs.append((query[hit], lo[hit]))
            starts, ends = self.bounds(depth + 1)
            a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            n = b - a
            child = np.arange(int(n.sum())) + np.repeat(a - (np.cumsum(n) - n), n)
            query, band = np.repeat(query, n), np.repeat(band, n, axis=0)
            lo, hi = starts[child], ends[child]
            here = self.letters[self.at[lo] + depth]
            row = np.empty_like(band)
            row[:, 0] = np.minimum(band[:, 0] + (letter(depth - 1) != here), band[:, 1] + 1)
            row[:, 1] = np.minimum(np.minimum(band[:, 1] + (letter(depth) != here), band[:, 2] + 1), row[:, 0] + 1)
            row[:, 2] = np.minimum(band[:, 2] + (letter(depth + 1) != here), row[:, 1] + 1)
            alive = row.min(axis=1) <= 1
            query, lo, hi, band, depth = query[alive], lo[alive], hi[alive], row[alive], depth + 1
        none = np.zeros(0, np.int64)
        return (np.concatenate([q for q, _ in pairs] or [none]), np.concatenate([w for _, w in pairs] or [none]))


def within_one(prefix: bytes, word: bytes) -> bool:
    """Can a word with this prefix be one edit from ``word``?"""
    row = list(range(len(word) + 1))
    for i, c in enumerate(prefix, 1):
        new = [i]
        for j, d in enumerate(word, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
        if min(row) > 1:
            return False
    return True


def common_prefix(a: bytes, b: bytes) -> bytes:
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
    """Way, role and rows of each block: its list whole, queries from elsewhere as they come."""
    held, key = [], None
    for batch in batches:
        kinds = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("block", "way", "role")]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in kinds], axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if a == b:
                continue
            rows, this = pa.Table.from_batches([batch.slice(a, b - a)]), tuple(int(k[a]) for k in kinds)
            if this != key and held:
                yield key[1], key[2], pa.concat_tables(held)
                held = []
            key = this
            if this[2]:
                yield this[1], this[2], rows
            else:
                held.append(rows)
    if held:
        yield key[1], key[2], pa.concat_tables(held)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near`` and ``near_n`` of all ordered pairs of words one edit apart; each once.

    ``words`` is a written table of distinct words (of five letters or more, in Latin-1) and numbers. The bounds
    of the blocks come to the driver, one row per ``BLOCK_WORDS`` words and list.
    """
    spark = words.sparkSession
    lists = words.select(F.lit(0).alias("way"), F.col("word").alias("x"), "n").union(words.select(F.lit(1), F.reverse("word"), "n"))
    blocks = max(1, -(-2 * words.count() // BLOCK_WORDS))
    dealt = lists.repartitionByRange(blocks, "way", "x").withColumn("block", F.spark_partition_id())
    listed = stage(dealt, "sorted-words")
    # A block may hold the end of one list and the beginning of the other.
    ends = listed.groupBy("way", "block").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    bounds = sorted((r.way, r.block, r.lo.encode("latin-1"), r.hi.encode("latin-1")) for r in ends)
    shared = spark.sparkContext.broadcast(bounds)

    def send(batches):
        by_way = [[b for b in shared.value if b[0] == way] for way in (0, 1)]
        tails = [[hi for *_, hi in own] for own in by_way]
        for batch in batches:
            out = []
            for way, x, n, block in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = x.encode("latin-1")
                first = raw[: EXACT[way]]
                at = bisect_left(tails[way], first)
                for _, other, lo, hi in islice(by_way[way], at, None):
                    if lo[: len(first)] > first:
                        break
                    if other != block and within_one(common_prefix(lo, hi), raw):
                        out.append((way, x, n, other))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(batch.schema)], names=batch.schema.names)

    kind = "way int, x string, n bigint, block int"
    sent = listed.select("way", "x", "n", "block").mapInArrow(send, kind).withColumn("role", F.lit(1))
    rows = listed.select("way", "x", "n", "block").withColumn("role", F.lit(0)).union(sent)
    dealt = rows.repartition(blocks, "block").sortWithinPartitions("block", "way", "role", "x")

    def scan(batches):
        own = None
        for way, role, rows in _runs(batches):
            found = [x.encode("latin-1") for x in rows.column("x").to_pylist()]
            if role == 0:
                own, numbers, names = SortedList(found), rows.column("n").to_numpy(), found
            for lo in range(0, len(found), QUERIES_AT_ONCE):
                part = found[lo : lo + QUERIES_AT_ONCE]
                query, word = own.near(SortedList(part), EXACT[way])
                pairs = [(part[q], names[w], int(numbers[w])) for q, w in zip(query.tolist(), word.tolist())]
                if way:  # forwards the pair is found, too, if its first letters agree
                    pairs = [(q[::-1], w[::-1], n) for q, w, n in pairs if q[: -EXACT[0] - 1 : -1] != w[: -EXACT[0] - 1 : -1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q.decode("latin-1") for q, _, _ in pairs], pa.string()), pa.array([w.decode("latin-1") for _, w, _ in pairs], pa.string()),
                     pa.array([n for _, _, n in pairs], pa.int64())],
                    ["word", "near", "near_n"],
                )

    return dealt.mapInArrow(scan, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word that following ``form`` leads to; for every word with a form. No circles.

    Each round doubles the steps taken and is written to the shared folder; since a form occurs
    at least twice as often as its word, rounds grow with the logarithm of the logarithm of the largest number.
    """
    paths = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = paths.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = stage(further, "spelling-roots")
        paths = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return paths


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the vocabulary.

    Words are runs of Latin letters (U+00C0 to U+00FF included), A-Z in lower case, some
    short of a letter (``words_of``), of ``least_length`` code points (five or more) and
    ``least_count`` occurrences. Near words differ by one inserted, deleted or replaced
    code point. The form is the near word of the largest number, the first in
    code-point order among equals, if it has at least twice the word's own number, else null. The root
    is the end of the forms, the word itself if it has none.

    A null text has no words; a null key counts as ''; rows of one key count each. No
    words give no rows. Other columns do not pass. Jobs run while the frame is built.
    """
    if least_length < sum(EXACT):
        raise ValueError(f"words of fewer than {sum(EXACT)} letters need not agree at either end")
    words = stage(vocabulary(docs, key, text, least_length, least_count), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    formed = F.expr("-best.less >= 2 * n")
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best.form")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"),
    )
    found = stage(joined, "spelling-forms")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
