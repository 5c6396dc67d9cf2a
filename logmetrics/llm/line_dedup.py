"""Lines that many documents repeat, found in sorted hashes and returned as bitmaps.

Every line long enough becomes a row of its key's 128-bit hash, its document and its
place. Rows are range-partitioned and sorted by hash, then document (largest first),
then place, and a stream over each partition meets a hash's first document first: that
one keeps the line. A hash may run over any number of partitions, however many rows it
has, since the document is part of the sort key. Such a run is left open in each of
them; its documents are added up from one row per partition, and the open rows are
settled by these sums. What comes back is a compressed bitmap of kept lines per
document, no text.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from logmetrics.functions.staging import stage

SPACE = " \t\n\x0b\x0c\r"  # fixed value: what is stripped from both ends of a line
LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
FLUSH = 500_000  # lines that a task hashes before it hands them on
NONE, DROP, OPEN, SUM = -1, 0, 1, 2


def line_hashes(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``h1``, ``h2`` (hash of the key), ``doc``, ``t`` (hash of the whole text) and ``line`` of every line whose key has ``least`` code points."""
    import xxhash

    def each(batches):
        keys, rows, lines = [], [], []

        def out(batch):
            parts = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(parts[:, 0]), pa.array(parts[:, 1]), batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.int32())],
                ["h1", "h2", "doc", "t", "line"],
            )

        for batch in batches:
            for row, value in enumerate(batch.column(2).to_pylist()):
                for line, content in enumerate(value.split("\n")) if value else ():
                    content = content.strip(SPACE)
                    if len(content) >= least:
                        keys.append(xxhash.xxh3_128_digest(content.encode().lower()))  # bytes: A-Z only
                        rows.append(row)
                        lines.append(line)
                if len(keys) > FLUSH:
                    yield out(batch)
                    keys, rows, lines = [], [], []
            if keys:
                yield out(batch)
                keys, rows, lines = [], [], []

    named = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    return named.mapInArrow(each, f"h1 bigint, h2 bigint, doc {docs.schema[key].dataType.simpleString()}, t bigint, line int")


class Stream:
    """Settles the rows of a sorted partition, batch by batch.

    The last hash of a batch may go on in the next. Its rows are held until ``least``
    documents are seen, after which later rows go at once; so never more is held than
    lines of ``least - 1`` documents. The first hash of a partition may have begun in an
    earlier one, so all its rows are open; so are those held when the partition ends. For both
    hashes a sum goes out: the first document here and the number of documents.
    """

    def __init__(self, least: int, schema: pa.Schema):
        self.least, self.schema = least, schema
        self.held: pa.Table | None = None  # undecided rows of the last hash, counted anew with the next batch
        self.hash, self.first = None, False  # the last hash; is it the partition's first?
        self.seen, self.top, self.last = 0, None, None  # its documents, the first and the latest of them

    def _sum(self, seen: int) -> pa.Table:
        values = [*self.hash, self.top, 0, min(seen, self.least), SUM]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, self.schema)], schema=self.schema)

    def _marked(self, rows: pa.Table, states: np.ndarray) -> pa.Table:
        picked = pa.array(states >= 0)
        return rows.append_column(self.schema.field("state"), pa.array(states, pa.int32())).filter(picked)

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        rows = pa.Table.from_batches([batch])
        rows = rows if self.held is None else pa.concat_tables([self.held, rows]).combine_chunks()
        h1, h2, doc = rows.column("h1").to_numpy(), rows.column("h2").to_numpy(), rows.column("doc")
        goes_on = self.held is None and self.hash == (h1[0], h2[0])
        if self.first and not goes_on:
            yield self._sum(self.seen)
        is_first = self.hash is None or (goes_on and self.first)
        fresh = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        starts = fresh | np.concatenate(([True], pc.not_equal(doc.slice(1), doc.slice(0, len(doc) - 1)).to_numpy().astype(bool)))
        before = self.seen if goes_on else 0
        starts[0] = not goes_on or doc[0] != self.last
        run, heads = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        upto = np.cumsum(starts)
        number = upto - (upto[heads] - starts[heads])[run]  # of the document in its run
        number[run == 0] += before
        documents = number[np.append(heads[1:], len(number)) - 1]
        states = np.where((documents[run] >= self.least) & (number > 1), DROP, NONE)
        if is_first:
            states[run == 0] = OPEN
        yield self._marked(rows, states)

        self.top = self.top if goes_on else doc[0].as_py()
        if is_first and len(heads) > 1:
            self.hash = (h1[0], h2[0])
            yield self._sum(int(documents[0]))
        at = int(heads[-1])
        self.first = is_first and len(heads) == 1
        self.hash, self.seen, self.last = (h1[at], h2[at]), int(documents[-1]), doc[len(doc) - 1]
        self.top = self.top if at == 0 else doc[at].as_py()
        self.held = rows.slice(at) if not self.first and self.seen < self.least else None

    def close(self) -> Iterator[pa.Table]:
        if self.held is not None:
            yield self._marked(self.held, np.full(len(self.held), OPEN))
        if self.hash is not None:
            yield self._sum(self.seen)


def dropped_lines(docs: DataFrame, key: str, text: str, least_length: int, least_documents: int) -> DataFrame:
    """``doc``, ``t`` and ``line`` of the lines to drop. Runs jobs."""
    hashes = stage(line_hashes(docs, key, text, least_length), "line-hashes")
    # The place has no part in dealing out, so that rows of one document and hash stay together.
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    dealt = hashes.repartitionByRange(*order).sortWithinPartitions(*order, "line")

    schema = StructType.fromDDL(f"h1 bigint, h2 bigint, doc {docs.schema[key].dataType.simpleString()}, t bigint, line int, state int")
    arrow = to_arrow_schema(schema)

    def each(batches):
        stream = Stream(least_documents, arrow)
        for batch in batches:
            for table in stream.take(batch) if batch.num_rows else ():
                yield from table.to_batches()
        for table in stream.close():
            yield from table.to_batches()

    settled = stage(dealt.mapInArrow(each, schema), "line-runs")
    # Two rows per partition at most.
    sums = settled.filter(F.col("state") == SUM).groupBy("h1", "h2").agg(F.max("doc").alias("top"), F.sum("line").alias("documents"))
    common = sums.filter(F.col("documents") >= least_documents).select("h1", "h2", "top")
    late = settled.filter(F.col("state") == OPEN).join(F.broadcast(common), ["h1", "h2"]).filter("doc != top")
    return settled.filter(F.col("state") == DROP).select("doc", "t", "line").union(late.select("doc", "t", "line"))


def pack(dropped: np.ndarray) -> bytes:
    """A compressed bitmap of kept lines, whole bytes up to the last that goes."""
    kept = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    kept[dropped] = False
    return zlib.compress(np.packbits(kept).tobytes(), 1)


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """``doc``, ``t``, ``n_dropped`` and ``keep`` (compressed bitmap up to the last dropped line) of every document that loses a line.

    Lines are parted at line feeds. A line's key is the line without white space at
    both ends, A-Z in lower case. A key of ``least_length`` code points or more that
    ``least_documents`` documents hold loses all its lines but those of the largest
    document holding it. ``t`` is the hash of the text: rows that share a key are one
    document for counting, and each of their texts has a bitmap of its own. Rows
    without key take no part. Keys are compared by a 128-bit hash.
    """
    lines = dropped_lines(docs, key, text, least_length, least_documents)
    grouped = lines.groupBy("doc", "t").agg(F.collect_set("line").alias("lines"))

    def each(batches):
        for batch in batches:
            found = [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()), pa.array([pack(x) for x in found], pa.binary())],
                ["doc", "t", "n_dropped", "keep"],
            )

    return grouped.mapInArrow(each, f"doc {docs.schema[key].dataType.simpleString()}, t bigint, n_dropped bigint, keep binary")


def kept_lines(text: str | None, keep: bytes | None) -> tuple[int, int, str]:
    """Lines of a text, how many go, and the text without them. Lines beyond the bitmap stay."""
    lines = (text or "").split("\n")
    if keep is None:
        return len(lines), 0, text or ""
    marks = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).astype(bool)[: len(lines)]
    stay = [line for line, mark in zip(lines, marks) if mark] + lines[len(marks) :]
    return len(lines), len(lines) - len(stay), "\n".join(stay)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Key, ``n_lines`` (before dropping), ``n_dropped`` and ``kept``, the text of the kept lines, or with ``digest`` ``kept_sha256`` instead, per row.

    One row per input row. A null text is one empty line. The bitmaps are joined by
    key and hash of the text; other columns do not pass.
    """
    named = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    both = named.join(bitmaps.select("doc", "t", "keep"), ["doc", "t"], "left").select("doc", "text", "keep")
    last = "kept_sha256" if digest else "kept"

    def each(batches):
        for batch in batches:
            found = [kept_lines(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            texts = [hashlib.sha256(x.encode()).hexdigest() if digest else x for _, _, x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array([n for _, n, _ in found], pa.int64()), pa.array(texts, pa.string())],
                ["doc", "n_lines", "n_dropped", last],
            )

    out = both.mapInArrow(each, f"doc {docs.schema[key].dataType.simpleString()}, n_lines bigint, n_dropped bigint, {last} string")
    return out.withColumnRenamed("doc", key)
