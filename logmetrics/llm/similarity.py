"""Near-duplicates: documents joined on rare word shingles.

A document's set holds its distinct runs of ``k`` words. Documents of one set are
one class and take part once. Every set is put in one order, rare shingles first:
the corpus is counted into a fixed number of hash buckets, and how far a bucket
stands out decides the place, ties by hash. Two sets similar enough share a shingle
in their first few (the prefix), so documents meet on prefix shingles only. A
meeting must pass filters before the sets themselves are compared: set sizes
(length), what can follow the shared shingle (positions), and how the rest falls
into hash parts (suffix). Each pair is compared once.

Groups of many near-copies would meet in all pairs. So every shingle's documents
first meet its hub, the one most like the others; what links is joined into
components, and further rounds look only at pairs of different components. The last
round looks at all such pairs, so no link between components is missed, and pairs
inside one are never needed.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm.components import components
from logmetrics.llm.text import LOWER, finish, map_runs, powers, release, runs, shingle_hashes, span_hashes, word_bounds

BUCKETS = 1 << 24
BLOCK = 1 << 16
LANES = 256
PARTS, MANY_PARTS, LARGE = 32, 256, 1500
TOKEN_BITS = 50
HASHED_BYTES = 200_000  # of texts taken at once: about a hundred bytes of arrays per byte
PIECE = 1 << 14
BROADCAST_IDS = 1_000_000  # 16 MB; beyond that documents are shuffled to the candidates


def shingles(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and 50-bit token of every shingle, repeats included, and each text's words."""
    low = LOWER[data]
    starts, ends, owner = word_bounds(low, bounds)
    words = span_hashes(low, starts, ends)
    sizes = np.bincount(owner, minlength=len(bounds) - 1)
    tokens = shingle_hashes(words, k)
    whole = owner[: len(tokens)] == owner[k - 1 :] if len(tokens) else np.zeros(0, bool)
    texts, values = [owner[: len(tokens)][whole]], [tokens[whole]]
    first = np.cumsum(sizes) - sizes
    for m in range(1, k):  # texts of fewer words are one shingle
        short = np.flatnonzero(sizes == m)
        if len(short):
            h = np.zeros(len(short), np.uint64)
            for i in range(m):
                h = h * powers(2)[1] + words[first[short] + i]
            texts.append(short)
            values.append(finish(h + np.uint64(m)))
    return np.concatenate(texts), np.concatenate(values) >> np.uint64(64 - TOKEN_BITS), sizes


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.int64 if counts.max() > 255 else np.uint8).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    flat = zlib.decompress(raw)
    return np.frombuffer(flat, np.uint8 if len(flat) == BLOCK else np.int64).astype(np.int64)


def _add_blocks(rows: DataFrame, *keys: str) -> DataFrame:
    def total(table: pa.Table) -> pa.Table:
        counts = np.zeros(BLOCK, np.int64)
        for raw in table.column("counts"):
            counts += _unpacked(raw.as_py())
        return pa.table({
            "block": table.column("block")[:1], "lane": table.column("lane")[:1],
            "counts": pa.array([_packed(counts)], pa.binary()), "total": pa.array([int(counts.sum())], pa.int64()),
        })

    return rows.groupBy(*keys).applyInArrow(total, "block int, lane int, counts binary, total bigint")


def bucket_counts(docs: DataFrame, text: str, k: int) -> DataFrame:
    """How many shingles of all documents fall into each bucket: a written table of blocks.

    A task counts its own texts and hands on its counts in compressed blocks; blocks
    are added up in two steps, so that no group gets more than a share of the tasks'.
    """

    def blocks(held):
        parts = held.reshape(-1, BLOCK)
        for b in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([_packed(parts[b])], pa.binary())], ["block", "counts"])

    def each(batches):
        held = np.zeros(BUCKETS, np.uint16)  # handed on before a bucket is full
        for batch in batches:
            for _, _, data, bounds in runs(batch, text, HASHED_BYTES):
                found = (shingles(data, bounds, k)[1] % np.uint64(BUCKETS)).astype(np.int64)
                for lo in range(0, len(found), PIECE):
                    piece = found[lo : lo + PIECE]
                    if held[piece].max() > np.iinfo(np.uint16).max - PIECE:
                        yield from blocks(held)
                        held[:] = 0
                    np.add.at(held, piece, 1)
        yield from blocks(held)
        del held
        release()

    own = docs.select(text).mapInArrow(each, "block int, counts binary").withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    return stage(_add_blocks(_add_blocks(own, "block", "lane"), "block"), "bucket-counts")


def class_of(counts: np.ndarray, mean: float) -> np.ndarray:
    """0 for buckets no fuller than chance fills them, up to 13 the more they stand out."""
    usual = mean + 4 * np.sqrt(mean) + 1
    over = np.maximum(counts - mean, 1) / max(usual - mean, 1)
    return np.where(counts <= usual, 0, np.clip(np.floor(np.log2(np.maximum(over, 1))) + 1, 1, 13)).astype(np.uint8)


def frequency_classes(counted: DataFrame) -> np.ndarray:
    """The class of each bucket; one byte per bucket comes to the driver, whatever the corpus."""
    mean = (counted.agg(F.sum("total")).first()[0] or 0) / BUCKETS

    def each(batches):
        for batch in batches:
            kinds = [zlib.compress(class_of(_unpacked(x.as_py()), mean).tobytes(), 1) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.binary())], ["block", "kinds"])

    out = np.zeros((BUCKETS // BLOCK, BLOCK), np.uint8)
    for row in counted.select("block", "counts").mapInArrow(each, "block int, kinds binary").collect():
        out[row.block] = np.frombuffer(zlib.decompress(row.kinds), np.uint8)
    return out.ravel()


def ordered_sets(data: np.ndarray, bounds: np.ndarray, k: int, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, token and class of the distinct shingles, each text's in the common order; by token alone without classes."""
    texts, tokens, _ = shingles(data, bounds, k)
    kind = np.zeros(len(tokens), np.uint64) if classes is None else classes[(tokens % np.uint64(BUCKETS)).astype(np.int64)].astype(np.uint64)
    keys = np.sort((texts.astype(np.uint64) << np.uint64(54)) | (kind << np.uint64(TOKEN_BITS)) | tokens)
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    mask = np.uint64((1 << TOKEN_BITS) - 1)
    return (keys >> np.uint64(54)).astype(np.int64), keys & mask, ((keys >> np.uint64(TOKEN_BITS)) & np.uint64(15)).astype(np.int64)


def profiles(docs: DataFrame, key: str, text: str, k: int, percent: int, classes: np.ndarray) -> DataFrame:
    """Per document: key ``v``, set size ``n``, digest ``d1``, ``d2``, ``prefix`` in order, sizes of hash ``parts``, ``rank``."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def work(batch, data, bounds):
        release()
        rows = batch.num_rows
        owner, tokens, kind = ordered_sets(data, bounds, k, shared.value)
        n = np.bincount(owner, minlength=rows)
        first = np.cumsum(n) - n
        place = np.arange(len(owner)) - first[owner]
        least = (percent * n + 99) // 100
        in_prefix = place < (n - least + 1)[owner]
        full = n > 0
        d1, d2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
        if len(tokens):
            d1[full] = np.add.reduceat(finish(tokens), first[full])
            d2[full] = np.add.reduceat(finish(tokens ^ np.uint64(0x5DEECE66D)), first[full])
        width = np.where(n >= LARGE, MANY_PARTS, PARTS)
        begin = np.cumsum(width) - width
        part = (tokens >> np.uint64(30)).astype(np.int64) % width[owner]
        parts = np.bincount(begin[owner] + part, minlength=int(width.sum())).astype(np.int32)
        kinds = np.bincount(owner, weights=kind, minlength=rows) / np.maximum(n, 1)
        held = np.bincount(owner[in_prefix], minlength=rows)
        offsets = pa.array(np.concatenate(([0], np.cumsum(held))).astype(np.int32))
        return {
            "v": batch.column(0), "n": n, "d1": d1.view(np.int64), "d2": d2.view(np.int64),
            "prefix": pa.ListArray.from_arrays(offsets, pa.array(tokens[in_prefix].astype(np.int64))),
            "parts": pa.ListArray.from_arrays(pa.array(np.append(begin, len(parts)).astype(np.int32)), pa.array(parts)),
            "rank": np.rint(kinds * 1000).astype(np.int32),
        }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"v {kind}, n int, d1 bigint, d2 bigint, prefix array<bigint>, parts array<int>, rank int"
    return map_runs(docs.select(F.col(key).alias("v"), F.col(text).alias("text")), "text", ["v"], schema, work, HASHED_BYTES)


def _least_overlap(n1: Column, n2: Column, percent: int) -> Column:
    return F.ceil(F.lit(percent) * (n1 + n2) / F.lit(100 + percent))


def _may_meet(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """The length and the positional filter for two documents that share a shingle."""
    fits = (n1 * 100 >= n2 * percent) & (n2 * 100 >= n1 * percent)
    return fits & (F.least(n1 - pos1, n2 - pos2) >= _least_overlap(n1, n2, percent))


def matching(docs: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` whose key is (``left_semi``) or is not (``left_anti``) among ``ids``, a written table of one column.

    Up to ``BROADCAST_IDS`` rows the ids go to every task and documents stay where they are.
    """
    ids = ids.toDF(key)
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def _verified(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that link: suffix filter first, then the sets themselves."""
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("v").alias(side), F.col("n").alias(f"n_{side}"), F.col("parts").alias(f"parts_{side}")), side)
    common = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    common = F.when(F.size("parts_a") == F.size("parts_b"), common).otherwise(F.least("n_a", "n_b"))
    left = stage(pairs.filter(common >= _least_overlap(F.col("n_a"), F.col("n_b"), percent)).select("a", "b").distinct(), "candidates")
    ids = stage(left.select(F.col("a").alias("v")).union(left.select("b")).distinct(), "candidate-ids")

    def sets(batch, data, bounds):
        release()
        owner, tokens, _ = ordered_sets(data, bounds, k)
        n = np.bincount(owner, minlength=batch.num_rows)
        ends = np.cumsum(n)
        return {"v": batch.column(0), "held": [tokens[e - m : e].tobytes() for e, m in zip(ends, n)]}

    texts = matching(docs.select(F.col(key).alias("v"), F.col(text).alias("text")), "v", ids, "left_semi")
    held = map_runs(texts, "text", ["v"], f"v {docs.schema[key].dataType.simpleString()}, held binary", sets, HASHED_BYTES)
    held_a, held_b = (held.select(F.col("v").alias(s), F.col("held").alias(f"held_{s}")) for s in ("a", "b"))

    def compare(batches):
        last, mine = None, None
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            links = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                raw = a[i].as_py()
                if raw != last:
                    last, mine = raw, np.frombuffer(raw, np.uint64)
                other = np.frombuffer(b[i].as_py(), np.uint64)
                both = len(mine) + len(other)
                same = both - len(np.unique(np.concatenate((mine, other))))
                links[i] = 100 * same >= percent * (both - same)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(links)), batch.column(1).filter(pa.array(links))], ["a", "b"])
        release()

    kind = docs.schema[key].dataType.simpleString()
    joined = left.join(held_b, "b").join(held_a, "a").select("a", "b", "held_a", "held_b")
    return joined.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Per document: key, ``n_shingles`` and ``component_id``, the least key reachable by links, itself included.

    Two documents link when ``100 * intersection >= percent * union`` of their sets
    of ``k``-word shingles; a text of fewer words is one shingle as a whole. A null or
    empty text, or one without words, has an empty set and links with nothing. One
    row per input row; rows that share a key are one document, whose texts all count,
    and come back with one component. A row without key comes back without component
    and links with nothing. Other columns do not pass.

    Jobs run while the frame is built; what they make is written below
    ``spark.checkpoint.dir``. The driver gets counts of fixed size only.
    """
    own = docs.select(F.col(key).alias("v"), F.col(text).alias("text"))
    classes = frequency_classes(bucket_counts(own, "text", k))
    profile = stage(profiles(own, "v", "text", k, percent, classes), "profiles")
    named = profile.filter(F.col("v").isNotNull() & (F.col("n") > 0))
    least = named.groupBy("n", "d1", "d2").agg(F.min("v").alias("r"))
    members = stage(named.select("v", "n", "d1", "d2").join(least, ["n", "d1", "d2"]).select("v", "n", "r", "d1", "d2"), "members")
    heads = members.filter("v = r").select("v", "n", "d1", "d2").distinct()
    sizes = stage(profile.join(heads, ["v", "n", "d1", "d2"], "left_semi").dropDuplicates(["v", "n", "d1", "d2"]), "heads")

    entries = sizes.select("v", "n", F.posexplode("prefix").alias("pos", "token"))
    several = entries.groupBy("token").count().filter("count > 1").select("token")
    meeting = stage(entries.join(several, "token").join(sizes.select("v", "n", "rank"), ["v", "n"]), "meeting")

    # Rows of one key with several texts are links of their own.
    links = members.groupBy("v").agg(F.min("r").alias("a"), F.max("r").alias("b")).filter("a != b").select("a", "b")
    again = members.join(members.groupBy("v").agg(F.min("r").alias("a"), F.max("r").alias("z")).filter("a != z").select("v", "a"), "v")
    links = stage(links.union(again.filter("a != r").select("a", F.col("r").alias("b"))), "links")

    found, before = components(links), None
    while True:
        pairs, before = _pairs(meeting, found, percent, before)
        if pairs is None:
            break
        new = stage(_verified(pairs, sizes, own, "v", "text", k, percent), "links")
        if not new.isEmpty():
            links = links.union(new)
            found = components(links)
        if before is None:
            break
    ids = members.select("v", "r").join(found.select(F.col("v").alias("r"), "c"), "r", "left")
    ids = ids.groupBy("v").agg(F.min(F.coalesce("c", "r")).alias("component_id"))
    out = profile.select("v", F.col("n").cast("bigint").alias("n_shingles")).join(ids, "v", "left")
    return out.select(F.col("v").alias(key), "n_shingles", F.coalesce("component_id", "v").alias("component_id"))


def _pairs(meeting: DataFrame, found: DataFrame, percent: int, before: int | None) -> tuple[DataFrame | None, int | None]:
    """Pairs of different components that share a prefix shingle and pass the first filters; None where there are none.

    Per shingle the component with most documents is the main one. All pairs are
    those of every document outside it with every other. At first, and where these are
    many, each shingle's hub outside meets the others instead, and their number is
    returned, to be given as ``before`` next time: hubs go on as long as a round of
    them brings it down by a third. With all pairs None is returned instead.
    """
    here = stage(meeting.join(found, "v", "left").withColumn("c", F.coalesce("c", "v")), "met")
    sized = here.groupBy("token", "c").count()
    main = sized.groupBy("token").agg(F.max(F.struct("count", "c")).alias("main"), F.sum("count").alias("total"), F.count("*").alias("groups"))
    mixed = main.filter("groups > 1").select("token", F.col("main.c").alias("m"), (F.col("total") - F.col("main.count")).alias("outside"), "total")
    mixed = stage(mixed, "mixed")
    cost, total, tokens = mixed.agg(F.sum(F.col("outside") * F.col("total")), F.sum("total"), F.count("*")).first()
    if not tokens:
        return None, None
    rows = here.join(mixed.select("token", "m"), "token")
    all_pairs = before is not None and (cost <= 4 * total or cost > 2 * before // 3)
    outside = rows.filter("c != m")
    if not all_pairs:
        hub = F.max_by(F.struct("v", "n", "pos", "c"), F.struct("rank", "v"))
        outside = outside.groupBy("token").agg(hub.alias("hub")).select("token", "hub.*")
    left = outside.select("token", *[F.col(c).alias(f"{c}1") for c in ("v", "n", "pos", "c")])
    met = left.join(rows.select("token", "v", "n", "pos", "c", "m"), "token")
    # Both outside: they meet in either order, one is enough. A hub meets once.
    once = F.lit(True) if not all_pairs else (F.col("c") == F.col("m")) | (F.col("v1") < F.col("v"))
    met = met.filter((F.col("c1") != F.col("c")) & once & _may_meet(F.col("n1"), F.col("pos1"), F.col("n"), F.col("pos"), percent))
    return met.select(F.least("v1", "v").alias("a"), F.greatest("v1", "v").alias("b")).distinct(), None if all_pairs else cost


def one_per_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows without exact copies, whatever their keys: of rows of one text that with the least key stays, before those without key.

    Rows without words are left as they are. Only rows of a repeated text are shuffled, one per task and text.
    """
    names = docs.columns
    cells = [f"_c{i}" for i in range(len(names))]
    body, least = cells[names.index(text)], cells[names.index(key)]
    rows = docs.toDF(*cells).withColumn("_digest", F.when(F.col(body).rlike(r"[^\x20\x09-\x0D]"), F.sha2(body, 256)))
    repeated = stage(rows.filter("_digest IS NOT NULL").groupBy("_digest").count().filter("count > 1").select("_digest"), "repeated")
    order = F.struct(F.col(least).isNull(), F.col(least), F.xxhash64(*cells))
    several = matching(rows, "_digest", repeated, "left_semi").groupBy("_digest").agg(F.min_by(F.struct(*cells), order).alias("row"))
    whole = matching(rows, "_digest", repeated, "left_anti").select(*cells).unionByName(several.select("row.*"))
    return whole.select(*[F.col(c).alias(name) for c, name in zip(cells, names)])
