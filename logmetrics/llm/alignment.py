"""Tokens of two tokenizers aligned by the bytes they cover.

A is a byte-level vocabulary of the ``tokenizers`` library, B a SentencePiece file. Each
library says where its tokens end: A in characters, B in the spans of its proto.
These ends are the coarse cuts. They do not tell tokens apart that share a character
(A splits long characters, B falls back to bytes); such tokens are refined by the
bytes they decode to. From the byte ends follow the groups (between ends that
A and B share) and the links (tokens whose ranges overlap: one per end of either).

A text is cut into units where neither library joins anything, so that a text's
groups and links are those of its units, and each distinct unit is encoded and aligned
once per batch and, while a bounded table has room, once per process. Cuts are: after a
letter before anything else, and before a lone space with a letter behind it. That B's merges
stay in a unit is proved from its vocabulary. A splits there by its pattern; every
character is first held against the library's own split, and a text with a
character that the pattern here sees differently is one unit as a whole.
"""

import hashlib
import os
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm.tokens import MARK, counts_of

TEXTS_AT_ONCE = 500
RUN_CHARS = 200_000
REMEMBERED = 3_000_000  # links of known units in a process: about 200 MB
HOT_PAIRS = 1 << 20  # id pairs whose counts go to every task: 17 MB
FLUSH = 4_000_000  # pair counts that a task gathers before it hands them on

# How a byte-level vocabulary splits text, and which bytes it writes as themselves.
SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

UNIT = rf" ?\p{{L}}+|[^\p{{L}}]+(?<![ {MARK}])(?= \p{{L}})|[^\p{{L}}]*\p{{L}}+|[^\p{{L}}]+"


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for."""
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


def character_ends(text: str, ids: list[int], offsets: list[tuple[int, int]], decoded: list[bytes]) -> list[int]:
    """Byte ends of tokens whose places are given in characters.

    Where the next token begins before this one ends, both share a character: the
    end then follows from the bytes that the token decodes to.
    """
    if text.isascii():
        return [end for _, end in offsets]
    at = [0, *accumulate(len(c.encode()) for c in text)]
    ends: list[int] = []
    for k, (_, end) in enumerate(offsets):
        shared = k + 1 < len(offsets) and offsets[k + 1][0] < end
        ends.append((ends[-1] if ends else 0) + len(decoded[ids[k]]) if shared else at[end])
    return ends


class Codes(dict):
    """Numbers of units in the order in which they come."""

    def __missing__(self, unit: str) -> int:
        self[unit] = code = len(self)
        return code


class Flat:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.n = np.zeros(1024, kind), 0

    def add(self, values: list | np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(len(values) + self.n, self.held.dtype)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Both vocabularies and the units aligned so far, ready in a process."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.is_byte = [self.b.is_byte(i) for i in range(n_b)]
        counts_of(path_b)  # proves that no merge puts a mark behind another character, or joins a line feed
        plain = [p for i, p in enumerate(pieces) if not (self.is_byte[i] or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(regex.search(rf"\p{{L}}[^\p{{L}}{MARK}]", p) for p in plain):
            raise ValueError("a piece goes on after its letters: units would be joined")
        letters = byte_letters()
        entry = lambda token: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_a = [entry(self.a.id_to_token(i) or "") for i in range(n_a)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode() for p, byte in zip(pieces, self.is_byte)]
        self.split, self.unit = regex.compile(SPLIT), regex.compile(UNIT)
        self.proved: set[str] = set()
        self.odd: set[str] = set()
        self.width = len(str(max(n_a, n_b)))
        self.digits = np.zeros((max(n_a, n_b), self.width), np.uint8)
        for i in range(len(self.digits)):
            self.digits[i, : len(str(i))] = list(str(i).encode())
        self.n_digits = (self.digits > 0).sum(axis=1)
        self.clear()

    def clear(self) -> None:
        self.codes = Codes()
        self.counts = {c: Flat(np.int64) for c in COUNTS}
        self.good, self.first, self.pairs, self.digest = Flat(bool), Flat(np.int64), Flat(np.int64), []

    def encode_a(self, units: list[str]) -> tuple[list[int], list[int], list[int]]:
        """Ids and byte ends of all units behind each other, and tokens per unit."""
        ids, ends, sizes = [], [], []
        for unit, e in zip(units, self.a.encode_batch(units, add_special_tokens=False)):
            own = e.ids
            ids += own
            ends += character_ends(unit, own, e.offsets, self.bytes_a)
            sizes.append(len(own))
        return ids, ends, sizes

    def encode_b(self, units: list[str]) -> tuple[list[int], list[int], list[int]]:
        """The library puts a mark before a text: a unit gives its first mark up for that, or follows a line feed, which costs two tokens."""
        marked = [u[0] in (" ", MARK) and len(u) > 1 for u in units]
        protos = self.b.encode([u[1:] if m else "\n" + u for u, m in zip(units, marked)], return_type="proto", num_threads=1)
        ids, ends, sizes = [], [], []
        for m, proto in zip(marked, protos):
            shift, end = (1 if m else -1), 0
            pieces = proto.pieces if m else proto.pieces[2:]
            for piece in pieces:
                # A byte whose span is empty is not the last of its character.
                inner = piece.begin == piece.end and self.is_byte[piece.id]
                end = end + 1 if inner else piece.end + shift
                ids.append(piece.id)
                ends.append(end)
            sizes.append(len(pieces))
        return ids, ends, sizes

    def _prove(self, characters: set[str]) -> None:
        """Does our pattern split around each character as the library does?"""
        for c in characters:
            probe = f"a{c}a 1{c}1 !{c}! {c} {c}{c}a '{c}\n{c}"
            theirs = [probe[x:y] for _, (x, y) in self.a.pre_tokenizer.pre_tokenize_str(probe)]
            (self.proved if self.split.findall(probe) == theirs else self.odd).add(c)

    def units(self, text: str) -> list[str]:
        """Units, which end to end are the text."""
        characters = set(text)
        if not characters <= self.proved:
            self._prove(characters - self.proved - self.odd)
        return [text] if characters & self.odd else self.unit.findall(text)

    def _lay_out(self, ids: list[int], ends: list[int], sizes: list[int], decoded: list[bytes], raw: list[bytes]) -> tuple[np.ndarray, ...]:
        """Ids, ends (of all units behind each other), units, and which units their tokens give back."""
        tokens = map(decoded.__getitem__, ids)
        good = np.array([b"".join(islice(tokens, n)) == r for n, r in zip(sizes, raw)], bool)
        owner = np.repeat(np.arange(len(raw)), sizes)
        n_bytes = np.array([len(r) for r in raw], np.int64)
        return np.array(ids, np.int64), np.array(ends, np.int64) + (np.cumsum(n_bytes) - n_bytes)[owner], owner, good

    def _learn(self, units: list[str]) -> None:
        """Align new units."""
        raw = [u.encode() for u in units]
        a, a_ends, of_a, good_a = self._lay_out(*self.encode_a(units), self.bytes_a, raw)
        b, b_ends, of_b, good_b = self._lay_out(*self.encode_b(units), self.bytes_b, raw)
        good = good_a & good_b
        (a, a_ends, of_a), (b, b_ends, of_b) = ([x[good[of]] for x in (ids, ends, of)] for ids, ends, of in ((a, a_ends, of_a), (b, b_ends, of_b)))
        per_unit = lambda of: np.bincount(of, minlength=len(units))
        n_a, n_b = per_unit(of_a), per_unit(of_b)
        # Where A ends, and where B ends, in all bytes.
        ends = np.zeros((2, sum(map(len, raw)) + 1), bool)
        ends[0, a_ends] = ends[1, b_ends] = True
        shared, every = np.flatnonzero(ends[0] & ends[1]), np.flatnonzero(ends[0] | ends[1])
        before_a, before_b = np.cumsum(ends[0]) - ends[0], np.cumsum(ends[1]) - ends[1]
        groups = np.cumsum(ends[0] & ends[1]) - (ends[0] & ends[1])
        group_a, group_b = groups[a_ends], groups[b_ends]

        # Tokens in the order of the digest: a group's A, then its B; each with what stands behind it.
        at_a = np.arange(len(a)) + np.concatenate(([0], before_b[shared] + 1))[group_a]
        at_b = np.arange(len(b)) + (before_a[shared] + 1)[group_b]
        ids, behind = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
        ids[at_a], ids[at_b] = a, b
        behind[at_a] = np.where(shared[group_a] == a_ends, ord("|"), ord(","))
        behind[at_b] = np.where(shared[group_b] == b_ends, ord(";"), ord(","))
        behind[at_b[(np.cumsum(n_b) - 1)[good]]] = 0
        letters = np.empty((len(ids), self.width + 1), np.uint8)
        letters[:, :-1], letters[:, -1] = self.digits[ids], behind
        flat = letters[letters > 0].tobytes()
        cut = np.concatenate(([0], np.cumsum(self.n_digits[ids] + (behind > 0))))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()

        in_a, in_b = before_a[every], before_b[every]
        links = per_unit(of_a[in_a])
        self.good.add(good)
        for c, n in zip(COUNTS, (n_a, n_b, per_unit(of_a[before_a[shared]]), links)):
            self.counts[c].add(n)
        self.first.add(np.cumsum(links) - links + self.pairs.n)
        self.pairs.add(a[in_a] * len(self.bytes_b) + b[in_b])
        self.digest += [flat[x:y] for x, y in zip(cut[:-1], cut[1:])]

    def align(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """Numbers, digest of the groups, and id pairs with their links, of each text that is not empty and given back; ``good`` says which."""
        if self.pairs.n > REMEMBERED:
            self.clear()
        known = len(self.codes)
        parts = [self.units(" " + t) for t in texts]
        listed = list(map(self.codes.__getitem__, chain.from_iterable(parts)))
        if new := list(islice(self.codes, known, None)):
            self._learn(new)
        codes, sizes = np.array(listed, np.int64), np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        total = lambda values: np.rint(np.bincount(owner, weights=values, minlength=len(texts))).astype(np.int64)
        good = total(~self.good.held[codes]) == 0
        found = {c: total(self.counts[c].held[codes])[good] for c in COUNTS}
        at, where = [0, *accumulate(sizes.tolist())], np.flatnonzero(good).tolist()
        digests = [hashlib.sha256(b";".join(map(self.digest.__getitem__, listed[at[i] : at[i + 1]]))).hexdigest() for i in where]

        codes, owner = codes[good[owner]], owner[good[owner]]
        links = self.counts["n_links"].held[codes]
        place = np.arange(int(links.sum())) + np.repeat(self.first.held[codes] - (np.cumsum(links) - links), links)
        bits = (len(self.bytes_a) * len(self.bytes_b)).bit_length()
        keys = np.sort(np.repeat(owner, links) << bits | self.pairs.held[place])
        heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        cut = np.searchsorted(keys[heads] >> bits, where[1:])
        times = np.diff(np.append(heads, len(keys)))
        return {"good": good, **found, "groups_sha256": digests, "pairs": np.split(keys[heads] & ((1 << bits) - 1), cut), "times": np.split(times, cut)}


@lru_cache(maxsize=2)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and the linked id pairs: ``pairs`` (``a * size of B + b``, sorted) with ``times``.

    The digest is that of ``a1,a2|b1;a3|b2``, ids of A and B by group. One row per
    input row, repeated and null keys included. A text that is null or empty, or that
    a vocabulary does not give back byte by byte, has no tokens: zeros, '' and empty
    lists. Both files lie at the same path on every executor. Other columns do not
    pass. No shuffle.
    """
    name = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {name}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", groups_sha256 string, pairs array<bigint>, times array<int>"

    def runs(values):
        lo, size = 0, 0
        for i, t in enumerate(values):
            if i > lo and (i - lo == TEXTS_AT_ONCE or size + len(t or "") > RUN_CHARS):
                yield lo, i
                lo, size = i, 0
            size += len(t or "")
        if len(values) > lo:
            yield lo, len(values)

    def each(batches):
        tools = aligner_of(path_a, path_b)
        for batch in batches:
            values = batch.column(1).to_pylist()
            for lo, hi in runs(values):
                full = [i for i in range(lo, hi) if values[i]]
                got = tools.align([values[i] for i in full]) if full else {"good": []}
                where = np.array([i - lo for i, g in zip(full, got["good"]) if g], np.int64)
                counts = {c: np.zeros(hi - lo, np.int64) for c in COUNTS}
                digests, pairs, times = [""] * (hi - lo), [[]] * (hi - lo), [[]] * (hi - lo)
                if len(where):
                    for c in COUNTS:
                        counts[c][where] = got[c]
                    for i, d, p, t in zip(where, got["groups_sha256"], got["pairs"], got["times"]):
                        digests[i], pairs[i], times[i] = d, p, t.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *[pa.array(counts[c]) for c in COUNTS], pa.array(digests, pa.string()),
                     pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                    [key, *COUNTS, "groups_sha256", "pairs", "times"],
                )

    return docs.select(key, text).mapInArrow(each, schema)


def _flat(batch: pa.RecordBatch, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a list column, and how many each row has."""
    lists = batch.column(batch.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), np.diff(lists.offsets.to_numpy())


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` (links that hold it, in all texts) and ``best`` (no pair of the same B id has more): a written table.

    Tasks add up their own texts first, so a common pair leaves each task a few times.
    """

    def each(batches):
        held, size = [], 0

        def total():
            pairs, inverse = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(inverse, weights=np.concatenate([t for _, t in held]), minlength=len(pairs)).astype(np.int64)

        out = lambda pairs, n: pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])
        for batch in batches:
            held.append((_flat(batch, "pairs", np.int64)[0], _flat(batch, "times", np.int64)[0]))
            size += len(held[-1][0])
            if size > FLUSH:
                held = [total()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield out(*held[0])
                    held, size = [], 0
        if held:
            yield out(*total())

    own = aligned.select("pairs", "times").mapInArrow(each, "pair bigint, n bigint")
    counts = stage(own.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # One row per id of B at most.
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    marked = counts.join(F.broadcast(most), F.col("pair") % size_b == F.col("b"))
    return stage(marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def _hot_from(counts: DataFrame) -> int:
    """The least power of two that at most ``HOT_PAIRS`` counts reach."""
    by_size = {r.bits: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("bits")).count().collect()}
    bits, seen = 63, 0
    while bits and seen + by_size.get(bits - 1, 0) <= HOT_PAIRS:
        bits -= 1
        seen += by_size.get(bits, 0)
    return 1 << bits if bits < 63 else (1 << 63) - 1


def add_counts(aligned: DataFrame, counts: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a written ``aligned`` table with a column ``row`` that names its rows, ``n_best`` and ``count_sum``.

    The counts of the commonest pairs, ``HOT_PAIRS`` at most, go to every task and
    rows stay where they are; only links of the other pairs, where there are any,
    are shuffled to their counts, none of which has as many rows as a hot one.
    """
    least = _hot_from(counts)
    hot = counts.filter(F.col("n") >= least).orderBy("pair").toPandas()
    shared = aligned.sparkSession.sparkContext.broadcast((hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool)))

    def find(batch):
        known, n, best = shared.value
        pairs, sizes = _flat(batch, "pairs", np.int64)
        times, owner = _flat(batch, "times", np.int64)[0], np.repeat(np.arange(batch.num_rows), sizes)
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        return pairs, times, owner, at, hit, n, best

    def sums(batches):
        for batch in batches:
            _, times, owner, at, hit, n, best = find(batch)
            total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner[hit], times[hit] * n[at[hit]])
            np.add.at(good, owner[hit], times[hit] * best[at[hit]])
            kept = [batch.column(i) for i in range(len(columns) + 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(good), pa.array(total)], [*columns, "row", "n_best", "count_sum"])

    def others(batches):
        for batch in batches:
            pairs, times, owner, _, hit, _, _ = find(batch)
            rows = batch.column(0).to_numpy()[owner[~hit]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pairs[~hit]), pa.array(times[~hit])], ["row", "pair", "times"])

    kinds = "".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}, " for c in columns)
    known = aligned.select(*columns, "row", "pairs", "times").mapInArrow(sums, f"{kinds}row bigint, n_best bigint, count_sum bigint")
    if least == 1:
        return known.drop("row")
    rest = aligned.select("row", "pairs", "times").mapInArrow(others, "row bigint, pair bigint, times bigint")
    rest = rest.join(counts.filter(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best")
    )
    both = known.join(rest, "row", "left")
    add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return both.select(*columns, add("n_best", "more_best"), add("count_sum", "more"))


def score_links(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``align`` without its pairs, with ``n_best`` (links whose pair is the commonest of its B id, ties included) and ``count_sum`` (over links, the count of their pair in all texts).

    The alignment is written once and read twice. Rows as in ``align``; an empty table has none.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = stage(align(docs, path_a, path_b, key, text).withColumn("row", F.monotonically_increasing_id()), "aligned")
    return add_counts(aligned, pair_counts(aligned, size_b), [key, *COUNTS, "groups_sha256"])
