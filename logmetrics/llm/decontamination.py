"""Passages of test items in documents, found by one automaton.

Items and documents are normalised to lower-case words. An item's words are cut
into blocks of half a window; every window of the item covers a whole block, so an
Aho-Corasick automaton over the blocks alone meets every window, at a tenth of the
size of one over all windows. A meeting is widened to the longest run of words that
item and document share there; a run of a window or more is a hit. An item shorter
than a window is one pattern and hits as a whole.

The text is scanned once. Normalising keeps every byte in its place, so a hit's
words lead back to offsets in the original.
"""

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm.text import ddl

BLOCK_BYTES = 2_000_000  # item text in one automaton: about 100 MB of nodes in a task
PASS_BYTES = 64_000_000  # item text sent to the tasks at once
GROUP_BYTES = 64_000_000  # text of documents that meets one automaton after another
TEXTS_AT_ONCE = 500

# Word bytes are digits, letters and everything beyond ASCII.
_WORD_BYTES = [*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]
_TABLE = bytearray(b" " * 256)
for _b in _WORD_BYTES:
    _TABLE[_b] = _b
for _b in range(ord("A"), ord("Z") + 1):
    _TABLE[_b] = _b + 32
NORMAL = bytes(_TABLE)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Patterns:
    """The items of one block, ready to be looked for."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        import ahocorasick

        self.window = window
        self.half = max(1, window // 2)
        self.names = [name for name, _ in items]
        self.words = [words_of(text) for _, text in items]
        blocks = defaultdict(list)
        for i, words in enumerate(self.words):
            if 0 < len(words) < window:
                blocks[self._key(words)].append((i, 0))
            for p in range(0, len(words) - self.half + 1, self.half) if len(words) >= window else ():
                blocks[self._key(words[p : p + self.half])].append((i, p))
        self.automaton = ahocorasick.Automaton()
        for key, places in blocks.items():
            self.automaton.add_word(key, (key.count(" ") - 1, places))
        if blocks:
            self.automaton.make_automaton()

    @staticmethod
    def _key(words: list[bytes]) -> str:
        return f" {b' '.join(words).decode('latin-1')} "

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words, as (first, behind the last), and the items hit."""
        runs: list[tuple[int, int]] = []
        hit: set[int] = set()
        if not words or not len(self.automaton):
            return runs, hit
        ends, done = None, {}
        for at, (size, places) in self.automaton.iter(self._key(words)):
            if ends is None:
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            j = int(np.searchsorted(ends, at)) - size + 1
            for i, p in places:
                if done.get((i, j - p), -1) > j:
                    continue
                item = self.words[i]
                lo, hi = 0, size
                while j - lo > 0 and p - lo > 0 and words[j - lo - 1] == item[p - lo - 1]:
                    lo += 1
                while j + hi < len(words) and p + hi < len(item) and words[j + hi] == item[p + hi]:
                    hi += 1
                done[i, j - p] = j + hi
                if lo + hi >= min(self.window, len(item)):
                    runs.append((j - lo, j + hi))
                    hit.add(i)
        return runs, hit


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def character_spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Places of runs of words in the original text, in characters."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(NORMAL))]
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))  # before each byte
    return [{"start": int(chars[at[a][0]]), "end": int(chars[at[b - 1][1]])} for a, b in runs]


def _groups(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of whole rows, about ``limit`` bytes of text each."""
    held, size = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(lo, TEXTS_AT_ONCE)
            held.append(part)
            size += part.column(column).nbytes
            if size >= limit:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _scan(docs: DataFrame, blocks: list[list[tuple[str | None, str | None]]], window: int, text: str, keep: Sequence[str], again: bool, go_on: bool) -> DataFrame:
    """One pass over ``docs``; ``again``: they hold what earlier passes found, and this adds to it; ``go_on``: another pass needs the text."""
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    spans_ddl = "array<struct<start:bigint,end:bigint>>"
    found_ddl = f"n_words bigint, n_hit bigint, spans {spans_ddl}, runs {spans_ddl}, items array<string>"
    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    earlier = ["runs", "items"] if again else []
    at, names_out = len(keep), [*keep, "_text"][: len(keep) + go_on]

    def each(batches):
        blocks = shared.value
        ready = Patterns(blocks[0], window) if len(blocks) == 1 else None
        for part in _groups(batches, at, 0 if ready else GROUP_BYTES):
            texts = part.column(at).to_pylist()
            words = [words_of(t) for t in texts]
            if again:
                runs = [[(r["start"], r["end"]) for r in x] for x in part.column(at + 1).to_pylist()]
                names = [set(x) for x in part.column(at + 2).to_pylist()]
            else:
                runs, names = [[] for _ in texts], [set() for _ in texts]
            for block in blocks:
                patterns = ready or Patterns(block, window)
                for i, w in enumerate(words):
                    more, hit = patterns.find(w)
                    runs[i] += more
                    names[i].update(patterns.names[k] for k in hit if patterns.names[k] is not None)
            runs = [merged(r) for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[: at + go_on],
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
                    pa.array([character_spans(t, r) if r else [] for t, r in zip(texts, runs)], spans_kind),
                    pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], spans_kind),
                    pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                ],
                [*names_out, "n_words", "n_hit", "spans", "runs", "items"],
            )

    picked = docs.select(*keep, F.col(text).alias("_text"), *earlier)
    return picked.mapInArrow(each, ddl(picked, names_out) + found_ddl)


def find_passages(
    docs: DataFrame, items: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), item_key: str = "item_id",
    item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Per document: the columns ``keep``, ``n_words``, ``n_hit`` (words inside a window of any item), ``spans``
    (characters of the original, end not included) and ``items`` (ids as strings, sorted).

    One row per document row, repeated and null keys included. A null or empty text
    has no words and no hits; an item without words (null, empty, only symbols) hits
    nothing; repeated items hit together; an item without id hits, but has no place in
    ``items``. ``keep`` must not hold a name of these or ``_text``; other columns do
    not pass. No shuffle.

    The items' size is measured first, one small job. Up to ``block_bytes`` of item
    text make one automaton. More items are dealt into blocks of about that size,
    and a task goes through its texts in large groups, one automaton after another,
    so it never holds two. Beyond ``pass_bytes`` of item text, which are sent to all
    tasks, documents are read once for each such share, the results so far written
    in between.
    """
    frame, shares = docs, _shares(items, item_key, item_text, block_bytes, pass_bytes)
    for n, blocks in enumerate(shares):
        if n:
            frame = stage(frame, "passages")
        frame = _scan(frame, blocks(), window, "_text" if n else text, keep, n > 0, n + 1 < len(shares))
    return frame.drop("runs")


def _shares(items: DataFrame, item_key: str, item_text: str, block_bytes: int, pass_bytes: int) -> list[Callable[[], list[list[tuple]]]]:
    """The items as shares for one pass each; called, a share comes to the driver in blocks for one automaton each."""
    named = items.select(F.col(item_key).cast("string").alias("name"), F.col(item_text).alias("body"))
    size = named.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))

    def blocks(n: int) -> list[list[tuple]]:
        share = named.filter(F.pmod(F.xxhash64("name", "body"), F.lit(passes)) == n) if passes > 1 else named
        blocks, filled = [[]], 0
        for name, body in share.collect():
            if filled >= block_bytes:
                blocks.append([])
                filled = 0
            blocks[-1].append((name, body))
            filled += len((body or "").encode())
        return blocks

    return [partial(blocks, n) for n in range(passes)]


def _clean(shared: Broadcast, window: int) -> Callable[[Column], Column]:
    """Holds a text no window of the items sent?"""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blocks = shared.value
        ready = Patterns(blocks[0], window) if len(blocks) == 1 else None
        for batch in batches:
            clean = np.ones(len(batch), bool)
            for block in blocks:
                patterns = ready or Patterns(block, window)
                for i in np.flatnonzero(clean).tolist():
                    clean[i] = not patterns.find(words_of(batch[i].as_py()))[0]
            yield pa.array(clean)

    return F.arrow_udf(each, "boolean")


def without_hits(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = 10,
    block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no window of any item.

    As ``find_passages`` with ``n_hit = 0``, but only texts go to Python and only marks
    come back. Beyond ``pass_bytes`` of item text what is left is written between two passes.
    """
    shares = _shares(items, item_key, item_text, block_bytes, pass_bytes)
    for n, blocks in enumerate(shares):
        shared = docs.sparkSession.sparkContext.broadcast(blocks())
        docs = docs.filter(_clean(shared, window)(F.col(text)))
        docs = stage(docs, "passages") if n + 1 < len(shares) else docs
    return docs
