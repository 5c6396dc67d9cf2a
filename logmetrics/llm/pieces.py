"""SentencePiece encoding and decoding by batched Viterbi.

The vocabulary is one of merges, so the library's segmentation is not the one of the
greatest summed score. It is still a best path: a sequence of pieces is what the
merges give if and only if every two neighbours are (a piece next to a piece is
*compatible* if merging their joint text gives just these two). A step of the
Viterbi search therefore costs nothing where piece and predecessor are compatible
and everything where not, and the search returns the library's ids. Characters that
are no piece stand alone and are written as their bytes.

No piece has a space mark behind another character, and none has a line feed, so
words (with the marks before them) are segmented alone; this is proved from the
vocabulary. The distinct words of a batch are sorted by length, and all words of one
length advance together, a matrix of characters. For each piece length the hashes
of all substrings of that length are probed in the sorted hashes of the pieces of
that length, and what is found is compared character by character. The maximum over
piece lengths is taken for all words at once, and the winning length is the
backpointer.
"""

import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.llm.text import ddl

MARK = "▁"  # fixed value: how the vocabulary writes a space
WORD = re.compile(rf"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
REMEMBERED = 350_000
SHORT = 40
TEXTS_AT_ONCE = 500
PAIRS_KEPT = 1 << 19
CELLS = 400_000  # characters of words segmented at once
FILTER_BITS = 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """One vocabulary file, ready to encode."""

    def __init__(self, model: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model)
        size = m.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]
        for i in plain:
            if re.search(f"[^{MARK}]{MARK}", pieces[i]) or ("\n" in pieces[i] and pieces[i] != "\n"):
                raise ValueError(f"piece {pieces[i]!r} joins words: they cannot be segmented alone")
        if m.decode(m.encode(" a  b ")) != " a  b " or m.encode("a") != m.encode("a", add_bos=False) or m.id_to_piece(m.encode(" a"))[0][:1] != MARK:
            raise ValueError("the model changes white space or does not mark the beginning of a text")
        self.bytes_id = {int(pieces[i][3:5], 16): i for i in range(size) if m.is_byte(i)}
        self.unknown = m.unk_id()
        # Ranks: single characters first, then the others as they are merged, and one for any character that is no piece.
        ranked = sorted(plain, key=lambda i: (len(pieces[i]) > 1, -m.get_score(i), i))
        rank = {pieces[i]: r for r, i in enumerate(ranked)}
        self.alone = len(ranked)
        self.ids = np.array([*ranked, self.unknown], np.int32)
        self._learn_merges(rank)
        self.tables = {}
        by_length: dict[int, list[str]] = {}
        for text in rank:
            by_length.setdefault(len(text), []).append(text)
        for n, texts in by_length.items():
            chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), n)
            h = np.zeros(len(texts), np.uint64)
            for j in range(n):
                h = h * _BASE + chars[:, j]
            order = np.argsort(h, kind="stable")
            maybe = np.zeros(1 << FILTER_BITS, bool)
            maybe[h >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[n] = (maybe, h[order], chars[order], np.array([rank[t] for t in texts])[order])
        self.longest = max(by_length)
        self.known: dict[str, bytes] = {}

    def _learn_merges(self, rank: dict[str, int]) -> None:
        """What two pieces join to, and the two that each piece is last merged from."""
        joins = {}
        self.left, self.right = np.arange(len(rank) + 1), np.arange(len(rank) + 1)
        for text, r in rank.items():
            for cut in range(1, len(text)):
                a, b = rank.get(text[:cut]), rank.get(text[cut:])
                if a is not None and b is not None:
                    joins[a, b] = r
        for text, r in rank.items():
            parts = [rank[c] for c in text]
            while len(parts) > 1:
                best = min((joins.get(pair, len(rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
                if best[0] == len(rank):
                    raise ValueError(f"piece {text!r} is not what its own merges give")
                if len(parts) == 2:
                    self.left[r], self.right[r] = parts
                parts[best[1] : best[1] + 2] = [best[0]]
            if parts != [r]:
                raise ValueError(f"piece {text!r} is not what its own merges give")
        keys = np.array([a * (len(rank) + 1) + b for a, b in joins], np.int64)
        order = np.argsort(keys)
        self.join_keys, self.join_ranks = keys[order], np.array(list(joins.values()), np.int64)[order]
        self.pair_keys = np.full(PAIRS_KEPT, -1, np.int64)
        self.pair_fits = np.zeros(PAIRS_KEPT, bool)

    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Compatible? Both pieces are taken apart, latest merge first: a join across their border that comes before the
        merge taken apart would have come first."""
        never = np.int64(1 << 40)
        fits, live, limit = np.ones(len(a), bool), np.arange(len(a)), np.full(len(a), never)
        while len(live):
            key = a * (self.alone + 1) + b
            at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
            early = (self.join_keys[at] == key) & (self.join_ranks[at] < limit)
            fits[live[early]] = False
            inner_a, inner_b = self.right[a], self.left[b]
            take_a = np.where(a > b, inner_a != a, inner_b == b)
            limit = np.where(take_a, a, b + 1)
            done = early | ((inner_a == a) & (inner_b == b))
            a, b = np.where(take_a, inner_a, a)[~done], np.where(take_a, b, inner_b)[~done]
            limit, live = limit[~done], live[~done]
        return fits

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``_walk``, which runs once per pair while the table of known pairs has its place."""
        key = a * (self.alone + 1) + b
        slot = ((key.astype(np.uint64) * _BASE) >> np.uint64(44)).astype(np.int64) % PAIRS_KEPT
        fits = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            fresh = self._walk(keys // (self.alone + 1), keys % (self.alone + 1))
            fits[new] = fresh[back]
            self.pair_keys[slot[new]], self.pair_fits[slot[new]] = key[new], fits[new]
        return fits

    def _advance(self, chars: np.ndarray) -> list[bytes]:
        """Ids, as bytes of 32-bit numbers, of words of one length, one per row."""
        m, n = chars.shape
        top = min(self.longest, n)
        found_at: list[tuple[np.ndarray, ...]] = []  # row, start, size and rank of every piece in a word
        single = np.full((m, n), self.alone)
        h = np.zeros((m, n), np.uint64)
        for size in range(1, top + 1):
            h = h[:, : n - size + 1] * _BASE + chars[:, size - 1 :]
            if size not in self.tables:
                continue
            maybe, hashes, letters, ranks = self.tables[size]
            row, col = np.nonzero(maybe[h >> np.uint64(64 - FILTER_BITS)])
            found = np.minimum(np.searchsorted(hashes, h[row, col]), len(hashes) - 1)
            same = (hashes[found] == h[row, col]) & (letters[found] == chars[row[:, None], col[:, None] + np.arange(size)]).all(axis=1)
            row, col, rank = row[same], col[same], ranks[found[same]]
            if size == 1:
                single[row, col] = rank
            else:
                found_at.append((row, col, np.full(len(row), size), rank))
        found_at.append((np.repeat(np.arange(m), n), np.tile(np.arange(n), m), np.ones(m * n, np.int64), single.ravel()))
        row, start, size, rank = (np.concatenate(x) for x in zip(*found_at))
        order = np.argsort(start + size, kind="stable")
        row, start, size, rank = row[order], start[order], size[order], rank[order]
        ends_at = np.searchsorted((start + size), np.arange(1, n + 2))
        # What a prefix of each word ends with, per length of the prefix: a rank; -1 at the start, -2 if no path ends there.
        last, back = np.full((n + 1, m), -2), np.zeros((n + 1, m), np.int64)
        last[0] = -1
        for end in range(1, n + 1):
            here = slice(ends_at[end - 1], ends_at[end])
            r, k, new = row[here], size[here], rank[here]
            before = last[start[here], r]
            fits = before == -1
            inner = np.flatnonzero(before >= 0)
            fits[inner] = self._compatible(before[inner], new[inner])
            # One piece at most fits a prefix, so the maximum over sizes is that piece's size.
            last[end, r[fits]] = new[fits]
            np.maximum.at(back[end], r[fits], k[fits])
        # Follow the backpointers of all words at once; a word that is through stays at 0.
        ends, rows, steps, places = np.full(m, n), np.arange(m), [], []
        while ends.any():
            steps.append(last[ends, rows])
            ends = ends - back[ends, rows]
            places.append(ends)
        path, place = np.stack(steps[::-1], axis=1), np.stack(places[::-1], axis=1)
        used = path >= 0
        lengths = used.sum(axis=1)
        flat = self.ids[path[used]].tobytes()
        cuts = (np.cumsum(lengths) * 4).tolist()
        out = [flat[b - 4 * k : b] for b, k in zip(cuts, lengths.tolist())]
        for r in np.flatnonzero((path == self.alone).any(axis=1)).tolist():  # words with characters that are no piece
            wide = []
            for i, at in zip(path[r][used[r]].tolist(), place[r][used[r]].tolist()):
                wide += [int(self.ids[i])] if i != self.alone else self._spelled(chr(chars[r, at]))
            out[r] = np.array(wide, np.int32).tobytes()
        return out

    def _spelled(self, char: str) -> list[int]:
        raw = char.encode("utf-8", "surrogatepass")
        return [self.bytes_id[b] for b in raw] if all(b in self.bytes_id for b in raw) else [self.unknown]

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words."""
        out = {}
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, same in by_length.items():
            rows = max(1, CELLS // n)
            for lo in range(0, len(same), rows):
                part = same[lo : lo + rows]
                chars = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                out.update(zip(part, self._advance(chars)))
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none in a null or empty one."""
        split = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.known
        new = self.segment(list({w: 0 for words in split for w in words if w not in known}))
        known.update(new)
        out = [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in split]
        if len(known) > REMEMBERED:
            known.clear()
        else:
            for w in new:
                if len(w) > SHORT:
                    del known[w]
        return out


class Spelling:
    """What each id of a vocabulary file stands for: all that decoding needs."""

    def __init__(self, model: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model)
        size = m.get_piece_size()
        raw = [b""] * size
        for i in range(size):
            if m.is_byte(i):
                raw[i] = bytes([int(m.id_to_piece(i)[3:5], 16)])
            elif m.is_unknown(i):
                raw[i] = " ⁇ ".encode()
            elif not m.is_control(i):
                raw[i] = m.id_to_piece(i).replace(MARK, " ").encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_sizes = np.array([len(r) for r in raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of runs of ids; bytes that make no character come back as replacement characters."""
        sizes = self.raw_sizes[ids]
        first = np.cumsum(sizes) - sizes
        flat = self.raw[np.arange(int(sizes.sum())) - np.repeat(first - self.raw_starts[ids], sizes)].tobytes()
        ends = np.append(first, len(flat))[bounds]
        out = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            text = flat[a:b].decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)
        return out


@lru_cache(maxsize=2)
def pieces_of(model: str) -> Pieces:
    return Pieces(model)


@lru_cache(maxsize=2)
def spelling_of(model: str) -> Spelling:
    return Spelling(model)


def encode(docs: DataFrame, model: str, text: str = "text", keep: Sequence[str] = ("doc_id",), verify: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids``, equal to the library's; with ``verify`` also ``round_trip``.

    ``round_trip`` says whether decoding the ids gives the text back, in the task that
    encoded it, so that neither ids nor texts travel once more. ``model`` is a
    SentencePiece file at the same path on every executor. One row per input row; a
    null or empty text has no ids and comes back. ``keep`` must not hold these names.
    No shuffle.
    """
    schema = ddl(docs, keep) + "ids array<int>" + (", round_trip boolean" if verify else "")
    names = [*keep, "ids", *(["round_trip"] if verify else [])]

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                texts = part.column(len(keep)).to_pylist()
                ids = pieces_of(model).encode(texts)
                flat, bounds = np.concatenate(ids), np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                columns = [*part.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))]
                if verify:
                    again = spelling_of(model).decode(flat.astype(np.int64), bounds)
                    columns.append(pa.array([(t or "").replace(MARK, " ") == a for t, a in zip(texts, again)]))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(each, schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",), out: str = "text") -> DataFrame:
    """The columns ``keep`` and the text that ``ids`` stand for. Null or no ids give ''. No shuffle."""
    schema = ddl(encoded, keep) + f"`{out}` string"

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                lists = part.column(len(keep))
                sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = spelling_of(model).decode(flat, np.concatenate(([0], np.cumsum(sizes))))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, out])

    return encoded.select(*keep, F.col(ids).alias("_ids")).mapInArrow(each, schema)
