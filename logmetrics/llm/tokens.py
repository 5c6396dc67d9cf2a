"""Token counts with a whole-token shortcut.

A text falls into pre-tokens that no merge can join: a run of word marks (spaces)
with the other characters after it, and every line feed alone. That this holds is
proved from the vocabulary before it is used: no piece has a mark after another
character, and none has a line feed beside anything else. Token counts of
pre-tokens then add up.

Which vocabulary strings encode alone as one token is worked out once per process.
A pre-token among them counts one without any merge. The rest is merged, each
distinct one once per batch and, while a bounded table has room, once per process.
"""

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # fixed value: how the vocabulary writes a space
PRE_TOKEN = re.compile(rf"[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+|\n")
REMEMBERED = 300_000
SHORT = 40
TEXTS_AT_ONCE = 200


class Counts:
    """Token counts of one vocabulary file."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        self._prove(plain)
        self.known: dict[str, int] = {}
        alone = self.merge([p.replace(MARK, " ") for p in plain])
        self.whole = frozenset(p.replace(MARK, " ") for p, n in zip(plain, alone) if n == 1)

    def _prove(self, pieces: list[str]) -> None:
        for piece in pieces:
            if re.search(f"[^{MARK}]{MARK}", piece) or ("\n" in piece and piece != "\n"):
                raise ValueError(f"piece {piece!r} joins pre-tokens: counts would not add up")
        if [len(x) for x in self.model.encode(["a b\nc", "a", "b", "\nc", ""], num_threads=1)] != [4, 1, 1, 3, 0]:
            raise ValueError("the model does not mark the beginning of a text, or changes white space")

    def merge(self, pre_tokens: list[str]) -> list[int]:
        """Tokens of each pre-token, by the library's merges.

        The library puts a mark before a text. One that begins with a mark gives
        it up for that; any other follows a line feed, which costs two tokens.
        """
        texts = [p[1:] if p[:1] == " " and len(p) > 1 else "\n" + p for p in pre_tokens]
        return [
            len(ids) - (0 if t is not None and p[:1] == " " and len(p) > 1 else 2)
            for p, t, ids in zip(pre_tokens, texts, self.model.encode(texts, num_threads=1))
        ]

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; none in a null."""
        whole, known = self.whole, self.known
        tallies = [Counter(PRE_TOKEN.findall(" " + t.replace(MARK, " "))) if t else {} for t in texts]
        rest = list({p: 0 for tally in tallies for p in tally if p not in whole and p not in known})
        merged = dict(zip(rest, self.merge(rest))) if rest else {}
        counts = [
            sum(n if p in whole else n * (known[p] if p in known else merged[p]) for p, n in tally.items())
            for tally in tallies
        ]
        if len(known) > REMEMBERED:
            known.clear()
        known.update((p, n) for p, n in merged.items() if len(p) <= SHORT)
        return counts


@lru_cache(maxsize=2)
def counts_of(model: str) -> Counts:
    return Counts(model)


def count_tokens(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """Key, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    ``model`` is a SentencePiece file at the same path on every executor. One row
    per input row, repeated keys and null keys included; a null or empty text has
    0 bytes and 0 tokens. Other columns do not pass. No shuffle.
    """
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                n = counts_of(model).count(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64())], [key, "n_bytes", "n_tokens"])

    texts = docs.select(F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text))
    return texts.mapInArrow(each, schema).withColumn("over_limit", F.col("n_tokens") > limit)
