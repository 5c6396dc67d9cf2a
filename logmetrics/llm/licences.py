"""Licences by their sentences.

The sentences of all rule texts are normalised and numbered. A document is cut into
fragments at ends of sentences and lines; one fragment, or some that follow each
other (a wrapped sentence), make a known sentence if their words are equal to it, or
to a wording of it that leaves the holder's name open. What remains is the
document's sequence of sentence numbers. Rules are sequences too: from each place
the longest rule that follows there is a match, and matching goes on behind it.
Unknown words between its sentences count: up to ``LOOSE_WORDS`` in one place are
passed over (list numbers, page headings), up to ``FAR_WORDS`` make it a variant of
the licence (a clause was added or altered), beyond that it is none.

Two kinds of sentence have no fixed text: notices ("this file is licensed under the
..." and a known name) and ``SPDX-License-Identifier`` or ``License`` lines.
"""

import re
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from logmetrics.llm.licence_full_texts import FULL_TEXTS
from logmetrics.llm.licence_texts import NAMES, OPENINGS, RULES, SLOT, VARIANTS
from logmetrics.llm.text import ddl

TEXTS_AT_ONCE = 500
_END = re.compile(r"(?<!\b[A-Za-z])[.!?:;](?=\s|$)|\n")  # a single letter before a stop is short for something
_WORDS = re.compile(r"[a-z0-9]+")
LOOSE_WORDS, FAR_WORDS = 5, 200
SLOT_WORDS, NOTICE_PIECES = 24, 4

_NAME = "|".join(f"(?P<n{i}>{pattern})" for i, (_, pattern) in enumerate(NAMES))
_ANY_NAME = "(?:" + "|".join(pattern for _, pattern in NAMES) + ")"
_LISTED = rf"(?:the )?{_ANY_NAME}(?: licen[sc]es?)?"
_VERB = r"(?:dual )?(?:licen[sc]ed|released|distributed|published|available|made available|provided|covered)"
_NOTICE = re.compile(
    rf"(?:(?P<subject>(?:[a-z0-9]+ ){{1,12}}?)(?:is|are) (?:hereby |also |dual )?)?{_VERB} under (?:the )?(?:terms of )?(?:either )?(?:of )?"
    rf"(?P<names>{_LISTED}(?: (?:and|or|and or) {_LISTED})*)(?: at your option)?(?: (?:see|found|available at|as found|a copy|the text|http)(?: [a-z0-9]+){{0,24}})?"
)
_EACH = re.compile(rf"\b(?:{_NAME})(?= |$)")
_DENIED = frozenset("not no never if unless nothing neither none formerly previously".split())
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.I)
_FIELD = re.compile(r"^[^\w\n]*licen[sc]e\W{0,3}[:=][ \t]*([^\n]{2,80})$", re.I | re.M)
_GNU_ID = re.compile(r"(A?GPL|LGPL)-(\d\.\d)(-only|-or-later|\+)?", re.I)
_IDS = {name.lower(): name for name, _ in [*RULES, *OPENINGS, *NAMES]}


def fragments(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, does a sentence end here?) of the pieces between line feeds and sentence ends; empty ones left out."""
    out, at = [], 0
    for m in _END.finditer(text):
        if text[at : m.start()].strip():
            out.append((at, m.end() if m[0] != "\n" else m.start(), m[0] != "\n"))
        elif out and m[0] != "\n":
            out[-1] = (out[-1][0], out[-1][1], True)
        at = m.end()
    if text[at:].strip():
        out.append((at, len(text), True))
    return out


def words(text: str) -> tuple[str, ...]:
    return tuple("http" if w == "https" else w for w in _WORDS.findall(text.lower()))


def spdx_ids(expression: str) -> list[str]:
    """The licences of an SPDX expression, exceptions left out; GNU identifiers as in the rules."""
    out, words_ = [], re.findall(r"[A-Za-z0-9.+-]+", expression.rstrip(" \t-"))
    for k, word in enumerate(words_):
        if k and words_[k - 1].upper() not in ("AND", "OR", "WITH"):
            if word.upper() in ("AND", "OR", "WITH"):
                continue
            break  # what follows is not of the expression
        if word.upper() in ("AND", "OR", "WITH") or (k and words_[k - 1].upper() == "WITH"):
            continue
        if gnu := _GNU_ID.fullmatch(word):
            word = f"{gnu[1].upper()}-{gnu[2]}" + ("-or-later" if (gnu[3] or "").lower() in ("-or-later", "+") else "")
        word = _IDS.get(word.lower(), word)
        if word not in out and word.upper() not in ("NONE", "NOASSERTION"):
            out.append(word)
    return out


def noticed(sentence: str) -> list[str]:
    """The licences that a sentence of lower-case words says something is under."""
    m = _NOTICE.fullmatch(sentence)
    if not m or not _DENIED.isdisjoint((m["subject"] or "").split()):
        return []
    return list(dict.fromkeys(NAMES[int(e.lastgroup[1:])][0] for e in _EACH.finditer(m["names"])))


class Rules:
    """Sentences by their words, and rules by their sentence numbers. One that says nothing ("2.1.", "and") only labels what follows."""

    def __init__(self, texts: Sequence[tuple[str, str]], variants: Sequence[tuple[str, Sequence[str]]] = (), named: bool = False):
        self.sentences: dict[tuple[str, ...], int] = {}
        self.rules: list[tuple[str, tuple[int, ...]]] = []
        self.named = named
        for licence, text in texts:
            found = [w for a, b, _ in fragments(text) if (w := words(text[a:b]))]
            found = [w for w in found if len(w) > 1 and len(max(w, key=len)) > 3] or found
            if found:
                self.rules.append((licence, tuple(self.sentences.setdefault(w, len(self.sentences)) for w in found)))
        self.size = len(self.sentences)
        self.rules.sort(key=lambda r: -len(r[1]))  # stable: of equal length the first given
        self.by_first: dict[int, list[tuple[str, tuple[int, ...]]]] = {}
        for rule in self.rules:
            self.by_first.setdefault(rule[1][0], []).append(rule)
        self.slots: list[tuple[tuple[str, ...], tuple[str, ...], int]] = []
        for text, others in variants:
            if (number := self.sentences.get(words(text))) is not None:
                for other in others:
                    before, slot, after = other.partition(SLOT)
                    if slot:
                        self.slots.append((words(before), words(after), number))
                    else:
                        self.sentences.setdefault(words(other), number)
        self.beginnings = {w[:k] for w in self.sentences for k in range(1, len(w) + 1)}
        self.slot_first = {before[0] for before, _, _ in self.slots}
        # A text without any of these words has no known sentence; of a sentence with a slot a word outside it.
        self.hints = {max(w, key=len) for w in self.sentences} | {max(a + b, key=len) for a, b, _ in self.slots}

    def recognise(self, text: str) -> list[tuple[int | str, int, int]]:
        """(sentence number, start, end) of the known sentences of a text, in order, none inside another; for a notice its licence is the number."""
        low = text.lower()
        notices = self.named and ("licen" in low or " under" in low)
        if not notices and self.hints.isdisjoint(words(low)):
            return []
        pieces = fragments(text)
        held = [words(text[a:b]) for a, b, _ in pieces]
        out: list[tuple[int | str, int, int]] = []
        i = 0
        while i < len(pieces):
            best = self._sentence(pieces, held, i)
            if best is None and held[i] and held[i][0] in self.slot_first:
                best = self._with_slot(held, i)
            many = [best[0]] if best else []
            if notices and not best and (got := self._notice(text, pieces, held, i)):
                many, best = got[0], (None, got[1])
            if best:
                out += [(k, self._trimmed(text, pieces[i][0]), pieces[best[1]][1]) for k in many]
                i = best[1] + 1
            else:
                i += 1
        if notices:
            out = self._lines(text, out)
        return out

    def _sentence(self, pieces, held, i: int) -> tuple[int, int] | None:
        """Number and last fragment of the longest sentence of fixed words from a fragment on."""
        so_far: tuple[str, ...] = ()
        best = None
        for j in range(i, len(pieces)):
            so_far += held[j]
            if so_far not in self.beginnings:
                break
            if so_far in self.sentences:
                best = (self.sentences[so_far], j)
            if pieces[j][2]:
                break
        return best

    def _with_slot(self, held, i: int) -> tuple[int, int] | None:
        """The same for sentences with a slot. A name may hold a full stop, so ends of fragments do not count inside."""
        for before, after, number in self.slots:
            so_far: tuple[str, ...] = ()
            for j in range(i, len(held)):
                so_far += held[j]
                extra = len(so_far) - len(before) - len(after)
                if extra > SLOT_WORDS or so_far[: len(before)] != before[: len(so_far)]:
                    break
                if extra >= 1 and so_far[len(so_far) - len(after) :] == after:
                    return number, j
        return None

    @staticmethod
    def _notice(text: str, pieces, held, i: int) -> tuple[list[str], int] | None:
        """Licences and last fragment of a notice from a fragment on, not beyond an empty line."""
        so_far: tuple[str, ...] = ()
        best = None
        for j in range(i, min(i + NOTICE_PIECES, len(pieces))):
            so_far += held[j]
            if len(so_far) > 60 or (j > i and re.match(r"[^\S\n]*\n[^\S\n]*\n", text[pieces[j - 1][1] : pieces[j][1]])):
                break
            if "under" in so_far and (got := noticed(" ".join(so_far))):
                best = got, j
            if pieces[j][2]:
                break
        return best

    @staticmethod
    def _lines(text: str, known: list) -> list:
        """With the licences of SPDX and License lines, but for those inside a sentence already known."""
        found = [(m.start(), m.end(), spdx_ids(m[1])) for m in _SPDX.finditer(text)]
        for m in _FIELD.finditer(text):
            line = " ".join(words(m[1]))
            if re.fullmatch(rf"{_LISTED}(?: (?:and|or) {_LISTED})*", line):
                found.append((m.start() + len(m[0]) - len(m[0].lstrip()), m.end(), [NAMES[int(e.lastgroup[1:])][0] for e in _EACH.finditer(line)]))
        more = [(k, a, b) for a, b, ids in found for k in ids if not any(x < b and a < y for _, x, y in known)]
        return sorted([*known, *more], key=lambda x: x[1])

    @staticmethod
    def _trimmed(text: str, at: int) -> int:
        while at < len(text) and text[at].isspace():
            at += 1
        return at

    def match(self, text: str) -> tuple[list[tuple[str, int, int]], int]:
        """(licence, start, end) of the matches, in order, and the number of known sentences."""
        known = self.recognise(text)
        ids = [k[0] for k in known]
        out, i = [], 0
        while i < len(ids):
            if isinstance(ids[i], str):
                out.append(known[i])
                i += 1
                continue
            for licence, rule in self.by_first.get(ids[i], ()):
                if tuple(ids[i : i + len(rule)]) == rule:
                    gap = max((len(words(text[known[k][2] : known[k + 1][1]])) for k in range(i, i + len(rule) - 1)), default=0)
                    if gap <= FAR_WORDS:
                        out.append((licence if gap <= LOOSE_WORDS else f"{licence} variant", known[i][1], known[i + len(rule) - 1][2]))
                        i += len(rule)
                        break
            else:
                i += 1
        return out, len({k[1:] for k in known})


def full_rules() -> list[tuple[str, str]]:
    """Each full text from each of its places to each later one, so that a copy without title or appendix is one match.

    The appendix of the AGPL is that of the GPL with its name; without it the notice quoted there would count as one.
    """
    out = []
    for licence, parts in FULL_TEXTS:
        out += [(licence, "\n".join(parts[a:b])) for a in range(len(parts)) for b in range(a + 1, len(parts) + 1)]
        if licence == "GPL-3.0":
            end = parts[-1].index("later version.") + len("later version.")
            out.append(("AGPL-3.0", parts[-1][:end].replace("GNU General", "GNU Affero General")))
    return [*out, *OPENINGS]


@lru_cache(maxsize=1)
def default_rules() -> Rules:
    return Rules([*RULES, *full_rules()], VARIANTS, named=True)


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The columns ``keep``, ``licences`` (distinct, sorted), ``matches`` (licence and character offsets, in order)
    and ``n_sentences`` (known ones) per row.

    One row per input row, repeated and null keys included. A null or empty text has
    none. Every match counts, however often it is repeated; one with unknown text between
    its sentences is called ``<licence> variant``. ``keep`` must not hold
    these names; other columns do not pass, whatever their names. No shuffle.
    """
    schema = ddl(docs, keep) + "licences array<string>, matches array<struct<licence:string,start:bigint,end:bigint>>, n_sentences bigint"
    kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    given = tuple(rules) if rules is not None else None

    def each(batches):
        ready = Rules(given) if given is not None else default_rules()
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                found = [ready.match(t) if t else ([], 0) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(keep)],
                        pa.array([sorted({m[0] for m in x}) for x, _ in found], pa.list_(pa.string())),
                        pa.array([[{"licence": a, "start": b, "end": c} for a, b, c in x] for x, _ in found], kind),
                        pa.array([n for _, n in found], pa.int64()),
                    ],
                    [*keep, "licences", "matches", "n_sentences"],
                )

    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(each, schema)
