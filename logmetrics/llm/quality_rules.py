"""Quality rules: counts of a text, and its lines judged as a sequence.

The base counts reject texts of few words or of much repetition. For the rest a
linear-chain conditional random field reads the lines with a word in order and
marks each as content or boilerplate (Viterbi decoding); the share of word
characters in content lines decides whether the text is kept.

Line features are indicators, free of language: how many words and of what length,
symbols, capitals, exclamation marks, digits, repetition inside the text, place in
the text. The field is trained on labelled texts, whose label holds for each of
their lines: a mixed text teaches a little wrong, the many others right. Texts of
one label alone would teach that lines never differ from their neighbours, so half
of the rarer label's texts, and as many of the other's, are cut into short runs of
lines and joined by turns; the steps between states are learnt from both kinds.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession

from logmetrics.llm.labelled import sample
from logmetrics.llm.text import IS_WORD, ddl, map_runs, per_text, shingle_hashes, span_hashes, verdicts, word_bounds

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per hundred words
SHARE = 0.5
SAMPLE_ROWS = 4_000
ROUNDS = 120
# Of a sampled text the driver gets at most so many runs of so many lines, evenly spread over the whole text.
RUNS, RUN_LINES = 8, 32
MIXED_RUN = 8  # lines at most of one label in a row, where texts are mixed to learn the steps
MIXED_RUNS = 6  # runs at most in such a mixture

# Characters that count as symbols.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _LETTER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_DIGIT[ord("0") : ord("9") + 1] = True

# Upper ends of the classes each measure of a line falls into.
CLASSES = {
    "words": (1, 3, 7, 15, 39),
    "chars_per_word": (3, 6, 10),
    "symbols_per_char": (0, 0.02, 0.08, 0.2),
    "symbols_per_word": (0, 0.1, 0.3, 0.6),
    "capitals_per_letter": (0.15, 0.4, 0.8),
    "exclamations_per_word": (0, 0.2, 0.6),
    "digits_per_char": (0, 0.1, 0.4),
    "repeated_per_word": (0, 0.3, 0.7),
    "doubled_per_word": (0.05, 0.3),
    "seen_before": (0,),
    "place": (0, 1),  # only or first, inner, last
}
WIDTH = sum(len(c) + 1 for c in CLASSES.values())


@dataclass
class Lines:
    """Lines with a word: the text they belong to, the active feature of each kind, their word characters."""

    owner: np.ndarray
    active: np.ndarray
    chars: np.ndarray


def _sums(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[ends] - total[starts]


def _repeated_words(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Is each word in a window that its text holds twice or more?"""
    inside = np.zeros(len(words) + 1, np.int64)
    windows = shingle_hashes(words, WINDOW)
    at = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    if len(at):
        keys = (owner[at].astype(np.uint64) << np.uint64(54)) | (windows[at] >> np.uint64(10))
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            found = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            hit = at[twice[found] == keys]
            np.add.at(inside, hit, 1)
            np.add.at(inside, hit + WINDOW, -1)
    return np.cumsum(inside)[:-1] > 0


def measure(data: np.ndarray, bounds: np.ndarray) -> tuple[dict[str, np.ndarray], Lines]:
    """Base counts of each text of a run (at most 1,024 texts), and its lines with their features."""
    n = len(bounds) - 1
    starts, ends, owner = word_bounds(data, bounds)
    words = span_hashes(data, starts, ends)
    repeated = _repeated_words(words, owner)
    doubled = np.zeros(len(words), np.int64)
    doubled[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    in_word = IS_WORD[data] & ((data & 0xC0) != 0x80)
    symbol = _SYMBOLS[data]

    feeds = np.flatnonzero(data == 0x0A)
    heads = np.unique(np.concatenate((bounds[:-1][bounds[:-1] < bounds[1:]], feeds + 1)))
    heads = heads[heads < len(data)]
    line_of = np.searchsorted(bounds, heads, side="right") - 1
    tails = np.minimum(np.append(heads[1:], len(data)), bounds[line_of + 1])
    tails = tails - ((tails > heads) & (data[np.maximum(tails - 1, 0)] == 0x0A))
    word_line = np.searchsorted(heads, starts, side="right") - 1
    n_words = np.bincount(word_line, minlength=len(heads))
    full = n_words > 0
    heads, tails, line_of, n_words = heads[full], tails[full], line_of[full], n_words[full]

    content = span_hashes(data, heads, tails)
    order = np.lexsort((np.arange(len(heads)), content, line_of))
    again = np.zeros(len(heads), bool)
    if len(order):
        same = (content[order][1:] == content[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
        again[order[1:][same]] = True

    counts = {
        "n_words": per_text(owner, n),
        "word_chars": _sums(in_word, bounds[:-1], bounds[1:]),
        "n_symbols": _sums(symbol, bounds[:-1], bounds[1:]),
        "n_dup_lines": per_text(line_of[again], n),
        "n_repeat_words": per_text(owner[repeated], n),
        "n_doubled": per_text(owner[doubled == 1], n),
    }
    chars = _sums(in_word, heads, tails)
    last_word = np.cumsum(n_words) - 1  # words come line by line
    repeats = np.add.reduceat(repeated.astype(np.int64), last_word - n_words + 1) if len(n_words) else n_words
    letters = np.maximum(_sums(_LETTER[data], heads, tails), 1)
    first = np.concatenate(([True], line_of[1:] != line_of[:-1])) if len(line_of) else np.zeros(0, bool)
    last = np.concatenate((line_of[1:] != line_of[:-1], [True])) if len(line_of) else np.zeros(0, bool)
    values = {
        "words": n_words,
        "chars_per_word": chars / n_words,
        "symbols_per_char": _sums(symbol, heads, tails) / chars,
        "symbols_per_word": _sums(symbol, heads, tails) / n_words,
        "capitals_per_letter": _sums(_UPPER[data], heads, tails) / letters,
        "exclamations_per_word": _sums(data == ord("!"), heads, tails) / n_words,
        "digits_per_char": _sums(_DIGIT[data], heads, tails) / chars,
        "repeated_per_word": repeats / n_words,
        "doubled_per_word": np.add.reduceat(doubled, last_word - n_words + 1) / n_words if len(n_words) else n_words,
        "seen_before": again,
        "place": np.where(first, 0, np.where(last, 2, 1)),
    }
    active, base = np.zeros((len(heads), len(CLASSES)), np.int64), 0
    for j, (name, edges) in enumerate(CLASSES.items()):
        active[:, j] = base + np.searchsorted(np.array(edges, float), np.asarray(values[name], float), side="left")
        base += len(edges) + 1
    return counts, Lines(line_of, active, chars)


@dataclass
class Field:
    """Weight of content over boilerplate per feature, of each step between states, and of content at the start."""

    weights: np.ndarray
    steps: np.ndarray  # [from, to], states 0 boilerplate, 1 content
    start: float

    def scores(self, lines: Lines) -> np.ndarray:
        return self.weights[lines.active].sum(axis=1)


def _columns(owner: np.ndarray) -> list[np.ndarray]:
    """The first line of every text, then the second of those that have one, and so on; texts keep their order, longest first."""
    if not len(owner):
        return []
    heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    sizes = np.diff(np.append(heads, len(owner)))
    by_size = np.argsort(-sizes, kind="stable")
    heads, sizes = heads[by_size], sizes[by_size]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    return [heads[:m] + t for t, m in enumerate(alive)]


def decode(field: Field, lines: Lines) -> np.ndarray:
    """The likeliest states of all lines, text by text."""
    gain, states = field.scores(lines), np.zeros(len(lines.owner), np.int64)
    columns = _columns(lines.owner)
    back: list[np.ndarray] = []
    best = None
    for t, at in enumerate(columns):
        if t == 0:
            best = np.stack([np.zeros(len(at)), gain[at] + field.start])
            back.append(np.zeros((2, len(at)), np.int64))
            full = best
            continue
        ways = best[:, None, : len(at)] + field.steps[:, :, None]
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0)
        best[1] += gain[at]
        full = np.concatenate([best, full[:, len(at) :]], axis=1)
    if columns:
        state = full.argmax(axis=0)  # each text's last state
        for t in range(len(columns) - 1, -1, -1):
            m = len(columns[t])
            states[columns[t]] = state[:m]
            state[:m] = back[t][state[:m], np.arange(m)]
    return states


def _expected(field: Field, gain: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content per line, and expected steps, by forward and backward sums."""
    alphas = []
    for t, at in enumerate(columns):
        if t == 0:
            alpha = np.stack([np.zeros(len(at)), gain[at] + field.start])
        else:
            alpha = np.logaddexp.reduce(alphas[-1][:, None, : len(at)] + field.steps[:, :, None], axis=0)
            alpha[1] += gain[at]
        alphas.append(alpha)
    content, steps = np.zeros(len(gain)), np.zeros((2, 2))
    beta = None
    for t in range(len(columns) - 1, -1, -1):
        at, alpha = columns[t], alphas[t]
        here = np.zeros((2, len(at)))
        if beta is not None:
            m = beta.shape[1]
            nxt = beta.copy()
            nxt[1] += gain[columns[t + 1]]
            ways = field.steps[:, :, None] + nxt[None, :, :]
            here[:, :m] = np.logaddexp.reduce(ways, axis=1)
            both = alpha[:, None, :m] + ways
            steps += np.exp(both - np.logaddexp.reduce(both.reshape(4, m), axis=0)).sum(axis=2)
        total = alpha + here
        content[at] = np.exp(total[1] - np.logaddexp(total[0], total[1]))
        beta = here
    return content, steps


def train(lines: Lines, labels: np.ndarray, penalty: float = 2.0, rounds: int = ROUNDS) -> Field:
    """The field of the greatest penalised likelihood, by resilient gradient steps. ``labels`` has a state per line."""
    n, columns = len(labels), _columns(lines.owner)
    field = Field(np.zeros(WIDTH), np.zeros((2, 2)), 0.0)
    if not n or labels.min() == labels.max():
        return field
    joined = lines.owner[1:] == lines.owner[:-1]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (labels[:-1][joined], labels[1:][joined]), 1)
    seen = np.bincount(lines.active.ravel(), weights=np.repeat(labels, lines.active.shape[1]), minlength=WIDTH)
    theta, size, before = np.zeros(WIDTH + 5), np.full(WIDTH + 5, 0.1), np.zeros(WIDTH + 5)
    for _ in range(rounds):
        field = Field(theta[:WIDTH], theta[WIDTH : WIDTH + 4].reshape(2, 2), float(theta[-1]))
        content, steps = _expected(field, field.scores(lines), columns)
        met = np.bincount(lines.active.ravel(), weights=np.repeat(content, lines.active.shape[1]), minlength=WIDTH)
        slope = np.concatenate([seen - met, (seen_steps - steps).ravel(), [(labels[columns[0]] - content[columns[0]]).sum()]]) - penalty * theta
        turn = np.sign(slope) * np.sign(before)
        size = np.clip(np.where(turn > 0, size * 1.2, np.where(turn < 0, size * 0.5, size)), 1e-5, 1.0)
        slope = np.where(turn < 0, 0, slope)
        theta, before = theta + np.sign(slope) * size, slope
    return Field(theta[:WIDTH], theta[WIDTH : WIDTH + 4].reshape(2, 2), float(theta[-1]))


def _spread(active: np.ndarray) -> np.ndarray:
    """All lines of a text of up to ``RUNS`` runs; of a longer one so many runs, evenly spread from its first to its last."""
    runs = -(-len(active) // RUN_LINES)
    if runs <= RUNS:
        return active
    picked = np.linspace(0, runs - 1, RUNS).astype(int)
    return np.concatenate([active[r * RUN_LINES : (r + 1) * RUN_LINES] for r in picked])


def mixtures(texts: list[np.ndarray], labels: np.ndarray) -> tuple[Lines, np.ndarray]:
    """Sequences to train on, and the state of each of their lines.

    Half of the rarer label's texts and as many of the other's are cut into runs of 1
    to ``MIXED_RUN`` lines, and 2 to ``MIXED_RUNS`` runs at a time, the labels by turns,
    make a sequence; the other texts stay whole. Each line's place is that in its
    sequence. The same texts give the same sequences, whatever their order.
    """
    rng = np.random.RandomState(0)
    order = sorted((i for i in range(len(texts)) if len(texts[i])), key=lambda i: texts[i].tobytes())
    sides = [rng.permutation([i for i in order if labels[i] == y]).astype(int) for y in (0, 1)]
    cut = min(len(sides[0]), len(sides[1])) // 2
    runs: list[list[np.ndarray]] = [[], []]
    for y in (0, 1):
        for i in sides[y][:cut]:
            ends = np.cumsum(rng.randint(1, MIXED_RUN + 1, len(texts[i])))
            runs[y] += np.split(texts[i], ends[ends < len(texts[i])])
        runs[y] = [runs[y][j] for j in rng.permutation(len(runs[y]))]
    sequences = [[(y, texts[i])] for y in (0, 1) for i in sides[y][cut:]]
    while runs[0] and runs[1]:
        mixture, y = [], int(rng.randint(2))
        for _ in range(rng.randint(2, MIXED_RUNS + 1)):
            if runs[y]:
                mixture.append((y, runs[y].pop()))
            y = 1 - y
        sequences.append(mixture)
    sequences += [[(y, run)] for y in (0, 1) for run in runs[y]]
    if not sequences:
        return Lines(np.zeros(0, np.int64), np.zeros((0, len(CLASSES)), np.int64), np.zeros(0)), np.zeros(0, np.int64)
    sizes = [sum(len(run) for _, run in s) for s in sequences]
    owner = np.repeat(np.arange(len(sequences)), sizes)
    active = np.concatenate([run for s in sequences for _, run in s]).astype(np.int64)
    states = np.concatenate([np.full(len(run), y) for s in sequences for y, run in s])
    ends = np.cumsum(sizes)
    place = np.ones(len(owner), np.int64)
    place[ends - 1] = 2
    place[ends - sizes] = 0
    active[:, -1] = WIDTH - 3 + place
    return Lines(owner, active, np.ones(len(owner))), states


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Field:
    """A field trained on about ``rows`` labelled texts.

    To the driver comes one row of small numbers per line of these, of at most
    ``RUNS`` x ``RUN_LINES`` lines of a text. Without labelled rows, or with rows of
    one label only, every line is content.
    """
    k = len(CLASSES)

    def work(batch, data, bounds):
        _, lines = measure(data, bounds)
        cut = np.searchsorted(lines.owner, np.arange(1, batch.num_rows))
        return {"label": batch.column(0), "active": [_spread(x).ravel() for x in np.split(lines.active.astype(np.int16), cut)]}

    got = map_runs(sample(docs, labels, key, text, label, rows), "text", ["label", "text"], "label int, active array<short>", work).toPandas()
    lines, states = mixtures([np.asarray(x, np.int16).reshape(-1, k) for x in got.active], got.label.to_numpy(np.int64))
    field = train(lines, states)
    return field if field.weights.any() else Field(np.zeros(WIDTH), np.zeros((2, 2)), 1.0)


def _decided(field: Field, data: np.ndarray, bounds: np.ndarray) -> tuple[dict[str, np.ndarray], Lines, np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, lines, which lines are content, which texts fail the base, and the share of content."""
    n = len(bounds) - 1
    counts, lines = measure(data, bounds)
    states = decode(field, lines) == 1
    content, total = per_text(lines.owner[states], n, lines.chars[states]), per_text(lines.owner, n, lines.chars)
    failed = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])
    return counts, lines, states, failed, content / np.maximum(total, 1)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, field: Field, text: str = "text", keep: Sequence[str] = ("doc_id",), share: float = SHARE) -> DataFrame:
    """Per row: the columns ``keep``, the base counts, ``base_failed``, ``kept``, ``n_lines``, ``n_content_lines``, ``content_share``.

    One row per input row, repeated and null keys included. A null or empty text,
    or one of white space alone, has no words: it fails the base and has content
    share 0. Of equally likely markings of a line boilerplate wins. ``keep`` must not
    hold a name of these; other columns do not pass, whatever their names. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def work(batch, data, bounds):
        n = batch.num_rows
        counts, lines, states, failed, part = _decided(shared.value, data, bounds)
        return {
            **{c: batch.column(i) for i, c in enumerate(keep)}, **{c: counts[c] for c in COUNTS}, "base_failed": failed, "kept": ~failed & (part >= share),
            "n_lines": per_text(lines.owner, n), "n_content_lines": per_text(lines.owner[states], n), "content_share": part,
        }

    schema = (
        ddl(docs, keep) + ", ".join(f"{c} bigint" for c in COUNTS)
        + ", base_failed boolean, kept boolean, n_lines bigint, n_content_lines bigint, content_share double"
    )
    return map_runs(docs, text, list(keep), schema, work)


def keeper(spark: SparkSession, field: Field, share: float = SHARE) -> Callable[[Column], Column]:
    """``kept`` as a function of a column of texts, for rows whose other columns need not go through Python."""
    shared = spark.sparkContext.broadcast(field)

    def work(data, bounds):
        _, _, _, failed, part = _decided(shared.value, data, bounds)
        return ~failed & (part >= share)

    return verdicts("boolean", work)
