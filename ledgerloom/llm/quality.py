"""Quality rules: statistics of whole texts, and boosted trees over them.

Trees are grown on binned features by gradient boosting of the logistic loss.
Features with a constraint may only lower the score as they rise: a split whose
leaves would break that is not taken, and both sides of a split stay on their
side of its middle. All trees have the same depth and lie flat in numpy arrays,
so scoring a batch is a few array look-ups for each level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import covered, map_rows, text_bytes, window_hashes, word_hashes

#: Labelled rows that a model is fitted on, at most; those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
#: Score from which a document is kept.
LEAST_SCORE = 0.5
#: A text with fewer words fails, and one with a larger share of repeated words, in hundredths.
LEAST_WORDS = 20
MOST_REPEATED = 30
REPEAT_WINDOW = 8
_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_MARKS = b"!?"
_DIGITS = b"0123456789"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features, and whether they may only lower the score (-1) or go either way (0).
FEATURES = {
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "mark_share": -1,
    "digit_share": 0,
    "word_length": 0,
}


def _held(text: bytes, kinds: bytes) -> int:
    return len(text) - len(text.translate(None, kinds))


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the values of ``FEATURES`` for one whole text; null counts as empty."""
    text = text or b""
    words = text.split()
    n_words = len(words)
    chars = len(text.translate(None, _SPACE + _CONTINUED))
    symbols = _held(text, _SYMBOLS)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeated_lines = len(lines) - len(set(lines))
    windows = window_hashes(word_hashes(words), REPEAT_WINDOW)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1) if len(windows) else np.empty(0, np.int64)
    repeated_words = int(covered(starts, REPEAT_WINDOW, n_words).sum())
    per_char, per_word = max(1, chars), max(1, n_words)
    return [n_words, chars, symbols, repeated_lines, repeated_words], [
        symbols / per_char,
        repeated_lines / max(1, len(lines)),
        repeated_words / per_word,
        _held(text, _UPPER) / max(1, _held(text, _LETTERS)),
        _held(text, _MARKS) / per_char,
        _held(text, _DIGITS) / per_char,
        chars / per_word,
    ]


@dataclass
class Trees:
    """Boosted trees of one depth as flat arrays, a row for each tree.

    Node ``i`` sends values above its threshold to ``2 * i + 2``, others to
    ``2 * i + 1``; leaves follow the nodes. A node that does not split has an
    infinite threshold.
    """

    base: float
    depth: int
    feature: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of the positive class for each row."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[every, feature[at]] > threshold[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-total))


def _best_split(
    bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, signs: np.ndarray, low: float, high: float, size: int,
    ridge: float, least_gain: float, least_weight: float,
) -> tuple[float, int, int, float, float] | None:
    """Gain, feature, last bin of the left side, and values of both sides, of the best allowed split."""
    best = None
    whole = grad.sum() ** 2 / (hess.sum() + ridge)
    for feature, sign in enumerate(signs):
        g = np.cumsum(np.bincount(bins[:, feature], grad, size))
        h = np.cumsum(np.bincount(bins[:, feature], hess, size))
        left_h, right_h = h[:-1], h[-1] - h[:-1]
        left, right = -g[:-1] / (left_h + ridge), -(g[-1] - g[:-1]) / (right_h + ridge)
        left, right = np.clip(left, low, high), np.clip(right, low, high)
        gain = g[:-1] ** 2 / (left_h + ridge) + (g[-1] - g[:-1]) ** 2 / (right_h + ridge) - whole
        allowed = (left_h >= least_weight) & (right_h >= least_weight) & (sign * (right - left) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > max(least_gain, best[0] if best else 0):
            best = (float(gain[at]), feature, at, float(left[at]), float(right[at]))
    return best


def grow(
    rows: np.ndarray, labels: np.ndarray, signs: list[int], trees: int = 40, depth: int = 3, rate: float = 0.3,
    size: int = 64, ridge: float = 1.0, least_gain: float = 2.0, least_weight: float = 2.0,
) -> Trees:
    """Boosted trees for 0/1 ``labels``; ``signs`` are the constraints of the features.

    Without rows, or with one class alone, there is no tree: the score is the
    share of the positive class, and 1 without rows.
    """
    share = labels.mean() if len(labels) else 1.0
    base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if not 0 < share < 1:
        return Trees(base, depth)
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, size)[:-1])) for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(cut, rows[:, f], side="left") for f, cut in enumerate(cuts)], 1)
    nodes = 2**depth - 1
    total = np.full(len(rows), base)
    found = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - labels, p * (1 - p)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        values, bounds = np.zeros(2 * nodes + 1), np.tile([-np.inf, np.inf], (2 * nodes + 1, 1))
        at = np.zeros(len(rows), np.int64)
        values[0] = -grad.sum() / (hess.sum() + ridge)
        for node in range(nodes):
            own = at == node
            low, high = bounds[node]
            split = _best_split(
                bins[own], grad[own], hess[own], np.array(signs), low, high, size + 1, ridge, least_gain, least_weight
            ) if own.any() else None
            below = [2 * node + 1, 2 * node + 2]
            bounds[below] = bounds[node]
            values[below] = values[node]
            if split:
                _, chosen, last, left, right = split
                feature[node], threshold[node] = chosen, cuts[chosen][min(last, len(cuts[chosen]) - 1)]
                values[below] = left, right
                middle = (left + right) / 2
                if signs[chosen]:
                    lower, upper = (below[1], below[0]) if signs[chosen] < 0 else (below[0], below[1])
                    bounds[lower, 1], bounds[upper, 0] = min(high, middle), max(low, middle)
                at[own] = np.where(rows[own, chosen] > threshold[node], below[1], below[0])
            else:
                at[own] = below[0]
        leaf = rate * values[nodes:]
        total += leaf[at - nodes]
        for kept, new in zip(found, (feature, threshold, leaf), strict=True):
            kept.append(new)
    return Trees(base, depth, *map(np.stack, found))


def labelled_sample(labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``most`` rows ``doc_id, quality``, those with the smallest hash of the id."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).dropna()
    count = known.count()
    draw = F.xxhash64("doc_id")
    # Only about twice as many as are taken are sorted.
    some = known.where(F.pmod(draw, F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, 2 * most / max(1, count)))))
    return some.orderBy(F.pmod(draw, F.lit(1 << 30)), "doc_id", "quality").limit(most)


def fit(documents: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on a bounded sample of the labelled documents, ``most`` rows however often an id is repeated."""
    names = list(FEATURES)

    def rows(batch: dict[str, list]):
        found = np.array([statistics(text)[1] for text in batch["text"]]).reshape(-1, len(names))
        yield {"quality": batch["quality"], "draw": batch["draw"]} | {name: found[:, place] for place, name in enumerate(names)}

    texts = documents.select("doc_id", text_bytes().alias("text"), F.xxhash64("doc_id", "text").alias("draw"))
    joined = texts.join(F.broadcast(labelled_sample(labels, most)), "doc_id").select("text", "quality", "draw")
    schema = "quality double, draw bigint, " + ", ".join(f"{name} double" for name in names)
    # Rows, not ids, are counted, as a label meets every row of its id.
    table = map_rows(joined, rows, schema).orderBy("draw", "quality", *names).limit(most).drop("draw").toPandas()
    table = table.sort_values(["quality", *names])
    return grow(table[names].to_numpy(float), table["quality"].to_numpy(float), list(FEATURES.values()))


def judge(documents: DataFrame, trees: Trees, least_score: float = LEAST_SCORE) -> DataFrame:
    """``doc_id``, the counts of ``COUNTS``, ``base_failed``, ``score`` and ``kept`` of every document.

    A document fails with fewer than ``LEAST_WORDS`` words, or if more than
    ``MOST_REPEATED`` hundredths of its words are in a window of
    ``REPEAT_WINDOW`` words that it has twice; then it is not kept. A null or
    empty text has all counts 0 and fails. Repeated rows have the same answer;
    an empty table gives no row; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def rows(batch: dict[str, list]):
        found = [statistics(text) for text in batch["text"]]
        counts = np.array([own for own, _ in found], np.int64).reshape(-1, len(COUNTS))
        score = shared.value.score(np.array([own for _, own in found]).reshape(-1, len(FEATURES)))
        failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
        yield {"doc_id": batch["doc_id"]} | {name: counts[:, place] for place, name in enumerate(COUNTS)} | {
            "base_failed": failed,
            "score": score,
            "kept": ~failed & (score >= least_score),
        }

    frame = documents.select("doc_id", text_bytes().alias("text"))
    numbers = ", ".join(f"{name} bigint" for name in COUNTS)
    return map_rows(frame, rows, f"doc_id bigint, {numbers}, base_failed boolean, score double, kept boolean")


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` by trees fitted on ``labels`` (``doc_id``, ``quality``).

    Labels that are null, or of no document, do not count; without any, or with
    one class alone, the base rules and the share of that class decide.
    """
    return judge(documents, fit(documents, labels))
