"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text knows every string that
occurs in it. A text is parsed against it from left to right into phrases, each
the longest string that goes on matching, and a character that occurs nowhere
is a phrase by itself. A language in which the text falls into few phrases is
close to it: with ``c`` phrases in ``m`` characters and ``n`` characters of
labelled text the cross entropy is about ``c * log2(n) / m``, and the least wins.

The automata are one array from (state, character) to the next state, with a
bit that says whether a phrase ended, in which each state has room for the
characters it knows alone. Segments of texts, one for each language, step
through it side by side, and what a phrase has matched is carried over from one
to the next.
"""

from __future__ import annotations

import math
import re
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import BYTES_AT_ONCE, map_rows, shielded

#: Characters of labelled text that a language's automaton is built over, at most.
SAMPLE_CHARS = 30_000
#: Documents of a language among which they are found, by order of a hash of the id.
SAMPLE_DOCUMENTS = 100
FOLDS = 5
UNDETERMINED = "und"
#: Characters of a text that are parsed in one go; phrases go on from one segment to the next.
SEGMENT = 4096
#: Slots tried for a row, beyond which the search for later ones begins where it found room.
SLOT_TRIES = 8
#: Characters that are stepped through side by side.
BLOCK = 4_000_000
#: Mean characters of a phrase in the best language below which a text is in none of them, if that language was
#: learned from ``SAMPLE_CHARS`` characters. With fewer it is less by their logarithm: a phrase is as long as
#: what is learned lets it be, and the bound on the cross entropy that follows is the same for all.
LEAST_PHRASE = 2.0
#: Whatever was learned, a text with shorter phrases is in none: nearly every character is a phrase by itself.
SHORTEST_PHRASE = 1.1
#: Names of columns that are added.
_TEXT, _PRED, _SCORE, _LETTERS, _PHRASE = (f"_language_{n}" for n in ("text", "pred", "score", "letters", "phrase"))
_OTHER = re.compile(r"[\W\d_]+")


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """``crc32(doc_id as text) mod folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def letters_only(text: str) -> str:
    """Lower case, with one space for each run of what is no letter; empty without a letter."""
    found = _OTHER.sub(" ", text.lower())
    if not found.isascii():
        # Numbers that are no decimal digits, and marks, are word characters of the pattern, but no letters.
        odd = {char for char in set(found) if not char.isalpha()} - {" "}
        if odd:
            found = found.translate(dict.fromkeys(map(ord, odd), " "))
    found = " ".join(found.split())
    return f" {found} " if found else ""


def suffix_automaton(text: str, codes: dict[str, int]) -> list[dict[int, int]]:
    """Next state by character code for each state; the start is state 1, and state 0 is none."""
    nexts: list[dict[int, int]] = [{}, {}]
    links, lengths = [0, 0], [0, 0]
    last = 1
    for char in text:
        code = codes[char]
        new = len(nexts)
        nexts.append({})
        lengths.append(lengths[last] + 1)
        links.append(1)
        at = last
        while at and code not in nexts[at]:
            nexts[at][code] = new
            at = links[at]
        if at:
            to = nexts[at][code]
            if lengths[to] == lengths[at] + 1:
                links[new] = to
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[to]))
                lengths.append(lengths[at] + 1)
                links.append(links[to])
                while at and nexts[at].get(code) == to:
                    nexts[at][code] = clone
                    at = links[at]
                links[to] = links[new] = clone
        last = new
    return nexts


class Slots:
    """Gives each state a base such that the slots ``base + code`` of its codes are its own.

    So rows of few steps lie within each other, and room is needed for the steps
    alone, whatever the number of characters. No two states have the same base.
    """

    def __init__(self, width: int) -> None:
        self._width = width
        self._taken = bytearray(2 * width + 1)
        self._bases: set[int] = set()
        self._starts = [width, width]  # where rows of one code, and of several, are tried first

    def _grown(self, size: int) -> None:
        if size >= len(self._taken):
            self._taken.extend(bytes(size))

    def base(self, codes: list[int]) -> int:
        least = codes[0] if codes else 0
        several = len(codes) > 1
        slot = self._starts[several]
        tries = 0
        while True:
            slot = self._taken.find(0, slot)
            if slot < 0:
                slot = len(self._taken)
            self._grown(slot + self._width + 1)
            base = slot - least
            if base not in self._bases and not any(self._taken[base + code] for code in codes):
                break
            slot += 1
            tries += 1
        if tries > SLOT_TRIES:
            self._starts[several] = slot
        self._bases.add(base)
        for code in codes:
            self._taken[base + code] = 1
        return base

    @property
    def size(self) -> int:
        return max(self._bases, default=0) + self._width + 1


class Model:
    """The steps of all languages in one array.

    A state is its base. ``steps[base + code]`` holds the base that owns the slot
    in its upper half, and in its lower one twice the base of the next state. In
    a slot of another owner there is no such step: the character begins a phrase,
    and leads to ``begins[language, code]``, which has 1 added to say so. The start
    owns no slot, as there every character begins a phrase.
    """

    def __init__(self, texts: dict[str, str]) -> None:
        self.languages = sorted(texts)
        chars = sorted({char for text in texts.values() for char in text})
        codes = {char: place for place, char in enumerate(chars, 1)}
        self._codes = np.zeros(max(map(ord, chars), default=0) + 2, np.uint16 if len(chars) < 1 << 16 else np.int32)
        for char, code in codes.items():
            self._codes[ord(char)] = code
        width = len(chars) + 1
        slots, placed = Slots(width), []
        for language in self.languages:
            nexts = suffix_automaton(texts[language], codes)
            start, nexts[1] = nexts[1], {}
            bases = [0] * len(nexts)
            for state in sorted(range(1, len(nexts)), key=lambda at: -len(nexts[at])):
                bases[state] = slots.base(sorted(nexts[state]))
            placed.append((start, nexts, bases))
        if slots.size >= 1 << 30:
            raise ValueError("the sample is too large for one table")
        self._steps = np.full(slots.size, -1, np.int64)
        self._begins = np.zeros((len(placed), width), np.int64)
        self.starts = np.array([bases[1] for _, _, bases in placed], np.int64)
        for place, (start, nexts, bases) in enumerate(placed):
            self._begins[place] = 2 * bases[1] + 1  # a character that occurs nowhere leads to the start
            for code, to in start.items():
                self._begins[place, code] = 2 * bases[to] + 1
            for base, row in zip(bases, nexts, strict=True):
                for code, to in row.items():
                    self._steps[base + code] = base << 32 | 2 * bases[to]
        self.rates = np.array([math.log2(max(2, len(texts[language]))) for language in self.languages])

    @property
    def nbytes(self) -> int:
        return self._steps.nbytes + self._begins.nbytes + self._codes.nbytes

    def codes(self, text: str) -> np.ndarray:
        """Code of each character; 0 for those no language has."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        return self._codes[np.minimum(points, len(self._codes) - 1)]

    def _step(self, state: np.ndarray, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Twice the next state, plus 1 where the character begins a phrase and so follows ``begins``."""
        found = self._steps.take(state + codes)
        return np.where(found >> 32 == state, found & 0xFFFFFFFF, begins)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language.

        Segments of a text are parsed side by side, each as if a phrase began
        with it. One that follows another is then parsed again from the state in
        which that ended, until both ways are in the same state, from where on
        they are one. If they are not until its end, the next has to follow anew.
        So the counts are those of the whole text, wherever segments end.
        """
        cuts = [codes[at : at + SEGMENT] for codes in texts for at in range(0, len(codes), SEGMENT)]
        owner = np.repeat(np.arange(len(texts)), [-(-len(codes) // SEGMENT) for codes in texts])
        order = np.argsort([-len(cut) for cut in cuts], kind="stable")
        lengths = np.array([len(cuts[at]) for at in order])
        longest = int(lengths[0]) if len(cuts) else 0
        grid = np.zeros((longest, len(cuts)), self._codes.dtype)
        for place, at in enumerate(order):
            grid[: len(cuts[at]), place] = cuts[at]
        active = len(cuts) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")
        found = np.zeros((len(self.languages), len(cuts)), np.int64)
        state = np.repeat(self.starts[:, None], len(cuts), 1)
        for row, width in zip(grid, active.tolist(), strict=True):
            codes = row[:width]
            step = self._step(state[:, :width], codes, self._begins.take(codes, axis=1))
            found[:, :width] += step & 1
            state[:, :width] = step >> 1
        column = np.empty(len(cuts), np.int64)
        column[order] = np.arange(len(cuts))
        follows = np.flatnonzero(owner[1:] == owner[:-1])
        if len(follows):
            self._carry(grid, lengths, column[follows], column[follows + 1], found, state)
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(counts, owner[order], found.T)
        return counts

    def _carry(
        self,
        grid: np.ndarray,
        lengths: np.ndarray,
        before: np.ndarray,
        after: np.ndarray,
        found: np.ndarray,
        ends: np.ndarray,
    ) -> None:
        """Correct ``found`` and ``ends`` of columns ``after``, which go on where columns ``before`` end."""
        begun = np.repeat(self.starts[:, None], len(after), 1)
        while True:
            language, pair = np.nonzero(begun != ends[:, before])
            if not len(language):
                return
            own, new = begun[language, pair], ends[language, before[pair]]
            begun[language, pair] = new
            column = after[pair]
            for place in range(len(grid)):
                apart = own != new
                ended = lengths[column] <= place
                done = apart & ended
                ends[language[done], column[done]] = new[done]
                going = apart & ~ended
                if not going.all():
                    language, column, own, new = language[going], column[going], own[going], new[going]
                if not len(language):
                    break
                codes = grid[place, column]
                begins = self._begins[language, codes]
                own, new = self._step(own, codes, begins), self._step(new, codes, begins)
                np.add.at(found, (language, column), (new & 1) - (own & 1))
                own, new = own >> 1, new >> 1
            apart = own != new
            ends[language[apart], column[apart]] = new[apart]


def learn(
    labelled: DataFrame,
    sample_chars: int = SAMPLE_CHARS,
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> Model:
    """Model from ``doc_id, text, lang`` rows, none of them null.

    Of each language, the ``sample_documents`` ids with the smallest hash are
    picked, and their texts taken in that order until they have ``sample_chars``
    letters and spaces. An id that comes with several languages is of the first
    one, and one with several texts has the least of them. So what reaches the
    driver is bounded for each language, however often an id is repeated.
    """
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ids = labelled.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("draw", F.xxhash64("doc_id"))
    picked = ids.withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample_documents)
    # A language at most `sample_documents` rows, each of at most `sample_chars` characters.
    rows = (
        labelled.select("doc_id", "lang", F.substring("text", 1, sample_chars).alias("text"))
        .join(F.broadcast(picked.select("doc_id", "lang", "place")), ["doc_id", "lang"])
        .groupBy("lang", "place")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values(["lang", "place"])
    )
    texts: dict[str, str] = {}
    for lang, text in zip(rows["lang"], rows["text"], strict=True):
        if len(texts.setdefault(lang, "")) < sample_chars:
            texts[lang] += letters_only(text)
    return Model({lang: text[:sample_chars] for lang, text in texts.items() if text})


def judged(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``documents`` with ``lang_pred, score, n_letters, phrase`` of their text.

    ``score`` is how far the best language is ahead of the next, ``1 - h1 / h2``
    with cross entropies ``h``, and 1 if only one language is known. ``phrase``
    is the mean length of a phrase in the best language. Equal entropies: the
    language first by code point. A null text, or one without a letter, is
    ``und`` with score 0; so is every text if nothing was learned.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    # A text that is kept anyway is sent once.
    source = "text" if "text" in keep else _TEXT
    frame = documents.select(*keep, *([] if "text" in keep else [F.col("text").alias(_TEXT)]))

    def blocks(batch: dict[str, list]):
        texts, begin, held = [], 0, 0
        for text in batch[source]:
            texts.append(shared.value.codes(letters_only(text or "")))
            held += len(texts[-1])
            if held >= BLOCK:
                yield answers(batch, begin, texts)
                begin, texts, held = begin + len(texts), [], 0
        yield answers(batch, begin, texts)

    def answers(batch: dict[str, list], begin: int, texts: list[np.ndarray]) -> dict[str, Any]:
        found = shared.value
        sizes = np.array([len(codes) for codes in texts], np.int64)
        known = (sizes > 0) & (len(found.languages) > 0)
        best, score, phrase = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
        if known.any():
            counts = found.phrases([codes for codes in texts if len(codes)])
            entropy = counts * found.rates / sizes[known, None]
            best[known] = winner = entropy.argmin(1)
            order = np.sort(entropy, 1)
            score[known] = 1 - order[:, 0] / order[:, 1] if order.shape[1] > 1 else 1.0
            phrase[known] = sizes[known] / counts[np.arange(len(counts)), winner]
        names = [*found.languages, UNDETERMINED]
        return {name: batch[name][begin : begin + len(texts)] for name in keep} | {
            _PRED: [names[at] for at in best],
            _SCORE: score,
            _LETTERS: sizes,
            _PHRASE: phrase,
        }

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema]
    found = [f"{_PRED} string", f"{_SCORE} double", f"{_LETTERS} bigint", f"{_PHRASE} double"]
    return map_rows(frame, blocks, ", ".join(kept + found), BYTES_AT_ONCE, stores=())


def learn_outside_fold(documents: DataFrame, folds: int = FOLDS) -> Model:
    """Model from the documents with text, language and id whose fold is not 0."""
    labelled = documents.select("doc_id", "text", "lang").dropna()
    return learn(labelled.where(fold(F.col("doc_id"), folds) != 0))


def identify_languages(documents: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, phrase``: every document, by a model of those not held out.

    Held out are documents with ``crc32(doc_id as text) mod folds = 0``; one
    without an id is neither held out nor learned from. Repeated rows have the
    same answer; an empty table gives no row; other columns are not read.
    """
    found = judged(documents, learn_outside_fold(documents, folds), ["doc_id"])
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col(_PRED).alias("lang_pred"),
        F.col(_SCORE).alias("score"),
        F.col(_PHRASE).alias("phrase"),
    )


def in_known_language(documents: DataFrame, folds: int = FOLDS, least_phrase: float = LEAST_PHRASE) -> DataFrame:
    """Rows of ``documents``, all columns, whose text is in a learned language.

    Rejected are texts without a letter, and those that even in the best
    language fall into phrases of under ``least_phrase`` characters on average,
    as text in another script does. That is for a language learned from
    ``SAMPLE_CHARS`` characters, and less for one learned from fewer. A null or empty
    text is rejected; repeated rows have the same answer; an empty table gives no
    row; other columns, of any name, are kept as they are.
    """
    documents, named = shielded(documents, ("doc_id", "text", "lang"))
    model = learn_outside_fold(documents, folds)
    found = judged(documents, model, documents.columns)
    least = F.lit(least_phrase)
    for name, rate in zip(model.languages, model.rates.tolist(), strict=True):
        own = max(least_phrase * rate / math.log2(SAMPLE_CHARS), min(least_phrase, SHORTEST_PHRASE))
        least = F.when(F.col(_PRED) == name, own).otherwise(least)
    known = (F.col(_PRED) != UNDETERMINED) & (F.col(_PHRASE) >= least)
    return named(found.where(known))
