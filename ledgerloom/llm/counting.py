"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

A pre-token is a word with the white space after it, and the tokenizer encodes
each by itself. Leaves hold some hundred characters of whole pre-tokens, nodes
the characters and tokens below them. An edit finds its leaf by going down the
tree, re-encodes the pre-tokens it touches and what they now run into on either
side, and adds the difference on the way up; all other counts stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import TOKENIZER, Encoder, encoder
from ledgerloom.llm.words import map_rows

#: Characters of a leaf, about; a leaf that grows to ``SPLIT`` times as many is split, if it has several pre-tokens.
LEAF_CHARS = 512
SPLIT = 8
#: Levels, beyond twice those of an even tree, from which on the leaves, as they are, get an even tree again.
MORE_LEVELS = 8
#: Characters of a text for each edit that the derived edits make.
CHARS_PER_EDIT = 2000
_SPACES = " \t\n\x0b\x0c\r"
_SPACE = re.compile("[ \t\n\x0b\x0c\r]")


class Edit(NamedTuple):
    """At character ``at`` of the text as it then is, ``length`` characters give way to ``insert``."""

    at: int
    length: int
    insert: str


class Node:
    """Characters and tokens of what is below; a leaf has a text and nothing below."""

    __slots__ = ("chars", "tokens", "left", "right", "above", "text")

    def __init__(self, text: str = "", tokens: int = 0) -> None:
        self.text = text
        self.chars = len(text)
        self.tokens = tokens
        self.left: Node | None = None
        self.right: Node | None = None
        self.above: Node | None = None


def even_tree(row: list[Node]) -> Node:
    """The top of a tree over the given nodes, in their order."""
    while len(row) > 1:
        joined = []
        for at in range(0, len(row) - 1, 2):
            node = Node()
            node.left, node.right = row[at], row[at + 1]
            node.left.above = node.right.above = node
            node.chars = node.left.chars + node.right.chars
            node.tokens = node.left.tokens + node.right.tokens
            joined.append(node)
        row = joined + row[2 * len(joined) :]
    row[0].above = None
    return row[0]


class CountTree:
    """Token counts of one text under edits.

    Each leaf that others with text follow ends in white space or is empty, so no
    pre-token is in two leaves. ``reencoded`` counts the words encoded for edits:
    those that were there, those that took their place, and those of split leaves.
    """

    def __init__(self, text: str, encode: Encoder) -> None:
        self._encode = encode
        leaves = [Node(piece, self._count(piece)[0]) for piece in self._pieces(text)]
        self._n_leaves = len(leaves)
        self._root = even_tree(leaves)
        self.reencoded = 0

    def _count(self, text: str) -> tuple[int, int]:
        words = text.encode("utf-8", "replace").split()
        return sum(map(self._encode.count, words)), len(words)

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """The text in pieces of whole pre-tokens, one at least."""
        cuts = [0]
        while len(text) - cuts[-1] > LEAF_CHARS:
            found = _SPACE.search(text, cuts[-1] + LEAF_CHARS - 1)
            if not found or found.end() == len(text):
                break
            cuts.append(found.end())
        return [text[begin:end] for begin, end in zip(cuts, [*cuts[1:], len(text)], strict=True)]

    @property
    def n_tokens(self) -> int:
        return self._root.tokens

    @property
    def n_chars(self) -> int:
        return self._root.chars

    def leaves(self) -> Iterator[Node]:
        leaf: Node | None = self._lowest(self._root)
        while leaf:
            yield leaf
            leaf = self._next(leaf)

    def text(self) -> str:
        """The text as it is now."""
        return "".join(leaf.text for leaf in self.leaves())

    @staticmethod
    def _lowest(node: Node) -> Node:
        """The first leaf below."""
        while node.left:
            node = node.left
        return node

    def _next(self, leaf: Node) -> Node | None:
        """The leaf after this one."""
        node = leaf
        while node.above and node.above.right is node:
            node = node.above
        return self._lowest(node.above.right) if node.above else None

    def _find(self, at: int) -> tuple[Node, int]:
        """Leaf that has character ``at``, and the place in it; the end of the text follows its last character."""
        if not self.n_chars:
            return self._lowest(self._root), 0
        if at >= self.n_chars:
            leaf, place = self._find(self.n_chars - 1)
            return leaf, place + 1
        node = self._root
        while node.left:
            if at >= node.left.chars:
                at -= node.left.chars
                node = node.right
            else:
                node = node.left
        return node, at

    @staticmethod
    def _set(leaf: Node, text: str, tokens: int) -> None:
        """New text of a leaf, whose count changes by ``tokens``."""
        chars = len(text) - len(leaf.text)
        leaf.text = text
        node: Node | None = leaf
        while node:
            node.chars += chars
            node.tokens += tokens
            node = node.above

    def _split(self, leaf: Node) -> None:
        """Cut a leaf into several, if it has several pre-tokens; sums above stay as they are."""
        pieces = self._pieces(leaf.text)
        if len(pieces) < 2:
            return
        row = []
        for piece in pieces:
            tokens, words = self._count(piece)
            self.reencoded += words
            row.append(Node(piece, tokens))
        self._n_leaves += len(row) - 1
        above, top = leaf.above, even_tree(row)
        top.above = above
        if not above:
            self._root = top
        elif above.left is leaf:
            above.left = top
        else:
            above.right = top
        levels, node = len(row).bit_length(), above
        while node:
            levels, node = levels + 1, node.above
        if levels > 2 * self._n_leaves.bit_length() + MORE_LEVELS:
            self._root = even_tree(list(self.leaves()))

    def apply(self, edit: Edit) -> None:
        """Make one edit; what lies outside the text is cut off."""
        at = min(max(0, edit.at), self.n_chars)
        stop = min(self.n_chars, at + max(0, edit.length))
        first, begin = self._find(at)
        last, end = self._find(max(at, stop - 1))
        end += stop > at
        emptied, texts, leaf = [], [first.text], first
        while leaf is not last:
            leaf = self._next(leaf)
            emptied.append(leaf)
            texts.append(leaf.text)
        joined = "".join(texts)
        end += len(joined) - len(last.text)
        # What follows the edit belongs to it until there is white space.
        while not (after := _SPACE.search(joined, end)) and (leaf := self._next(last)):
            last = leaf
            emptied.append(leaf)
            joined += leaf.text
        right = after.start() if after else len(joined)
        left = max(joined.rfind(space, 0, begin) for space in _SPACES) + 1
        new = joined[left:begin] + edit.insert + joined[end:right]
        old_tokens, old_words = self._count(joined[left:right])
        new_tokens, new_words = self._count(new)
        self.reencoded += old_words + new_words
        text = joined[:left] + new + joined[right:]
        moved = 0
        for leaf in emptied:
            moved += leaf.tokens
            self._set(leaf, "", -leaf.tokens)
        self._set(first, text, moved + new_tokens - old_tokens)
        if len(text) > SPLIT * LEAF_CHARS:
            self._split(first)


def with_edits(documents: DataFrame, edits: DataFrame) -> DataFrame:
    """``doc_id, text, edits`` from a table of edits (``doc_id, seq, at, length, insert``), in order of ``seq``."""
    lists = edits.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "at", "length", "insert"))).alias("edits")
    )
    return documents.select("doc_id", "text").join(lists, "doc_id", "left")


def derived_edits(doc_id: Column, text: Column, chars_per_edit: int = CHARS_PER_EDIT) -> Column:
    """Edits that follow from id and text: one for each ``chars_per_edit`` characters, and one more.

    In turn, characters are deleted, replaced by a piece of the text from
    elsewhere, and such a piece inserted.
    """
    size = F.coalesce(F.length(text), F.lit(0))

    def draw(place: Column, salt: int, below: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id, place, F.lit(salt)), F.greatest(below, F.lit(1))).cast("int")

    def edit(place: Column) -> Column:
        length = F.when(place % 3 == 2, F.lit(0)).otherwise(draw(place, 1, F.lit(40)))
        piece = F.substring(F.coalesce(text, F.lit("")), draw(place, 2, size) + 1, draw(place, 3, F.lit(40)))
        insert = F.when(place % 3 == 0, F.lit("")).otherwise(piece)
        return F.struct(
            place.alias("seq"), draw(place, 4, size + 1).alias("at"), length.alias("length"), insert.alias("insert")
        )

    return F.transform(F.sequence(F.lit(0), F.floor(size / chars_per_edit).cast("int")), edit)


def edited_counts(frame: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_edits, n_tokens_before, n_tokens, n_chars, n_reencoded`` for ``doc_id, text, edits`` rows.

    ``edits`` is an array of structs ``at, length, insert``, made one after the
    other, each on the text that the last one left, in characters. ``n_tokens``
    equals the count of the text in the end; ``n_reencoded`` words were encoded for
    the edits, what they replaced and what was split among them. A null text is empty; a null array, or a null in an
    edit, changes nothing or counts as 0 or empty; places outside the text are
    cut off. Repeated rows each give a row; an empty table gives none; other
    columns are not read.
    """

    def rows(batch: dict[str, list]):
        columns: dict[str, list] = {
            name: [] for name in ("n_edits", "n_tokens_before", "n_tokens", "n_chars", "n_reencoded")
        }
        for text, edits in zip(batch["text"], batch["edits"], strict=True):
            tree = CountTree(text or "", encoder(tokenizer))
            before = tree.n_tokens
            made = [edit for edit in edits or [] if edit]
            for edit in made:
                tree.apply(Edit(edit["at"] or 0, edit["length"] or 0, edit["insert"] or ""))
            for name, value in zip(
                columns, (len(made), before, tree.n_tokens, tree.n_chars, tree.reencoded), strict=True
            ):
                columns[name].append(value)
        yield {"doc_id": batch["doc_id"]} | columns

    schema = "doc_id bigint, n_edits bigint, n_tokens_before bigint, n_tokens bigint, n_chars bigint, n_reencoded bigint"
    return map_rows(frame.select("doc_id", "text", "edits"), rows, schema)
