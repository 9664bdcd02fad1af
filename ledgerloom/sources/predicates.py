"""Conditions that split the read of an unevenly filled table into parts of about as many rows.

The key is counted where the rows are, in cells: one grouped count over the
whole range, then one more for each finer width, over the cells that still hold
too many rows. What comes back is bounded by the number of parts, however large
the table. Prefix sums over the cells give the borders. A key that by itself
would fill a part, and NULL, are parts of their own, cut further by another
column if there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Cells of each part at first, and cells that one of them is cut into.
FAN = 64
#: A cell with more rows than a part's share divided by this is cut further.
GRAIN = 4

#: Rows of a query, given as SQL text with ``{table}`` for the table: the driver's own, or the database's.
Ask = Callable[[str], Sequence[Sequence[int | None]]]


@dataclass(frozen=True)
class Part:
    """Keys from ``low`` to below ``high`` (NULL keys where both are None); the rows of ``slice`` of ``slices`` of them."""

    low: int | None
    high: int | None
    rows: int
    slice: int = 0
    slices: int = 1

    def condition(self, key: str, spread: str | None = None) -> str:
        """SQL condition for the rows of this part."""
        if self.low is None:
            own = f"({key}) IS NULL"
        elif self.high == self.low + 1:
            own = f"({key}) = {self.low}"
        else:
            own = f"({key}) >= {self.low} AND ({key}) < {self.high}"
        if self.slices == 1:
            return own
        rest = f"mod({spread}, {self.slices})"
        # Rows without a value to spread by are in the first slice.
        chosen = f"({rest} = 0 OR {rest} IS NULL)" if self.slice == 0 else f"{rest} = {self.slice}"
        return f"{own} AND {chosen}"


def range_query(key: str) -> str:
    """Query for the rows, the rows without a key, and the least and greatest key."""
    return f"SELECT count(*) AS n, count(*) - count({key}) AS without, min({key}) AS low, max({key}) AS high FROM {{table}}"


def cell_query(key: str, cells: Sequence[tuple[int, int]], width: int) -> str:
    """Query for the rows of each finer cell of ``width`` within cells from their low to below their high."""
    ranges = " OR ".join(f"(k >= {low} AND k < {high})" for low, high in cells)
    starts = " ".join(f"WHEN k < {high} THEN {low}" for low, high in cells)
    # Remainders are exact whole numbers in every dialect, other than quotients.
    return (
        f"SELECT k - mod(k - low, {width}) AS cell, count(*) AS n FROM "
        f"(SELECT k, CASE {starts} END AS low FROM (SELECT {key} AS k FROM {{table}}) keys WHERE {ranges}) cells "
        f"GROUP BY k - mod(k - low, {width})"
    )


def cells_of(ask: Ask, key: str, parts: int, fan: int = FAN, grain: int = GRAIN) -> tuple[int, int, list[tuple[int, int, int]]]:
    """Rows, rows without a key, and ``(low, high, rows)`` of the cells that hold rows, in order.

    A cell holds at most ``1 / grain`` of a part's share, or a single key.
    """
    total, without, low, high = (None if x is None else int(x) for x in next(iter(ask(range_query(key)))))
    if low is None:
        return total, without, []
    width = -(-(high - low + 1) // (parts * fan))
    open_, settled = [(low, high + 1)], []
    while open_:
        found = [(int(cell), int(n)) for cell, n in ask(cell_query(key, open_, width))]
        # The last cell of a range ends where the range does.
        ends = sorted(open_)
        place, following = 0, []
        for cell, n in sorted(found):
            while ends[place][1] <= cell:
                place += 1
            end = min(cell + width, ends[place][1])
            heavy = n * parts * grain > total and end - cell > 1
            (following.append((cell, end)) if heavy else settled.append((cell, end, n)))
        open_, width = following, max(1, -(-width // fan))
    return total, without, sorted(settled)


def plan_parts(ask: Ask, key: str, parts: int, spread: bool = False) -> list[Part]:
    """Parts that together hold every row once.

    Their number is about ``parts``: a key that holds more rows than a share, and
    NULL, are parts of their own, and with ``spread`` several each. No other part
    holds over ``1 + 1 / GRAIN`` of a share. An empty table has one part.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    total, without, cells = cells_of(ask, key, parts)
    found: list[Part] = []
    # The lowest range takes what is below, the highest what is above: a live table may have grown.
    before, run, rows, begin = 0, None, 0, None
    for low, high, n in cells:
        alone = n * parts > total
        own = None if alone else before * parts // total
        if run is not None and own != run:
            found.append(Part(begin, low, rows))
            run = None
        if alone:
            found += sliced(low, high, n, total, parts, spread)
            continue
        if run is None:
            run, rows, begin = own, 0, low
        before, rows = before + n, rows + n
        last = high
    if run is not None:
        found.append(Part(begin, last, rows))
    if without or not found:
        found += sliced(None, None, without, total, parts, spread)
    return found


def sliced(low: int | None, high: int | None, rows: int, total: int, parts: int, spread: bool) -> list[Part]:
    """The parts of one key, or of no key; with ``spread`` as many as its rows are shares, rounded up."""
    slices = max(1, -(-rows * parts // total)) if spread and total else 1
    return [Part(low, high, rows, at, slices) for at in range(slices)]


def gapless(parts: Sequence[Part], key: str, spread: str | None = None) -> list[str]:
    """Conditions of ``parts``, with keys beyond, and between, those that were counted.

    Every key, NULL included, meets exactly one of them, so rows that come to a
    live table after the count are read as well.
    """
    keyed = [part for part in parts if part.low is not None]
    lows = sorted({part.low for part in keyed})
    singles = {part.low for part in keyed if part.slices > 1 or part.high == part.low + 1}
    found = []
    for part in parts:
        if part.low is None:
            found.append(part.condition(key, spread))
            continue
        place = lows.index(part.low)
        following = lows[place + 1] if place + 1 < len(lows) else None
        if part.low in singles:
            single = part.condition(key, spread)
            # What lies between a single key and the next border goes with its first slice.
            above = f"({key}) > {part.low}" + (f" AND ({key}) < {following}" if following is not None else "")
            below = f" OR ({key}) < {part.low}" if place == 0 else ""
            found.append(f"({single}) OR ({above}){below}" if part.slice == 0 else single)
            continue
        borders = [f"({key}) >= {part.low}"] if place else []
        borders += [f"({key}) < {following}"] if following is not None else []
        found.append(" AND ".join(borders) or f"({key}) IS NOT NULL")
    if not any(part.low is None for part in parts):
        found[0] = f"({found[0]}) OR ({key}) IS NULL"
    if not keyed:
        found[0] = f"({found[0]}) OR ({key}) IS NOT NULL"
    return found


def even_predicates(ask: Ask, key: str, parts: int, spread: str | None = None) -> list[str]:
    """Conditions, one for each task, that every row meets one of, with about as many rows each.

    ``key`` is SQL for a whole number, in the dialect of whoever is asked, such as
    ``CAST(extract(epoch FROM at) AS bigint)`` for a timestamp. ``spread`` is SQL for a
    non-negative whole number by which the rows of one key may be told apart; without
    it a key that holds more than a share stays in one part.
    """
    return gapless(plan_parts(ask, key, parts, spread is not None), key, spread)


def hash_predicates(hashed: str, parts: int) -> list[str]:
    """Conditions for keys without an order of use, such as texts, by a non-negative whole number ``hashed`` of them.

    Even as far as no key holds a share of the rows; NULLs are in the first part.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    found = [f"mod({hashed}, {parts}) = {at}" for at in range(parts)]
    found[0] += f" OR ({hashed}) IS NULL"
    return found


def ask_frame(df: DataFrame) -> Ask:
    """Answers from a DataFrame; counts combine before the shuffle."""
    spark = df.sparkSession

    def ask(query: str) -> Sequence[Sequence[int | None]]:
        return spark.sql(query.replace("{table}", "{rows}"), rows=df).collect()  # a row for each cell

    return ask


def ask_database(spark: SparkSession, options: dict[str, str], table: str) -> Ask:
    """Answers from the database, which counts; ``table`` stands as Spark itself puts it after FROM."""

    def ask(query: str) -> Sequence[Sequence[int | None]]:
        asked = {**options, "dbtable": f"({query.format(table=table)}) answer"}
        return spark.read.format("jdbc").options(**asked).load().collect()  # a row for each cell

    return ask
