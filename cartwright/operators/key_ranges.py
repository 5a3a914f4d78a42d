"""Ranges of a sort order with about as many rows each, from mergeable sketches of the order's columns.

A column becomes whole numbers that follow its order: a number, day, time or short decimal one, a text
one for each seven bytes behind what all its values begin with. A range starts at a tuple of
them. The first number's quantiles come from one aggregate; only where a single value would fill several
ranges is the next number sketched, among the rows with that value. Rows that are equal in all of them are
dealt out by a tag. What reaches the driver is one tuple a range.
"""

from __future__ import annotations

import json
from base64 import b64encode
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Null comes last; a value as great shares ranges with it.
LAST = (1 << 63) - 1
STEP, STEPS = 7, 4
_TAGS = 1 << 31
#: Comes after any text's bytes of all steps.
_LAST_BYTES = b"\xff" * (STEP * STEPS + 1)


def _exact(column: Column, kind: T.DataType) -> Column | None:
    """The column as one whole number that tells all its values apart."""
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(column.cast("date")).cast("bigint")
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.floor(F.extract(F.lit("SECOND"), column)).cast("bigint")
        return days * 86_400 + seconds
    if isinstance(kind, T.DecimalType) and kind.precision <= 17:
        return (column * F.lit(10**kind.scale)).cast("bigint")
    return None


def _of_text(column: Column, shared: int, step: int) -> Column:
    """Seven bytes of a text as a number; missing bytes count least."""
    part = F.substring(column.cast("binary"), shared + step * STEP + 1, STEP)
    return F.conv(F.rpad(F.hex(part), 2 * STEP, "0"), 16, 10).cast("bigint")


def _text_codes(column: Column, source: DataFrame) -> tuple[list[Column], bool, Column]:
    """Numbers of a text column, whether they tell all its values apart, and the bytes that all but the last are made of."""
    ends = source.agg(F.min(column), F.max(column), F.max(F.octet_length(column))).first()
    a, b = ((x or "").encode() for x in ends[:2])
    shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    steps = min(STEPS, -(-max(1, (ends[2] or 0) - shared) // STEP))
    codes = [F.coalesce(_of_text(column, shared, k), F.lit(LAST)) for k in range(steps)]
    # Missing bytes and zero bytes differ in the length. Longer texts don't follow each other by length.
    length = F.least(F.octet_length(column), F.lit(shared + STEPS * STEP + 1)).cast("bigint")
    read = F.coalesce(F.substring(column.cast("binary"), shared + 1, STEPS * STEP), F.lit(_LAST_BYTES))
    return [*codes, F.when(column.isNotNull(), length).otherwise(LAST)], shared + STEPS * STEP >= (ends[2] or 0), read


def _bytes_of(codes: tuple[int, ...]) -> bytes:
    """The least bytes of a text with these numbers."""
    return _LAST_BYTES if codes[0] == LAST else b"".join(c.to_bytes(STEP, "big") for c in codes).rstrip(b"\0")


class Ranges:
    """Where the ranges of ``order`` start, at most ``ranges`` of them.

    ``narrow`` are rows that have about the values of the first column, or of several first ones by their names;
    ``tag`` tells equal rows apart.
    """

    def __init__(self, df: DataFrame, order: list[Column], ranges: int, narrow: DataFrame | None = None, tag: str | None = None):
        kinds = df.select(*[c.alias(f"c{i}") for i, c in enumerate(order)]).schema
        names = df.select(*order).columns
        covered = 0 if narrow is None else next((i for i, n in enumerate(names) if i and n not in narrow.columns), len(names))
        self.codes: list[Column] = []
        #: A text's bytes and how many codes are steps of them, by the place of the first.
        self.texts: dict[int, tuple[Column, int]] = {}
        self.starts: list[tuple[int, ...]] = []
        crowded: dict[tuple[int, ...], int] = {(): ranges} if ranges > 1 else {}
        for i, (column, field) in enumerate(zip(order, kinds)):
            source = narrow if i < covered else df
            complete = True
            exact = _exact(column, field.dataType)
            if not crowded:
                return
            if exact is not None:
                found = [F.coalesce(F.least(exact, F.lit(LAST - 1)), F.lit(LAST))]
                # Seconds of a time are not all of it.
                complete = not isinstance(field.dataType, T.TimestampNTZType)
            elif isinstance(field.dataType, T.StringType):
                found, complete, read = _text_codes(column, source)
                self.texts[len(self.codes)] = read, len(found) - 1
            else:
                return
            for code in found:
                crowded = self._cut(source, code, crowded)
            if not complete:
                return
        if tag:
            self._cut(df, F.pmod(F.xxhash64(tag), F.lit(_TAGS)), crowded)

    def _cut(self, rows: DataFrame, code: Column, crowded: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], int]:
        """Cut what would fill several ranges by ``code``; returns what still would."""
        depth = len(self.codes)
        if not crowded:
            return {}
        most = max(crowded.values())
        sketch = F.percentile_approx("_code", [k / most for k in range(1, most)], max(10_000, 4 * most)).alias("_cuts")
        coded = rows.select(*[c.alias(f"_{i}") for i, c in enumerate(self.codes)], code.alias("_code"))
        names = [f"_{i}" for i in range(depth)]
        for i, name in enumerate(names):
            # Values that fill several ranges: fewer than there are ranges.
            coded = coded.where(F.col(name).isin(sorted({p[i] for p in crowded})))
        cuts = {tuple(r)[:-1]: r["_cuts"] for r in coded.groupBy(*names).agg(sketch).collect()}
        self.codes.append(code)
        deeper: dict[tuple[int, ...], int] = {}
        for prefix, n in crowded.items():
            found = cuts.get(prefix) or []
            picked = [found[k * most // n - 1] for k in range(1, n)] if found else []
            for value, same in groupby(picked):
                self.starts.append((*prefix, value))
                held = len(list(same))
                if held > 1:
                    deeper[*prefix, value] = held + 1
        self.starts = sorted(set(self.starts))
        return deeper

    def of_row(self) -> Column:
        return range_of(self.codes, self.starts)

    def with_range(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with ``of_row`` as column ``name``; of a text its bytes are compared, so no row needs its numbers."""
        depth, keys, places = max(map(len, self.starts), default=0), [], []
        while (at := places[-1][1] if places else 0) < depth:
            read, steps = self.texts.get(at, (None, 1))
            keys.append((self.codes[at], "bigint") if read is None else (read, "binary"))
            places.append((at, at + steps))
        starts = [
            tuple(_bytes_of(s[a:b]) if a in self.texts else s[a] for a, b in places if a < len(s)) for s in self.starts
        ]
        return _searched(df, keys, starts, name)


def _reached(starts: list[tuple[int, ...]], codes: list[Column], place: Column) -> Column:
    """Whether a row has come to the start at ``place``; beyond the last one there is none."""
    depth = len(codes)

    def constant(i: int) -> Column:
        """The i-th numbers; a start without one comes before all that have one."""
        return F.split(F.lit(",".join(str(s[i]) if i < len(s) else str(-LAST - 1) for s in starts)), ",").cast("array<bigint>")

    # Only literals stay constant in a lambda: the starts are compared number by number, not as structs.
    def compared(i: int) -> Column:
        start = F.get(constant(i), place)
        if i == depth - 1:
            return start <= codes[i]
        return F.when(start < codes[i], True).when(start == codes[i], compared(i + 1)).otherwise(False)

    return compared(0)


def _halves(starts: list[tuple[int, ...]]) -> list[int]:
    return [1 << k for k in reversed(range(len(starts).bit_length()))]


def range_of(codes: list[Column], starts: list[tuple[int, ...]]) -> Column:
    """How many of ``starts`` do not come after a row: a binary search in constant arrays.

    The row's codes are a lambda's argument, so they are computed once and not at every step.
    """
    if not starts:
        return F.lit(0)
    codes = codes[: max(map(len, starts))]
    halves = F.array(*map(F.lit, _halves(starts)))

    def search(row: Column) -> Column:
        def step(at: Column, half: Column) -> Column:
            return F.when(_reached(starts, [row[f"c{i}"] for i in range(len(codes))], at + half - 1), at + half).otherwise(at)

        return F.aggregate(halves, F.lit(0), step)

    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(codes)])
    return F.get(F.transform(F.array(row), search), F.lit(0))


def with_range(df: DataFrame, codes: list[Column], starts: list[tuple[int, ...]], name: str) -> DataFrame:
    """``df`` with ``range_of`` as column ``name``, for many rows."""
    return _searched(df, [(c, "bigint") for c in codes[: max(map(len, starts), default=0)]], starts, name)


def _searched(df: DataFrame, keys: list[tuple[Column, str]], starts: list[tuple[int | bytes, ...]], name: str) -> DataFrame:
    """``df`` with the number of ``starts`` that do not come after the row's ``keys``, columns with their types.

    The row's place among the keys and the steps of the search are columns one after another, so each is computed once and all
    are compiled with the rest of the row; a lambda is interpreted. A step is one comparison, and its places are put together
    of bits, as sums are checked for overflow: the search must not make a row's method too long to be compiled well.
    """
    if not starts:
        return df.withColumn(name, F.lit(0))
    plain = [[b64encode(v).decode() if isinstance(v, bytes) else v for v in s] for s in starts]
    if len(keys) == 1:
        kind, key, values = keys[0][1], keys[0][0], [s[0] for s in plain]
    else:
        # A start without a value comes before all that have one, as null does in a comparison of structs.
        kind = f"struct<{', '.join(f'c{i}: {kind}' for i, (_, kind) in enumerate(keys))}>"
        key = F.struct(*[k.alias(f"c{i}") for i, (k, _) in enumerate(keys)])
        values = [{f"c{i}": v for i, v in enumerate(s)} for s in plain]
    constant = F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
    held = f"{name}_key"
    found = df.withColumns({held: key, name: F.lit(0)})
    for half in _halves(starts):
        at = F.col(name)
        reached = F.get(constant, at.bitwiseOR(F.lit(half - 1))) <= F.col(held)
        found = found.withColumn(name, F.when(reached, at.bitwiseOR(F.lit(half))).otherwise(at))
    return found.drop(held)
