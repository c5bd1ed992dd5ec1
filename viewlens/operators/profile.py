"""Column types, counts and statistics of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, IntegralType, LongType, NumericType

#: Quartiles by their number of fourths.
QUARTILES = {"p25": 1, "p50": 2, "p75": 3}
#: A sketch is off by no more than one in this many ranks.
ACCURACY = 10_000
#: Values between two bounds that one task sorts.
SORTED = 10_000
EXACT = Context(prec=80)


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: name, type and number of non-NULL values."""
    counted = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema.fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col(f.name).alias("non_null"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


def column_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std, min, exact quartiles, max.

    All numeric columns by default. NULLs do not count; a NaN counts as the largest
    value; a column without values has count 0 and NULLs. Each column is treated in its
    own type, whatever stands beside it: min and max are long where all columns are
    integers, double where all are fractional, and else text. Quartiles are
    interpolated between exact values of the ranks next to them.

    The ranks are found by narrowing intervals: a quantile sketch of the values in an
    interval gives a smaller one, the next scan counts what lies below, at and between its
    bounds, until few enough values lie between to be sorted. Every scan returns
    one row, so next to nothing is shuffled; as a sketch narrows an interval some
    thousandfold, three scans do for a thousand million rows.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    names = list(columns or kinds)
    if not names:
        raise ValueError("there is no numeric column")
    found = [_Column(name, kinds[name]) for name in names]
    while open_ := [c for c in found if not c.done]:
        wanted = {key: e for c in open_ for key, e in c.wanted().items()}
        keys = list(wanted)
        row = df.agg(*[wanted[k].alias(f"_{i}") for i, k in enumerate(keys)]).first()
        answers = dict(zip(keys, row, strict=True))
        for c in open_:
            c.take(answers)
    kind = _bounds_type([c.kind for c in found])
    schema = (
        f"column_name string, n long, mean double, std double, min {kind}, p25 double, "
        f"p50 double, p75 double, max {kind}"
    )
    return df.sparkSession.createDataFrame([c.row(kind) for c in found], schema)


def _bounds_type(kinds: Sequence[DataType]) -> str:
    if all(isinstance(k, IntegralType) for k in kinds):
        return "long"
    floating = not any(isinstance(k, IntegralType | DecimalType) for k in kinds)
    return "double" if floating else "string"


@dataclass(frozen=True)
class _Interval:
    """Values strictly between two bounds; counted once ``between`` is known.

    ``below`` is the number of values that come before them, ``outer`` the interval
    to return to when a rank turns out to lie elsewhere.
    """

    low: object
    high: object
    below: int = 0
    between: int | None = None
    outer: _Interval | None = None


class _Column:
    """The statistics of one column, and the interval in which each wanted rank lies."""

    def __init__(self, name: str, kind: DataType):
        self.name, self.kind = name, kind
        self.floating = not isinstance(kind, IntegralType | DecimalType)
        self.scale = kind.scale if isinstance(kind, DecimalType) else 0
        self.stored: DataType = kind
        if not isinstance(kind, DecimalType):
            self.stored = DoubleType() if self.floating else LongType()
        self.all = F.col(f"`{name}`").cast(self.stored)
        # A NaN is set apart, as it is neither below nor above a bound.
        self.value = F.when(~F.isnan(self.all), self.all) if self.floating else self.all
        self.n: int | None = None
        self.squares: float | None = None
        self.ranks: dict[int, object] = {}
        self.intervals: dict[int, _Interval] = {}
        self.margin = 2 / ACCURACY
        #: Whether it holds whole numbers that a double does not.
        self.large = False

    @property
    def done(self) -> bool:
        return self.n == 0 or self.squares is not None and not self.intervals

    def wanted(self) -> dict[tuple, Column]:
        """Aggregates of the next scan by a key."""
        name, v = self.name, self.value
        if self.n is None:
            return {
                (name, "n"): F.count(self.all),
                (name, "known"): F.count(v),
                (name, "mean"): F.avg(self.all).cast("double"),
                (name, "least"): F.min(v),
                (name, "most"): F.max(v),
                (name, "min"): F.min(self.all).cast("string"),
                (name, "max"): F.max(self.all).cast("string"),
            }
        found: dict[tuple, Column] = {}
        if self.squares is None:
            away = self._from_mean()
            found[name, "away"], found[name, "squares"] = F.sum(away), F.sum(away * away)
        for i in set(self.intervals.values()):
            low, high = self._literal(i.low), self._literal(i.high)
            inside = (v > low) & (v < high)
            if i.between is None:
                found[name, i, "below"] = F.count_if(v < low)
                found[name, i, "low"] = F.count_if(v == low)
                found[name, i, "between"] = F.count_if(inside)
                found[name, i, "high"] = F.count_if(v == high)
            elif i.between <= SORTED:
                found[name, i, "sorted"] = F.sort_array(F.collect_list(F.when(inside, v)))
            else:
                ends = [end for rank in self._ranks_in(i) for end in self._ends(rank, i)]
                found[name, i, "sketch"] = F.percentile_approx(
                    F.when(inside, self._as_double(i)), ends, ACCURACY
                )
        return found

    def take(self, answers: dict) -> None:
        """Uses the results of a scan."""
        name = self.name
        if self.n is None:
            self.n, self.mean = answers[name, "n"], answers[name, "mean"]
            self.min, self.max = answers[name, "min"], answers[name, "max"]
            everything = _Interval(answers[name, "least"], answers[name, "most"])
            if self.n and self.stored == LongType():
                self.large = max(abs(everything.low), abs(everything.high)) >= 1 << 53
            for rank in {r for k in QUARTILES.values() for r in self._ranks(k)} if self.n else ():
                if rank < answers[name, "known"]:
                    self.intervals[rank] = everything
                else:
                    self.ranks[rank] = float("nan")
            return
        if self.squares is None:
            self.squares = answers[name, "squares"]
            if self.large:
                # What the first mean was off by rounding is taken out again.
                away = answers[name, "away"]
                self.mean = float(self._units(self.mean) + away / self.n)
                self.squares = max(0.0, self.squares - away * away / self.n)
        narrowed: dict[int, _Interval] = {}
        ranks_in = {i: self._ranks_in(i) for i in set(self.intervals.values())}
        for rank, i in list(self.intervals.items()):
            if i.between is None:
                counts = [answers[name, i, k] for k in ("below", "low", "between", "high")]
                self._place(rank, i, *counts)
            elif i.between <= SORTED:
                self._answer(rank, answers[name, i, "sorted"][rank - i.below])
            else:
                place = 2 * ranks_in[i].index(rank)
                low, high = self._bounds(i, *answers[name, i, "sketch"][place : place + 2])
                narrowed[rank] = _Interval(low, high, outer=i)
        self.intervals |= narrowed

    def _ranks_in(self, i: _Interval) -> list[int]:
        return sorted(r for r, j in self.intervals.items() if i == j)

    def _ends(self, rank: int, i: _Interval) -> tuple[float, float]:
        """Shares of the values of an interval, between which a rank is even if a sketch errs."""
        share = (rank - i.below + 0.5) / i.between
        return max(0.0, share - self.margin), min(1.0, share + self.margin)

    def _place(self, rank: int, i: _Interval, below: int, at_low: int, between: int, at_high: int):
        """Tells from the counts around an interval on which side of its bounds a rank is."""
        start, end = below + at_low, below + at_low + between
        if below <= rank < start:
            self._answer(rank, i.low)
        elif start <= rank < end:
            self.intervals[rank] = _Interval(i.low, i.high, start, between)
        elif end <= rank < end + at_high:
            self._answer(rank, i.high)
        else:
            # The sketch missed the rank; it is tried again with more room.
            self.margin *= 8
            self.intervals[rank] = i.outer

    def _answer(self, rank: int, value) -> None:
        self.ranks[rank] = value
        del self.intervals[rank]

    def _from_mean(self) -> Column:
        if not self.large:
            return self.all.cast("double") - F.lit(self.mean)
        exact = DecimalType(38, 0)
        return (self.all.cast(exact) - F.lit(str(self._units(self.mean))).cast(exact)).cast("double")

    # A sketch holds doubles. Whole numbers and decimals are measured from the lower bound
    # in units of their last place, so that a double is exact once the interval is small.

    def _wide(self, i: _Interval) -> bool:
        return self._units(i.high) - self._units(i.low) > 1 << 100

    def _as_double(self, i: _Interval) -> Column:
        if self.floating or self._wide(i):
            return self.value.cast("double")
        exact = DecimalType(38, self.scale)
        return (self.value.cast(exact) - self._literal(i.low).cast(exact)).cast("double")

    def _bounds(self, i: _Interval, first: float, last: float) -> tuple:
        """Bounds that a sketch gives, moved apart by what doubles may be off."""
        if self.floating:
            return first, last
        low, high = self._units(i.low), self._units(i.high)
        found = [round(EXACT.scaleb(Decimal(x), self.scale)) for x in (first, last)]
        if self._wide(i):
            errors = [(max(abs(low), abs(high)) >> 48) + 1] * 2
        else:
            errors = [x >> 48 for x in found]
            found = [low + x for x in found]
        return (
            self._value(max(low, found[0] - errors[0])),
            self._value(min(high, found[1] + errors[1])),
        )

    def _units(self, value) -> int:
        return int(EXACT.scaleb(Decimal(value), self.scale))

    def _value(self, units: int):
        return EXACT.scaleb(Decimal(units), -self.scale) if self.scale else units

    def _literal(self, value) -> Column:
        return F.lit(value if self.floating else str(value)).cast(self.stored)

    def _ranks(self, k: int) -> tuple[int, int]:
        """The ranks next to quartile k."""
        whole, rest = divmod((self.n - 1) * k, 4)
        return whole, whole + (rest > 0)

    def _quartile(self, k: int) -> float:
        low, high = (self.ranks[r] for r in self._ranks(k))
        part = (self.n - 1) * k % 4 / 4
        return float(low) if low == high else float(low) * (1 - part) + float(high) * part

    def row(self, kind: str) -> tuple:
        if not self.n:
            return (self.name, 0, *[None] * 7)
        std = math.sqrt(self.squares / (self.n - 1)) if self.n > 1 else None
        convert = {"long": int, "double": float, "string": str}[kind]
        quartiles = [self._quartile(k) for k in QUARTILES.values()]
        return (self.name, self.n, self.mean, std, convert(self.min), *quartiles, convert(self.max))
