"""Exact median and mode without gathering a column in one task.

``percentile``/``median`` aggregates keep every distinct value of the column
in one final aggregation buffer, which does not survive 100 TB. The exact
values at ranks k..k+w-1 are found instead by narrowing a value range:

1. approximate quantiles (bounded-memory sketch, partial aggregation) give a
   bracket [a, b] around those ranks;
2. one filtered count pass verifies each bound and counts the rows equal to
   it: ranks that fall on a bound are answered, and the bound's rows, however
   many, leave the search;
3. repeat strictly inside the bracket until at most FINAL_ROWS rows are left,
   then read the ranks with a bounded ``orderBy().offset()``.

Each round is two passes over the (shrinking) column plus tiny aggregates;
the range filters reach the Parquet scan, so later rounds skip row groups.
Only scalars reach the driver.

``exact_medians`` and ``mode_values`` do the same for many columns at once:
one aggregate holds the sketches, or the counts, of all columns that are still
searched, so the number of jobs does not depend on the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINAL_ROWS = 50_000
ACCURACY = 20_000


def smallest_at(df: DataFrame, col: str, k: int, width: int = 1,
                n: int | None = None) -> list:
    """Exact non-null values of ``col`` at ranks ``k .. k+width-1`` (1-based,
    ascending). ``n`` is the non-null count if already known."""
    v = F.col("v")
    cur = df.select(F.col(col).alias("v")).where(v.isNotNull())
    if n is None:
        n = cur.count()
    last = k + width - 1
    if not 1 <= k <= last <= n:
        raise ValueError(f"ranks {k}..{last} outside 1..{n}")
    head, tail = [], []                       # answers found at the bounds
    while n > FINAL_ROWS:
        eps = 4.0 / ACCURACY
        qs = [max(0.0, (k - 1) / n - eps), min(1.0, last / n + eps)]
        a, b = cur.agg(F.percentile_approx(v, qs, ACCURACY)).first()[0]
        c = cur.agg(*[F.count(F.when(cond, 1)).alias(name) for name, cond in (
            ("lt_a", v < a), ("le_a", v <= a), ("lt_b", v < b), ("le_b", v <= b))]).first()
        before = n
        if c["le_b"] >= last:                 # no wanted value above b
            if k > c["lt_b"]:
                return head + [b] * (last - k + 1) + tail
            same = max(0, last - c["lt_b"])
            tail, last = [b] * same + tail, last - same
            cur, n = cur.where(v < b), c["lt_b"]
        if c["lt_a"] < k and a < b:           # no wanted value below a
            same = max(0, min(last, c["le_a"]) - k + 1)
            head, k = head + [a] * same, k + same
            if k > last:
                return head + tail
            cur, n, k, last = cur.where(v > a), n - c["le_a"], k - c["le_a"], last - c["le_a"]
        if n == before:
            raise RuntimeError("the quantile sketch missed its error bound")
    return head + [r["v"] for r in cur.orderBy(v).offset(k - 1).limit(last - k + 1).collect()] + tail


def kth_smallest(df: DataFrame, col: str, k: int):
    """Exact k-th smallest (1-based) non-null value of ``col``."""
    return smallest_at(df, col, k)[0]


def exact_median(df: DataFrame, col: str):
    """Median with interpolation between the two middle values (as SQL
    ``median``/``quantile_cont(0.5)``); both middle values come from one
    search."""
    n = df.where(F.col(col).isNotNull()).count()
    if n == 0:
        return None
    if n % 2:
        return float(smallest_at(df, col, (n + 1) // 2, 1, n)[0])
    a, b = smallest_at(df, col, n // 2, 2, n)
    return (float(a) + float(b)) / 2.0


def mode_value(df: DataFrame, col: str):
    """Most frequent non-null value; ties go to the smallest value. Counting
    per value is a partial aggregate, and picking the winner is a global
    ``min`` over (-count, value)."""
    c = F.col(col)
    counts = df.where(c.isNotNull()).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("b")).first()
    return None if best["b"] is None else best["b"]["v"]


# ---- many columns at once --------------------------------------------------------

JOINT_ROWS = 5_000                            # values of a column read at the end


@dataclass
class _Search:
    """The values of one column at ranks k..last among n values between the
    bounds ``low`` and ``high`` (both outside; None: open)."""
    col: str
    n: int
    k: int
    last: int
    low: object = None
    high: object = None
    head: list = field(default_factory=list)  # answers found at the bounds
    tail: list = field(default_factory=list)
    done: bool = False

    def value(self) -> Column:
        """The column where its value is still searched, else null."""
        c = F.col(f"`{self.col}`")
        inside = c.isNotNull()
        if self.low is not None:
            inside = inside & (c > F.lit(self.low))
        if self.high is not None:
            inside = inside & (c < F.lit(self.high))
        return F.when(inside, c)

    def quantiles(self) -> list[float]:
        eps = 4.0 / ACCURACY
        return [max(0.0, (self.k - 1) / self.n - eps), min(1.0, self.last / self.n + eps)]

    def narrow(self, a, b, lt_a: int, le_a: int, lt_b: int, le_b: int) -> None:
        """Take the counts around the bracket [a, b] into account."""
        before = self.n, self.k, self.last
        if le_b >= self.last:                 # no wanted value above b
            if self.k > lt_b:
                self.head += [b] * (self.last - self.k + 1)
                self.done = True
                return
            same = max(0, self.last - lt_b)
            self.tail = [b] * same + self.tail
            self.last -= same
            self.high, self.n = b, lt_b
        if lt_a < self.k and a < b:           # no wanted value below a
            same = max(0, min(self.last, le_a) - self.k + 1)
            self.head += [a] * same
            self.k += same
            if self.k > self.last:
                self.done = True
                return
            self.low, self.n, self.k, self.last = a, self.n - le_a, self.k - le_a, self.last - le_a
        if (self.n, self.k, self.last) == before:
            raise RuntimeError("the quantile sketch missed its error bound")


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """``exact_median`` of every column; columns without a value give None."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    searches = {c: _Search(c, n, (n + 1) // 2, n // 2 + 1) for c, n in zip(cols, counts) if n}
    while open_ := [s for s in searches.values() if not s.done and s.n > JOINT_ROWS]:
        brackets = df.agg(*[F.percentile_approx(s.value(), s.quantiles(), ACCURACY).alias(f"q{i}")
                            for i, s in enumerate(open_)]).first()
        aggs = []
        for i, (s, (a, b)) in enumerate(zip(open_, brackets)):
            v = s.value()
            aggs += [F.count(F.when(cond, 1)).alias(f"{name}{i}") for name, cond in (
                ("lt_a", v < F.lit(a)), ("le_a", v <= F.lit(a)), ("lt_b", v < F.lit(b)), ("le_b", v <= F.lit(b)))]
        found = df.agg(*aggs).first()
        for i, (s, (a, b)) in enumerate(zip(open_, brackets)):
            s.narrow(a, b, *(found[f"{name}{i}"] for name in ("lt_a", "le_a", "lt_b", "le_b")))
    rest = [s for s in searches.values() if not s.done]
    if rest:
        # At most JOINT_ROWS values a column are left.
        left = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), s.value().cast("double").alias("v"))
                                   for i, s in enumerate(rest)])).alias("x")
        values: dict[int, list[float]] = {i: [] for i in range(len(rest))}
        for r in df.select(left).select("x.*").where("v IS NOT NULL").collect():
            values[r["i"]].append(r["v"])
        for i, s in enumerate(rest):
            s.head += sorted(values[i])[s.k - 1:s.last]
    out: dict[str, float | None] = dict.fromkeys(cols)
    for c, s in searches.items():
        middle = [float(x) for x in s.head + s.tail]
        out[c] = sum(middle) / len(middle)
    return out


def mode_values(df: DataFrame, cols: list[str]) -> dict:
    """``mode_value`` of every column, from one pass: rows are counted by value
    for each column as a grouping set of its own, and the winner of each set is
    a ``min`` over (-count, value)."""
    if not cols:
        return {}
    kept = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
    names = kept.columns
    counted = kept.groupingSets([[kept[n]] for n in names], *[kept[n] for n in names]).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    winners = []
    for i, n in enumerate(names):
        own = sum(1 << j for j in range(len(names)) if j != len(names) - 1 - i)     # all other columns are left out
        winners.append(F.min(F.when((F.col("g") == own) & F.col(n).isNotNull(),
                                    F.struct((-F.col("n")).alias("neg"), F.col(n).alias("v")))).alias(n))
    best = counted.agg(*winners).first()
    return {c: None if best[n] is None else best[n]["v"] for c, n in zip(cols, names)}
