"""Exact linear-interpolated quantiles in bounded memory.

`percentile` keeps every distinct value of a column in one aggregation buffer,
which is fine for small tables. Beyond `small` rows a bounded random sample
brackets each wanted order statistic, and one pass over all rows counts what
lies below and inside each bracket. The counts prove a bracket right, so the
sample never affects the answer. Brackets are narrowed until few rows lie
strictly between their ends (the ends themselves may be hot values); the values
left are counted exactly. No task ever holds more than the sample or
`MAX_BRACKET_ROWS` values per bracket, whatever the table size. A column that many quantiles are asked of
is sorted once instead, and the values at their ranks are read.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.ranking import order_index

SMALL_VALUES = 200_000  # rows x columns
SAMPLE_VALUES = (200_000, 2_000_000)  # over all brackets of one round, small and large tables
SAMPLE_SHARE = 0.01
MIN_SAMPLE = 2_000
MAX_BRACKET_ROWS = 20_000
MAX_ROUNDS = 40
MAX_BRACKETS = 16  # quantiles of one column; more are read off the sorted column


class _Target:
    """One wanted quantile: the two neighbouring ranks and the bracket known to hold both."""

    def __init__(self, column, q, n):
        self.column, self.q, self.n = column, q, n
        position = q * (n - 1)
        self.first = math.floor(position)
        self.second = min(self.first + 1, n - 1)
        self.fraction = position - self.first
        self.lo = self.hi = None  # inclusive ends, None = open
        self.below, self.inside, self.between = 0, n, n
        self.widen = 1.0
        self.answer = None

    def holds(self):
        keep = F.col(self.column).isNotNull()
        if self.lo is not None:
            keep = keep & (F.col(self.column) >= F.lit(self.lo))
        if self.hi is not None:
            keep = keep & (F.col(self.column) <= F.lit(self.hi))
        return keep

    def shares(self, sample):
        """Bracket ends as shares of the rows inside, six standard errors wide; one row when all are sampled."""
        a, b = (self.first - self.below) / self.inside, (self.second - self.below + 1) / self.inside
        if sample >= self.inside and self.widen == 1.0:
            return a - 1.0 / self.inside, b + 1.0 / self.inside
        middle = min(max((a + b) / 2, 1.0 / sample), 1 - 1.0 / sample)
        slack = self.widen * (6.0 * math.sqrt(middle * (1 - middle) / sample) + 20.0 / sample)
        return a - slack, b + slack


def exact_quantiles(df: DataFrame, wanted: dict, small: int = SMALL_VALUES) -> dict:
    """{column: [q, ...]} -> {(column, q): value or None}; nulls are left out."""
    columns = list(wanted)
    table = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = table.agg(*[F.count(c).alias(c) for c in columns]).first()
    out = {(c, float(q)): None for c, qs in wanted.items() for q in qs}
    filled = [c for c in columns if counts[c] and wanted[c]]
    if filled and max(counts[c] for c in filled) * len(filled) <= small:
        probabilities = {c: [float(q) for q in wanted[c]] for c in filled}
        row = table.agg(*[F.percentile(c, F.array(*[F.lit(q) for q in probabilities[c]])).alias(c) for c in filled]).first()
        for c in filled:
            out.update({(c, q): v for q, v in zip(probabilities[c], row[c])})
        return out
    open_ = [_Target(c, float(q), counts[c]) for c in filled for q in dict.fromkeys(wanted[c])]
    for c in filled:
        if len(targets := [t for t in open_ if t.column == c]) > MAX_BRACKETS:
            _read_off(table, c, targets)
            out.update({(c, t.q): t.answer for t in targets})
    open_ = [t for t in open_ if t.answer is None]
    for round_ in range(MAX_ROUNDS):
        if not open_:
            return out
        _narrow(table, open_, round_)
        _resolve(table, [t for t in open_ if t.between <= MAX_BRACKET_ROWS])
        for t in open_:
            if t.answer is not None:
                out[(t.column, t.q)] = t.answer
        open_ = [t for t in open_ if t.answer is None]
    raise RuntimeError("quantile brackets did not close")


def _read_off(table, column, targets):
    """Answers from the values at the two ranks of every target."""
    numbered, _ = order_index(table.select(column).filter(F.col(column).isNotNull()), column)
    ranks = sorted({r for t in targets for r in (t.first, t.second)})
    value = {r["idx"]: r[column] for r in numbered.filter(F.col("idx").isin(ranks)).collect()}
    for t in targets:
        t.answer = value[t.first] + t.fraction * (value[t.second] - value[t.first])


def _narrow(table, targets, round_):
    """New bracket ends from a sample of the rows inside, then proof by counting all rows."""
    wanted = SAMPLE_SHARE * max(t.n for t in targets)
    sample = max(MIN_SAMPLE, int(min(max(wanted, SAMPLE_VALUES[0]), SAMPLE_VALUES[1])) // len(targets))
    drawn = table.withColumn("_draw", F.rand(round_))
    chosen, ends = [], []
    for i, t in enumerate(targets):
        in_sample = t.holds() & (F.col("_draw") < F.lit(min(1.0, sample / t.inside)))
        chosen.append(F.when(in_sample, F.col(t.column)).alias(f"t{i}"))
        a, b = t.shares(min(sample, t.inside))
        shares = F.array(F.lit(min(max(a, 0.0), 1.0)), F.lit(min(max(b, 0.0), 1.0)))
        ends.append(F.percentile(f"t{i}", shares))
    ends = drawn.select(*chosen).agg(*ends).first()
    before, checks = [], []
    for i, t in enumerate(targets):
        before.append((t.lo, t.hi))
        a, b = t.shares(min(sample, t.inside))
        if ends[i] is not None:
            t.lo = t.lo if a <= 0.0 else ends[i][0]
            t.hi = t.hi if b >= 1.0 else ends[i][1]
        below = F.lit(0) if t.lo is None else F.count_if(F.col(t.column) < F.lit(t.lo))
        between = t.holds()
        for end in (t.lo, t.hi):
            if end is not None:
                between = between & (F.col(t.column) != F.lit(end))
        checks += [
            below.cast("bigint").alias(f"b{i}"),
            F.count_if(t.holds()).alias(f"i{i}"),
            F.count_if(between).alias(f"s{i}"),
        ]
    row = table.agg(*checks).first()
    for i, t in enumerate(targets):
        below, inside = row[f"b{i}"], row[f"i{i}"]
        if below <= t.first and t.second < below + inside:
            t.below, t.inside, t.between, t.widen = below, inside, row[f"s{i}"], 1.0
        else:  # an unlucky sample: keep the old bracket and look wider next time
            t.lo, t.hi = before[i]
            t.widen *= 2.0


def _resolve(table, targets):
    """Count the few distinct values inside each bracket and step to the two ranks."""
    if not targets:
        return
    marked = F.array(
        *[F.when(t.holds(), F.struct(F.lit(i).alias("t"), F.col(t.column).alias("v"))) for i, t in enumerate(targets)]
    )
    hits = table.select(F.explode(F.filter(marked, lambda m: m.isNotNull())).alias("m"))
    found = {}
    for i, value, n in hits.groupBy("m.t", "m.v").count().collect():
        found.setdefault(i, []).append((value, n))
    for i, t in enumerate(targets):
        seen, low, high = t.below, None, None
        for value, n in sorted(found[i]):
            if low is None and seen + n > t.first:
                low = value
            if seen + n > t.second:
                high = value
                break
            seen += n
        t.answer = low + t.fraction * (high - low)
