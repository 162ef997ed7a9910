"""Learned decision lists: sequential covering over the statistics of labelled texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quantiles, among the rows of each label, where a statistic's thresholds are. They bound the table of counts that
#: the labelled rows, however many, come down to: 2 * 2 * 19 ** statistics cells, of which far fewer occur.
QUANTILES = (0.0, 0.005, 0.1, 0.25, 0.5, 0.75, 0.9, 0.995, 1.0)
LONGEST = 3
RULES = 12
LEAST_SHARE = 0.002
LEAST_PRECISION = 0.8


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, edge = F.col(self.statistic), F.lit(self.threshold)
        return value > edge if self.above else value <= edge

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """Rows that meet all conditions are of label 0."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class Cell:
    """Labelled rows alike in all statistics: how many of label 0 and 1, and whether they grow or prune rules."""

    bins: tuple[int, ...]
    grows: bool
    zeros: int
    ones: int


def thresholds(labelled: DataFrame, statistics: list[str]) -> dict[str, list[float]]:
    """Edges by statistic: quantiles of the rows of each label."""
    quantiles = [F.percentile_approx(s, list(QUANTILES), 10000).alias(s) for s in statistics]
    found = labelled.groupBy("label").agg(*quantiles).collect()
    return {s: sorted({float(v) for r in found for v in (r[s] or [])}) for s in statistics}


def cells(labelled: DataFrame, statistics: list[str], edges: dict[str, list[float]], key: str) -> list[Cell]:
    """The labelled rows as counts; a third of them, by a hash of the key, is there to prune."""
    bin_of = lambda s: reduce(lambda a, b: a + b, [(F.col(s) > e).cast("int") for e in edges[s]], F.lit(0))
    grows = F.pmod(F.xxhash64(F.lit(7), key), F.lit(3)) != 0
    counted = (
        labelled.select(*[bin_of(s).alias(s) for s in statistics], grows.alias("grows"), "label")
        .groupBy(*statistics, "grows")
        .agg(F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones"))
    )
    return sorted(
        (Cell(tuple(r[s] for s in statistics), r["grows"], r["zeros"], r["ones"]) for r in counted.collect()),
        key=lambda c: (c.bins, c.grows),
    )


_Test = tuple[int, bool, int]  # statistic, above, edge


def _meets(cell: Cell, tests: list[_Test]) -> bool:
    return all((cell.bins[s] > e) == above for s, above, e in tests)


def _sums(found: list[Cell]) -> tuple[int, int]:
    return sum(c.zeros for c in found), sum(c.ones for c in found)


def cover(table: list[Cell], statistics: list[str], edges: dict[str, list[float]]) -> list[Rule]:
    """Rules for label 0, one after another, each learned from the rows that those before it leave.

    A rule grows by the condition that raises its precision, with its cover as a tie's judge, on two thirds of the
    rows, and loses its last conditions as long as that does no harm on the other third. It stays if it covers enough
    and is right often enough on all; the first that does not ends the list.
    """
    import math

    rules: list[Rule] = []
    total = sum(c.zeros + c.ones for c in table)
    least = max(3, LEAST_SHARE * total)
    choices = [(s, above, e) for s, name in enumerate(statistics) for e in range(len(edges[name])) for above in (True, False)]

    def worth(found: list[Cell], base: float) -> float:
        zeros, ones = _sums(found)
        return -math.inf if not zeros else zeros * (math.log2((zeros + 0.1) / (zeros + ones + 0.2)) - base)

    left = table
    while len(rules) < RULES:
        grow, prune = [c for c in left if c.grows], [c for c in left if not c.grows]
        tests: list[_Test] = []
        inside = grow
        while len(tests) < LONGEST and _sums(inside)[1]:
            zeros, ones = _sums(inside)
            if not zeros:
                break
            base = math.log2((zeros + 0.1) / (zeros + ones + 0.2))
            gain, best = max((worth([c for c in inside if _meets(c, [t])], base), t) for t in choices)
            if gain <= 1e-9:
                break
            tests.append(best)
            inside = [c for c in inside if _meets(c, [best])]
        if not tests:
            break

        def right(some: list[_Test]) -> float:
            zeros, ones = _sums([c for c in prune if _meets(c, some)])
            return (zeros - ones) / max(1, zeros + ones)

        while len(tests) > 1 and right(tests[:-1]) >= right(tests):
            tests = tests[:-1]
        zeros, ones = _sums([c for c in left if _meets(c, tests)])
        if zeros + ones < least or zeros < LEAST_PRECISION * (zeros + ones):
            break
        rules.append(Rule(tuple(Condition(statistics[s], above, edges[statistics[s]][e]) for s, above, e in tests)))
        left = [c for c in left if not _meets(c, tests)]
    return rules


def learn_rules(labelled: DataFrame, statistics: list[str], key: str) -> list[Rule]:
    """A decision list from rows with ``statistics``, ``key`` and ``label`` 0 or 1; empty without rows of label 0.

    Rows with another label, or none, or with a null or NaN statistic teach nothing. All labelled rows count: two aggregations take them to
    quantiles and to counts, whose number does not grow with theirs, and the list is found from these.
    """
    known = labelled.where(F.col("label").isin(0, 1)).dropna(subset=statistics)
    edges = thresholds(known, statistics)
    if not any(edges.values()):
        return []
    return cover(cells(known, statistics, edges, key), statistics, edges)


def verdict(rules: list[Rule], otherwise: bool = True) -> Column:
    """The list as one ordered conditional expression: false where a rule fits first, else ``otherwise``."""
    if not rules:
        return F.lit(otherwise)
    first, *rest = rules
    chain = F.when(F.coalesce(first.column(), F.lit(False)), F.lit(not otherwise))
    for rule in rest:
        chain = chain.when(F.coalesce(rule.column(), F.lit(False)), F.lit(not otherwise))
    return chain.otherwise(F.lit(otherwise))
