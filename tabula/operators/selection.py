"""Exact order statistics of any number of groups without sorting or shuffling their rows.

A rank is closed in on by mergeable aggregates, each a scan that sends one row
per group and task:

1. A quantile sketch of every group guesses two values on either side of each
   wanted rank.
2. Counting the rows below, at, between and above the two guesses tells where
   the rank lies: at a guess (done; this settles repeated values however often
   they occur) or in an open interval, with the number of rows below it.  The
   counts are exact, so a poor guess costs a pass and never the result.
3. Intervals that still hold more than ``LIST`` values are sketched and counted
   again; each round leaves about one row in ``GRID`` / 4.
4. The values of the remaining intervals are listed, at most ``LIST`` for a rank,
   and the wanted one is picked.

The number of rounds is the logarithm of the rows to the base of some hundreds,
whatever the values' distribution.  Between passes there is a table of one row
per group, checkpointed; it is broadcast to the rows if its counted size allows
it and joined by key otherwise.  NaN is greater than all other values, as in
Spark's own order; NULLs are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.plans.strategy import cut_lineage, join_group_stats

#: Accuracy of the sketches, and points of a sketch that are read in later rounds.
ACCURACY = 10_000
GRID = 512
#: Values of an interval that are listed for one rank.
LIST = 4096
#: Groups whose state (some dozens of numbers each) may be broadcast.
FEW_GROUPS = 20_000

Rank = Callable[[Column], Column]


def _state(table: DataFrame, keys: list[str], columns: dict[str, Column], targets: int) -> tuple[DataFrame, int, int]:
    """The checkpointed state, its groups, and the largest interval that is still open."""
    state = cut_lineage(table.select(*keys, *[c.alias(name) for name, c in columns.items()]))
    seen = state.agg(F.count(F.lit(1)).alias("groups"),
                     F.max(F.greatest(F.lit(0), *[F.col(f"__size{t}") for t in range(targets)])).alias("widest")).first()
    return state, seen["groups"], seen["widest"] or 0


def select_ranks(vals: DataFrame, keys: Sequence[str], ranks: Sequence[Rank],
                 guesses: Sequence[float] | None = None, listed: int = LIST,
                 also: Mapping[str, Column] | None = None) -> DataFrame:
    """``(keys..., __n, also..., __s0, __s1, ...)``: the values at the given ranks of rows ``(keys..., __v double)``.

    A rank is a function of the group's row count (a column) that gives a place
    from 0; ``guesses`` are the shares of the rows below the ranks, if known.
    ``also`` are aggregates of ``__v`` that the first pass takes along.
    Groups without values are absent; without keys an empty table has no row.
    """
    keys, targets = list(keys), range(len(ranks))
    guesses = list(guesses) if guesses is not None else [0.5] * len(ranks)
    also = dict(also or {})
    carried = {name: F.col(name) for name in ("__n", *also)}
    rows = vals.select(*keys, "__v").where(F.col("__v").isNotNull())
    v, number = F.col("__v"), ~F.isnan("__v")

    def grouped(table: DataFrame, aggs: list[Column]) -> DataFrame:
        return table.groupBy(*keys).agg(*aggs) if keys else table.agg(*aggs)

    near = sorted({min(max(g + side * 3 / ACCURACY, 0.0), 1.0) for g in guesses for side in (-1, 1)})
    first = grouped(rows, [F.count(F.lit(1)).alias("__n"), F.count_if(number).alias("__m"),
                           F.percentile_approx(F.when(number, v), near, ACCURACY).alias("__g"),
                           *[c.alias(name) for name, c in also.items()]]).where("__n > 0")
    columns = dict(carried)
    for t, rank in enumerate(ranks):
        r = rank(F.col("__n")).cast("bigint")
        low, high = (near.index(min(max(guesses[t] + side * 3 / ACCURACY, 0.0), 1.0)) for side in (-1, 1))
        nothing = F.lit(None).cast("double")
        columns |= {f"__r{t}": r, f"__below{t}": F.lit(0).cast("bigint"), f"__lo{t}": nothing, f"__hi{t}": nothing,
                    f"__s{t}": F.when(r >= F.col("__m"), F.lit(float("nan"))),
                    f"__size{t}": F.when(r < F.col("__m"), F.col("__m")).otherwise(0),
                    f"__a{t}": F.get("__g", F.lit(low)), f"__b{t}": F.get("__g", F.lit(high))}
    state, groups, widest = _state(first, keys, columns, len(ranks))
    def to_rows(*columns: str) -> DataFrame:
        """The rows with these columns of their group's state."""
        wanted = state.select(*keys, *[f"{c}{t}" for t in targets for c in columns])
        return join_group_stats(rows, F.broadcast(wanted) if groups <= FEW_GROUPS else wanted, keys)

    def inside(t: int) -> Column:
        lo, hi = F.col(f"__lo{t}"), F.col(f"__hi{t}")
        return number & F.col(f"__s{t}").isNull() & (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))

    def summed(table: DataFrame, aggs: list[Column]) -> DataFrame:
        """One row per group: its aggregates beside its state."""
        return join_group_stats(grouped(table, aggs), state, keys)

    while widest:
        zones = to_rows("__lo", "__hi", "__s", "__a", "__b").select(*keys, *[
            F.when(inside(t), F.when(v < F.col(f"__a{t}"), 0).when(v == F.col(f"__a{t}"), 1)
                   .when(v < F.col(f"__b{t}"), 2).when(v == F.col(f"__b{t}"), 3)).alias(f"__zone{t}") for t in targets])
        counts = summed(zones, [F.count_if(F.col(f"__zone{t}") == k).alias(f"__c{k}_{t}") for t in targets for k in range(4)])
        columns = dict(carried)
        for t in targets:
            c = {k: F.col(f"__{k}{t}") for k in ("r", "below", "lo", "hi", "s", "size", "a", "b")}
            under, at_a, mid, at_b = (F.col(f"__c{k}_{t}") for k in range(4))
            place = c["r"] - c["below"]
            from_mid = under + at_a
            from_b = from_mid + mid
            above = from_b + at_b
            low, middle, high = place < under, (place >= from_mid) & (place < from_b), place >= above
            found = F.coalesce(c["s"], F.when(low | middle | high, None).when(place < from_mid, c["a"]).otherwise(c["b"]))
            columns |= {
                f"__r{t}": c["r"], f"__s{t}": found,
                f"__below{t}": c["below"] + F.when(low, 0).when(middle, from_mid).when(high, above).otherwise(0),
                f"__lo{t}": F.when(low, c["lo"]).when(middle, c["a"]).otherwise(c["b"]),
                f"__hi{t}": F.when(low, c["a"]).when(middle, c["b"]).otherwise(c["hi"]),
                f"__size{t}": F.when(found.isNotNull(), 0).when(low, under).when(middle, mid)
                .otherwise(c["size"] - above)}
        state, groups, widest = _state(counts, keys, columns, len(ranks))
        if widest <= listed:
            break
        grid = [k / GRID for k in range(GRID + 1)]
        sketches = summed(to_rows("__lo", "__hi", "__s"), [
            F.percentile_approx(F.when(inside(t), v), grid, ACCURACY).alias(f"__g{t}") for t in targets])
        columns = {c: F.col(c) for c in state.columns if c not in keys}
        for t in targets:
            at = (F.col(f"__r{t}") - F.col(f"__below{t}")) * F.lit(GRID) / F.greatest(F.col(f"__size{t}"), F.lit(1))
            columns |= {f"__a{t}": F.get(f"__g{t}", F.greatest(F.floor(at).cast("int") - 1, F.lit(0))),
                        f"__b{t}": F.get(f"__g{t}", F.least(F.ceil(at).cast("int") + 1, F.lit(GRID)))}
        state, groups, widest = _state(sketches, keys, columns, len(ranks))

    if not widest:
        return state.select(*keys, *carried, *[f"__s{t}" for t in targets])
    last = summed(to_rows("__lo", "__hi", "__s").where(reduce(or_, [inside(t) for t in targets])), [
        F.sort_array(F.collect_list(F.when(inside(t), v))).alias(f"__left{t}") for t in targets])
    last = last.select(*keys, *[F.get(f"__left{t}", (F.col(f"__r{t}") - F.col(f"__below{t}")).cast("int"))
                                .alias(f"__pick{t}") for t in targets])
    # groups that have all their ranks already have no listed rows
    done = join_group_stats(state, last, keys) if not keys else _left_join(state, last, keys)
    return done.select(*keys, *carried, *[F.coalesce(f"__s{t}", f"__pick{t}").alias(f"__s{t}") for t in targets])


def _left_join(state: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Every group of ``state`` with what was found for it, if anything; keys match null-safely."""
    side = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in found.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return state.join(side, same, "left")


def exact_quantiles(vals: DataFrame, keys: Sequence[str], probs: Sequence[float],
                    kind: str = "cont", also: Mapping[str, Column] | None = None) -> DataFrame:
    """``(keys..., __n, also..., __qs array<double>)`` of rows ``(keys..., __v double)``.

    ``cont`` interpolates between neighbouring values (R type 7), ``disc``
    takes the first value whose share of rows up to it reaches the probability.
    Groups without values are absent; without keys an empty table has no row.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    if kind == "disc":
        ranks = [lambda n, p=p: F.greatest(F.ceil(F.lit(p) * n) - 1, F.lit(0)) for p in probs]
        picked = select_ranks(vals, keys, ranks, probs, also=also)
        values = [F.col(f"__s{j}") for j in range(len(probs))]
    else:
        ranks = [rank for p in probs for rank in (lambda n, p=p: F.floor(F.lit(p) * (n - 1)),
                                                  lambda n, p=p: F.ceil(F.lit(p) * (n - 1)))]
        picked = select_ranks(vals, keys, ranks, [p for p in probs for _ in range(2)], also=also)
        values = []
        for j, p in enumerate(probs):
            lo, hi = F.col(f"__s{2 * j}"), F.col(f"__s{2 * j + 1}")
            place = F.lit(p) * (F.col("__n") - 1)
            share = place - F.floor(place)
            # equal neighbours stay as they are, infinite ones too
            values.append(F.when(lo == hi, lo).otherwise((F.lit(1.0) - share) * lo + share * hi))
    return picked.select(*keys, "__n", *(also or {}), F.array(*values).alias("__qs"))
