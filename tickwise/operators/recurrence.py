"""Exponential means with ``adjust=False``, exact for any span and history.

    y_0 = x_0,   y_t = a * y_{t-1} + alpha * x_t,   a = 1 - alpha

The recurrence is linear, so a run of ``m`` rows maps the incoming state ``s`` to
``a^m * s + u`` where ``u`` is the run's own response from state zero. On the
``halo_blocks`` layout:

1. every (key, block) is cut into runs of ``run_rows`` positions (short enough
   that ``a^-m`` stays finite); ``u_t = a^q * sum(a^-q b)`` is a running sum inside
   the run (JVM side, no extra shuffle);
2. one row per run (its length and last response) is an affine map of the state, and maps
   compose to maps of the same form. So the runs are scanned in groups of ``FAN`` blocks from state
   zero, and the groups' maps (one row each) are scanned in groups again: a parallel
   prefix scan, in which no task gets more than the runs of ``FAN`` blocks. ``LEVELS`` levels
   hold ``block_rows * FAN ** LEVELS`` rows of a key (10^9; more levels hold more, too few raise an error);
3. on the way back each group's incoming state is carried through its members' earlier lengths, and the
   incoming states of the blocks, one row per (key, block), finish every row.

Nothing is cut off, so ratios of two means stay right even when both have
decayed to almost nothing (RSI of a suspended stock). A mean of the difference of two
means (the MACD signal) is part of the same pass: its response to the incoming states
of the two has a closed form.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.series import BLK, HOME, POS, RN

FAN = 1024
LEVELS = 2
SCALE_LOG10 = 200.0    # a^-q stays below 1e200 (values keep 1e100 of headroom)


@dataclass(frozen=True)
class Ewm:
    """Mean of column ``src``."""

    out: str
    src: str
    alpha: float

    @property
    def a(self) -> float:
        return 1.0 - self.alpha


@dataclass(frozen=True)
class Chain:
    """Mean of ``plus - minus``, both outputs of means of the same pass."""

    out: str
    plus: str
    minus: str
    alpha: float

    @property
    def a(self) -> float:
        return 1.0 - self.alpha


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def run_rows(alphas: list[float], block_rows: int) -> int:
    """Rows of a run: a divisor of ``block_rows`` for which every ``a^-m`` is finite."""
    decay = max((-math.log10(1.0 - x) for x in alphas if x < 1.0), default=0.0)
    rows = block_rows
    while rows > 1 and (rows * decay > SCALE_LOG10 or block_rows % rows):
        rows = rows // 2 if rows % 2 == 0 else 1
    return rows


def _mixed(a: float, c: float, n):
    """sum over s = 0 .. n-1 of c^(n-1-s) * a^(s+1), for a number, array or column ``n``."""
    power = F.pow if isinstance(n, Column) else np.power
    lit = F.lit if isinstance(n, Column) else float
    if abs(a - c) < 1e-12:
        return n * power(lit(a), n)
    return a * (power(lit(a), n) - power(lit(c), n)) / (a - c)


def _carried(state: dict, own: dict, n, base: list[Ewm], chains: list[Chain]) -> dict:
    """States after ``n`` rows with the responses ``own``, from the states ``state`` before (numbers or columns by output)."""
    power = F.pow if isinstance(n, Column) else np.power
    lit = F.lit if isinstance(n, Column) else float
    by_name = {s.out: s for s in base}
    out = {s.out: power(lit(s.a), n) * state[s.out] + own[s.out] for s in base}
    for c in chains:
        p, m = by_name[c.plus], by_name[c.minus]
        out[c.out] = (power(lit(c.a), n) * state[c.out] + own[c.out]
                      + c.alpha * (state[c.plus] * _mixed(p.a, c.a, n) - state[c.minus] * _mixed(m.a, c.a, n)))
    return out


def _scan(group: list[str], place: list[str], names: dict[str, str], base: list[Ewm], chains: list[Chain], last: bool):
    """Arrow-batched function over rows sorted by group and place: each row's incoming states and the length before it
    (``m``), both counted from its group's start; after a group a row of kind 1 with the group's own length and response."""
    zero = {s.out: 0.0 for s in [*base, *chains]}
    columns = list(names.values())

    def run(batches):
        current, state, length = None, zero, 0.0

        def total():
            return (*current, *[-1] * len(place), 1, length, *[state[o] for o in names])

        for pdf in batches:
            rows = []
            own = pdf[columns].to_numpy()
            for key, at, m, u in zip(pdf[group].itertuples(index=False, name=None), pdf[place].itertuples(index=False, name=None),
                                     pdf["m"].to_numpy(float), own):
                if key != current:
                    if last and key[-1]:
                        raise ValueError("a key is longer than the levels of the scan hold: pass more levels")
                    if current is not None:
                        rows.append(total())
                    current, state, length = key, zero, 0.0
                rows.append((*key, *at, 0, length, *[state[o] for o in names]))
                state = _carried(state, dict(zip(names, u)), m, base, chains)
                length += m
            yield pd.DataFrame(rows, columns=[*group, *place, "kind", "m", *columns])
        if current is not None:
            yield pd.DataFrame([total()], columns=[*group, *place, "kind", "m", *columns])

    return run


def _incoming(rows: DataFrame, key: str, place: list[str], level: int, names: dict[str, str], base: list[Ewm], chains: list[Chain],
              fan: int, levels: int) -> DataFrame:
    """``key``, ``place`` and the incoming states of rows (key, place..., m, responses), in the order of their place."""
    group = f"_group{level}"
    # the first column of a place is a number of equal parts of the key, in order
    rows = rows.withColumn(group, F.floor(F.col(place[0]) / fan).cast("long"))
    last = level == levels
    types = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in [key, group, *place]] + ["kind int, m double"] + [f"{n} double" for n in names.values()])
    scanned = (rows.repartition(key, group).sortWithinPartitions(key, group, *place)
               .mapInPandas(_scan([key, group], place, names, base, chains, last), schema))
    own = scanned.filter("kind = 0")
    if last:        # one group holds all of a key
        return own.select(key, *place, *names.values())
    totals = scanned.filter("kind = 1").select(key, group, "m", *names.values())
    starts = _incoming(totals, key, [group], level + 1, names, base, chains, fan, levels)
    return _placed(own, starts, key, group, place, names, base, chains)


def _placed(own: DataFrame, starts: DataFrame, key: str, group: str, place: list[str], names, base, chains) -> DataFrame:
    """Incoming states of a group's members: the group's incoming state carried over the rows before them."""
    starts = starts.select(key, group, *[F.col(n).alias(f"s{n}") for n in names.values()])
    both = own.join(starts, [key, group])
    state = _carried({o: F.col(f"s{n}") for o, n in names.items()}, {o: F.col(n) for o, n in names.items()}, F.col("m"), base, chains)
    return both.select(key, *place, *[state[o].alias(n) for o, n in names.items()])


def ewm_pass(d: DataFrame, specs: list[Ewm], key: str, block_rows: int,
             chains: list[Chain] | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Add one column per mean (and per chained mean) to the home rows of a ``halo_blocks`` layout.

    ``src`` and ``key`` must be non-null; halo rows get null. Any alpha in (0, 1] is fine.
    """
    chains = chains or []
    for s in [*specs, *chains]:
        if not 0.0 < s.alpha <= 1.0:
            raise ValueError(f"alpha out of range: {s.alpha}")
    rows = run_rows([s.alpha for s in [*specs, *chains]], block_rows)
    q = (F.col(POS) % rows).cast("double")
    running = (Window.partitionBy(key, BLK, HOME, "_run").orderBy(RN)
               .rowsBetween(Window.unboundedPreceding, 0))

    def response(x: Column, s) -> Column:
        if s.a == 0.0:
            return x
        b = F.when(F.col(RN) == 0, x).otherwise(F.lit(s.alpha) * x)
        return F.pow(F.lit(s.a), q) * F.sum(b * F.pow(F.lit(s.a), -q)).over(running)

    own = {s.out: f"_u_{i}" for i, s in enumerate([*specs, *chains])}
    d = d.withColumn("_run", F.floor(F.col(POS) / rows).cast("int"))
    d = d.withColumns({own[s.out]: response(F.col(s.src), s) for s in specs})
    if chains:
        d = d.withColumns({own[c.out]: response(F.col(own[c.plus]) - F.col(own[c.minus]), c) for c in chains})
    names = list(own.values())
    runs = (d.filter(F.col(HOME)).groupBy(key, BLK, "_run")
            .agg(F.count(F.lit(1)).cast("double").alias("m"), *[F.max_by(n, RN).alias(n) for n in names]))
    states = (_incoming(runs, key, [BLK, "_run"], 1, own, specs, chains, fan, levels)
              .groupBy(key, BLK)
              .agg(F.sort_array(F.collect_list(F.struct("_run", *names))).alias("_states"))
              .withColumnsRenamed({key: "_state_key", BLK: "_state_blk"}))
    # plain equality keeps the layout's partitioning (no shuffle of the rows)
    d = d.join(states, (d[key] == states["_state_key"]) & (d[BLK] == states["_state_blk"]), "left")
    state = F.element_at("_states", F.col("_run") + 1)
    cols = _carried({o: state[n] for o, n in own.items()}, {o: F.col(n) for o, n in own.items()}, q + 1.0, specs, chains)
    d = d.withColumns({k: F.when(F.col(HOME), v) for k, v in cols.items()})
    return d.drop("_run", "_states", "_state_key", "_state_blk", *names)


__all__ = ["Ewm", "Chain", "span_alpha", "run_rows", "ewm_pass"]
