"""Forests, boosted trees and their parameter search, for all folds in one job.

A fold is 273 rows at most, so its models are trained where the rows are: one shuffle
brings the folds together and every task trains those it holds. The number of Spark jobs
depends neither on the folds nor on the trees, and nothing passes through the driver.

Trees grow level by level over binned features. All trees of a fold (a forest's, or one round
of all models of a search) grow at once: a level is one histogram of (node, feature,
bin) sums, from which each node takes its best split. ``sum(g)^2 / (sum(h) + penalty)`` is the
score of a node in both kinds: with labels and weights it orders splits like the Gini
impurity, with gradients and Hessians it is second-order boosting.

Random choices (bootstrap weights, features of a node or tree, rows of a round) are hashes of row,
tree and node numbers: equal wherever a fold is trained, and again after a lost task.
"""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BINS = 64


@dataclass(frozen=True)
class Forest:
    """Fixed values from the reference: trees, depth, smallest leaf. Features of a node: the root of their number."""

    trees: int = 100
    depth: int = 10
    least_rows: int = 5
    seed: int = 42


@dataclass(frozen=True)
class Boosted:
    """Fixed values from the reference (rounds, depth, rate) and the usual defaults of second-order boosting."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    rows: float = 1.0            # share of rows in a round
    features: float = 1.0        # share of features of a tree
    least_weight: float = 1.0    # Hessian sum of a leaf
    least_gain: float = 0.0
    penalty: float = 1.0
    seed: int = 42


def draw(rng: random.Random) -> Boosted:
    """One draw over the reference's search space (fixed ranges)."""
    return Boosted(rounds=rng.randint(50, 300), depth=rng.randint(3, 10), rate=float(10 ** rng.uniform(-2, np.log10(0.3))),
                   rows=rng.uniform(0.6, 1.0), features=rng.uniform(0.6, 1.0), least_weight=float(rng.randint(1, 10)),
                   least_gain=rng.uniform(0.0, 5.0))


def uniform(seed: int, *parts) -> np.ndarray:
    """Numbers in [0, 1) that depend on integers (arrays broadcast) alone."""
    x = np.uint64(seed)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


def bootstrap(seed: int, rows: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of (row, tree)."""
    return np.searchsorted(_POISSON, uniform(seed, rows, trees), side="right")


def cut_points(X: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of each feature: midways between neighbouring values, thinned to ``bins - 1`` by rank."""
    out = []
    for col in X.T:
        v = np.unique(col)
        mid = (v[1:] + v[:-1]) / 2
        if len(mid) >= bins:
            rank = np.searchsorted(np.sort(col), mid)       # values below each cut
            want = len(col) * np.arange(1, bins) / bins
            mid = np.unique(mid[np.clip(np.searchsorted(rank, want), 0, len(mid) - 1)])
        out.append(mid)
    return out


def binned(X: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: bin ``b`` lies above ``b`` cuts (equal values stay below)."""
    return np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, X.T)], 1).astype(np.int64)


@dataclass
class Grown:
    """Nodes of trees in breadth-first order: ``tree``, heap number ``node`` (root 1), ``feature`` (-1: leaf), the
    ``cut``'s index and the ``value`` of leaves; ``leaf`` is the value that every slot ends at."""

    leaf: np.ndarray
    levels: list[tuple]

    @property
    def nodes(self) -> pd.DataFrame:
        names = ["tree", "node", "feature", "cut", "value"]
        return pd.DataFrame({n: np.concatenate([x[i] for x in self.levels]) if self.levels else [] for i, n in enumerate(names)})


def grow(codes: np.ndarray, row: np.ndarray, tree: np.ndarray, g: np.ndarray, h: np.ndarray, counts: np.ndarray, *,
         depth, least_rows=1, least_weight=0.0, least_gain=0.0, penalty=0.0, chosen=None) -> Grown:
    """Grows trees ``0 .. max(tree)`` over slots (a row in a tree) with sums ``g``, ``h`` and row counts.

    Slots with count 0 follow the splits and do not take part. ``depth``, ``least_weight`` and
    ``least_gain`` may differ by tree. ``chosen(tree, node)`` names the features (k) of nodes.
    """
    p, bins = codes.shape[1], int(codes.max(initial=0)) + 1
    trees = int(tree.max(initial=-1)) + 1
    per_tree = lambda v: np.broadcast_to(np.asarray(v, float), (trees,))
    depth, least_weight, least_gain = per_tree(depth), per_tree(least_weight), per_tree(least_gain)
    leaf = np.zeros(len(row))
    slot, at = np.arange(len(row)), tree.astype(np.int64)       # open slots and their node among the open ones
    owner, name = np.arange(trees), np.ones(trees, np.int64)    # tree and heap number of the open nodes
    table = []
    level = 0
    while len(owner):
        n = len(owner)
        live = counts[slot] > 0
        G, H, C = (np.bincount(at[live], x[slot[live]], n) for x in (g, h, counts))
        score = G * G / np.maximum(H + penalty, 1e-300)
        best = np.full(n, -1)
        feature = np.full(n, -1)
        cut = np.full(n, -1)
        can = np.flatnonzero((level < depth[owner]) & (C >= 2 * least_rows) & (H >= 2 * least_weight[owner]))
        if len(can) and bins > 1:
            rank = np.full(n, -1)
            rank[can] = np.arange(len(can))
            some = live & (rank[at] >= 0)
            node, rows = rank[at[some]], slot[some]
            columns = np.broadcast_to(np.arange(p), (len(can), p)) if chosen is None else chosen(owner[can], name[can])
            k = columns.shape[1]
            place = ((node * k)[:, None] + np.arange(k)) * bins + np.take_along_axis(codes[row[rows]], columns[node], 1)
            sums = [np.bincount(place.ravel(), np.repeat(x[rows], k), len(can) * k * bins)
                    .reshape(len(can), k, bins).cumsum(2)[:, :, :-1] for x in (g, h, counts)]
            left = [s for s in sums]
            right = [t[can][:, None, None] - s for t, s in zip((G, H, C), sums)]
            tiny = 1e-300
            gain = left[0] ** 2 / np.maximum(left[1] + penalty, tiny) + right[0] ** 2 / np.maximum(right[1] + penalty, tiny)
            gain -= score[can][:, None, None]
            fit = (np.minimum(left[2], right[2]) >= least_rows) & (
                np.minimum(left[1], right[1]) >= np.maximum(least_weight[owner[can]], 1e-12)[:, None, None])
            gain = np.where(fit, gain, -np.inf).reshape(len(can), -1)
            value = gain.max(1)
            # of equal gains (up to rounding) the first feature and cut
            top = (gain >= (value - 1e-9 * (1 + np.maximum(value, 0)))[:, None]).argmax(1)
            split = value > np.maximum(2 * least_gain[owner[can]], 1e-9)
            which = can[split]
            best[which] = np.arange(len(which))
            feature[which] = columns[split, top[split] // (bins - 1)]
            cut[which] = top[split] % (bins - 1)
        value = G / np.maximum(H + penalty, 1e-300) * (H > 0)
        table.append((owner, name, feature, cut, value))
        ends = best[at] < 0
        leaf[slot[ends]] = value[at[ends]]
        slot, at = slot[~ends], at[~ends]
        over = codes[row[slot], feature[at]] > cut[at]
        kids = np.flatnonzero(best >= 0)
        owner, name = np.repeat(owner[kids], 2), np.stack([2 * name[kids], 2 * name[kids] + 1], 1).ravel()
        at = 2 * best[at] + over
        level += 1
    return Grown(leaf, table)


def forest(codes: np.ndarray, y: np.ndarray, train: np.ndarray, number: np.ndarray, p: Forest = Forest()) -> tuple[np.ndarray, pd.DataFrame]:
    """Mean leaf share of label 1 for every row, and the trees. ``number`` names rows in the bootstrap."""
    n, features = codes.shape
    row = np.tile(np.arange(n), p.trees)
    tree = np.repeat(np.arange(p.trees), n)
    weight = bootstrap(p.seed, number[row], tree) * train[row]
    k = max(1, int(np.sqrt(features)))

    def chosen(tree, node):
        u = uniform(p.seed + 1, tree[:, None], node[:, None], np.arange(features))
        return np.sort(np.argsort(u, axis=1, kind="stable")[:, :k], axis=1)

    grown = grow(codes, row, tree, weight * y[row], weight.astype(float), (weight > 0).astype(float),
                 depth=p.depth, least_rows=p.least_rows, chosen=chosen)
    # trees whose bootstrap holds no row take no part
    used = np.bincount(tree, weight, p.trees) > 0
    return (grown.leaf.reshape(p.trees, n) * used[:, None]).sum(0) / max(1, used.sum()), grown.nodes[used[grown.nodes.tree]]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def boost(codes: np.ndarray, y: np.ndarray, train: np.ndarray, number: np.ndarray, models: list[Boosted], first: int, last: int,
          margin: np.ndarray | None = None, keep: list | None = None) -> np.ndarray:
    """Margins (models, rows) after rounds ``first .. last - 1`` of every model; a model stops at its own number of rounds.

    ``keep`` collects (model, round, nodes) of the trees.
    """
    n, features = codes.shape
    margin = np.zeros((len(models), n)) if margin is None else margin.copy()
    share = np.array([m.features for m in models])
    for t in range(first, last):
        active = [k for k, m in enumerate(models) if t < m.rounds]
        if not active:
            break
        seeds = np.array([models[k].seed for k in active])
        prob = sigmoid(margin[active])
        part = train[None, :] & (uniform(7, seeds[:, None], t, number[None, :]) < np.array([models[k].rows for k in active])[:, None])
        g, h = ((y - prob) * part).ravel(), (prob * (1 - prob) * part).ravel()
        chosen = None
        if (share[active] < 1).any():
            u = uniform(11, seeds[:, None], t, np.arange(features)[None, :])
            # a tree's features by rank; a smaller share repeats the first ones
            order = np.argsort(u, axis=1, kind="stable")
            size = np.maximum(1, (share[active] * features).astype(int))
            order = np.where(np.arange(features) < size[:, None], order, order[:, :1])[:, :size.max()]
            chosen = lambda tree, node, order=order: order[tree]
        pick = lambda name: np.array([getattr(models[k], name) for k in active])
        grown = grow(codes, np.tile(np.arange(n), len(active)), np.repeat(np.arange(len(active)), n), g, h, part.ravel().astype(float),
                     depth=pick("depth"), least_weight=pick("least_weight"), least_gain=pick("least_gain"),
                     penalty=models[active[0]].penalty, chosen=chosen)
        margin[active] += pick("rate")[:, None] * grown.leaf.reshape(len(active), n)
        if keep is not None:
            nodes = grown.nodes
            keep += [(k, t, nodes[nodes.tree == i]) for i, k in enumerate(active)]
    return margin


def f1_score(y: np.ndarray, pred: np.ndarray) -> np.ndarray:
    """F1 along the last axis (0 without a hit)."""
    tp = (pred & (y == 1)).sum(-1)
    return np.where(tp > 0, 2 * tp / np.maximum(1, pred.sum(-1) + (y == 1).sum(-1)), 0.0)


def halving(codes: np.ndarray, y: np.ndarray, fit: np.ndarray, tail: np.ndarray, number: np.ndarray, models: list[Boosted],
            keep_share: int = 3) -> tuple[int, float]:
    """(number of the best model, its F1 on the tail) by successive halving.

    Every rung multiplies the share of a model's rounds by ``keep_share`` and keeps the best
    one of ``keep_share`` models; the last rung runs all rounds. Models are fitted on ``fit`` rows and
    only ever scored on ``tail`` rows. Ties go to the lower log-loss, then to the earlier draw.
    """
    alive = np.arange(len(models))
    rungs = 0
    while keep_share ** rungs < len(models):
        rungs += 1
    margin = np.zeros((len(models), len(y)))
    done = 0
    for rung in range(rungs + 1):
        share = keep_share ** (rung - rungs)
        staged = [replace(models[k], rounds=max(1, round(models[k].rounds * share))) for k in alive]
        # a model goes on from its last rung: rounds it has done are not done again
        start = [0 if rung == 0 else max(1, round(models[k].rounds * share / keep_share)) for k in alive]
        margin[alive] = _resumed(codes, y, fit, number, staged, start, margin[alive])
        m = margin[alive][:, tail]
        score = f1_score(y[tail], m > 0)
        loss = np.logaddexp(0, np.where(y[tail] == 1, -m, m)).mean(1)
        order = np.lexsort((alive, loss, -score))
        done = alive[order[0]], float(score[order[0]])
        alive = np.sort(alive[order[:max(1, -(-len(alive) // keep_share))]])
    return int(done[0]), done[1]


def _resumed(codes, y, fit, number, models, start, margin):
    """Rounds ``start[k] .. models[k].rounds - 1`` of each model; models of equal progress share their levels."""
    out = margin.copy()
    steps = max(m.rounds - s for m, s in zip(models, start))
    for step in range(steps):
        for t in {s + step for s, m in zip(start, models) if s + step < m.rounds}:
            mine = [k for k, s in enumerate(start) if s + step == t and t < models[k].rounds]
            out[mine] = boost(codes, y, fit, number, [models[k] for k in mine], t, t + 1, out[mine])
    return out


# ---- folds as Spark groups

def spread(rows: DataFrame, group: list[str]) -> DataFrame:
    """The rows by group over all shuffle partitions. Training costs far more than its bytes suggest, and a stated number of
    partitions is not merged by size at run time."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group)


def _schema(prepared: DataFrame, group: list[str], fields: str) -> str:
    return ", ".join([f"`{g}` {t}" for g, t in prepared.select(*group).dtypes] + [fields])


_PREDICTED = "rn long, y_true int, y_pred int, y_prob double, model string"


def _fold_arrays(pdf: pd.DataFrame, cols: list[str]):
    """Rows in time order: bins (cuts from train rows), labels, train flags, row numbers."""
    pdf = pdf.sort_values(["rn", "split"], ascending=[True, False], kind="stable")
    X, train = pdf[cols].to_numpy(float), (pdf["split"] == "train").to_numpy()
    return pdf, binned(X, cut_points(X[train])), pdf["target"].to_numpy(float), train, pdf["rn"].to_numpy(np.int64)


def _predicted(pdf, group, train, prob, model):
    test = pdf[~train]
    out = test[[*group, "rn"]].copy()
    out["y_true"] = test["target"].astype("int32")
    out["y_pred"] = (prob[~train] > 0.5).astype("int32")
    out["y_prob"] = prob[~train]
    out["model"] = model
    return out


def _grouped(prepared: DataFrame, cols: list[str], group: list[str], fields: str, work) -> DataFrame:
    """``work(rows, codes, labels, train flags, row numbers)`` of every group that has train and test rows."""
    schema = _schema(prepared, group, fields)
    names = [x.strip("`") for x in group] + [f.split()[0] for f in fields.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not 0 < (pdf["split"] == "train").sum() < len(pdf):
            return pd.DataFrame(columns=names)
        return work(*_fold_arrays(pdf, cols))[names]

    return spread(prepared.select(*group, "split", "rn", "target", *cols), group).groupBy(*group).applyInPandas(run, schema)


def forest_predictions(prepared: DataFrame, cols: list[str], group=("ticker", "fold"), p: Forest = Forest()) -> DataFrame:
    """A forest for each group, fitted on its train rows, applied to its test rows."""
    group = list(group)
    return _grouped(prepared, cols, group, _PREDICTED, lambda pdf, codes, y, train, number: _predicted(
        pdf, group, train, forest(codes, y, train, number, p)[0], "random_forest"))


def boosted_predictions(prepared: DataFrame, cols: list[str], group=("ticker", "fold"), p: Boosted = Boosted()) -> DataFrame:
    """Boosted trees for each group."""
    group = list(group)
    return _grouped(prepared, cols, group, _PREDICTED, lambda pdf, codes, y, train, number: _predicted(
        pdf, group, train, sigmoid(boost(codes, y, train, number, [p], 0, p.rounds)[0]), "xgboost"))


_FOUND = "best_draw int, best_f1 double, rounds int, depth int, rate double, rows double, features double, least_weight double, least_gain double"


def draws(trials: int = 50, seed: int = 42) -> list[Boosted]:
    rng = random.Random(seed)
    return [replace(draw(rng), seed=seed + k) for k in range(trials)]


def _tuned(codes, y, train, number, models, holdout):
    """Best draw for the train rows: fitted on the earlier ones, scored on the last ``holdout`` share."""
    own = np.flatnonzero(train)
    cut = own[min(len(own) - 1, max(1, int(np.ceil(len(own) * (1 - holdout)))))] if len(own) > 1 else own[-1] + 1
    place = np.arange(len(train))
    fit, tail = train & (place < cut), train & (place >= cut)
    if not fit.any() or not tail.any():
        return 0, 0.0
    return halving(codes, y, fit, tail, number, models)


def search(prepared: DataFrame, cols: list[str], group=("ticker", "fold"), models: list[Boosted] | None = None,
           holdout: float = 0.2) -> DataFrame:
    """The best of the drawn parameters for each group, scored on the last ``holdout`` share of its train rows."""
    group, models = list(group), models or draws()

    def work(pdf, codes, y, train, number):
        k, f1 = _tuned(codes, y, train, number, models, holdout)
        row = {**{g: pdf[g].iloc[0] for g in group}, "best_draw": k, "best_f1": f1, **asdict(models[k])}
        return pd.DataFrame([row])

    return _grouped(prepared, cols, group, _FOUND, work)


def tuned_predictions(prepared: DataFrame, cols: list[str], group=("ticker", "fold"), models: list[Boosted] | None = None,
                      holdout: float = 0.2) -> DataFrame:
    """J10 with J11: each group's boosted trees with its own best draw, fitted on all its train rows."""
    group, models = list(group), models or draws()

    def work(pdf, codes, y, train, number):
        p = models[_tuned(codes, y, train, number, models, holdout)[0]]
        return _predicted(pdf, group, train, sigmoid(boost(codes, y, train, number, [p], 0, p.rounds)[0]), "xgboost")

    return _grouped(prepared, cols, group, _PREDICTED, work)
