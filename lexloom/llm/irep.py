"""Ordered rule lists by incremental reduced-error pruning (IREP), on numeric features.

Classes are taken from the rarest to the most frequent; the most frequent is the default.
For each class, rules are grown on two thirds of the rows that no rule covers yet (adding
the condition of highest information gain), pruned on the other third (dropping final
conditions while (p - n) / (p + n) rises) and kept if they are precise enough; a class ends after
several rejected rules in a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v >= self.threshold if self.above else v < self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    label: str

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        ok = np.ones(len(x), dtype=bool)
        for c in self.conditions:
            ok &= c.holds(x, names)
        return ok


@dataclass(frozen=True)
class RuleList:
    rules: tuple[Rule, ...]
    default: str

    def predict(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.full(len(x), self.default, dtype=object)
        free = np.ones(len(x), dtype=bool)
        for r in self.rules:
            hit = free & r.holds(x, names)
            out[hit] = r.label
            free &= ~hit
        return out

    def column(self, row):
        """The list as one CASE expression over the fields of a struct column."""
        from pyspark.sql import functions as F

        out = None
        for r in self.rules:
            test = F.lit(True)
            for c in r.conditions:
                v = row[c.feature]
                test = test & ((v >= F.lit(c.threshold)) if c.above else (v < F.lit(c.threshold)))
            out = F.when(test, F.lit(r.label)) if out is None else out.when(test, F.lit(r.label))
        return F.lit(self.default) if out is None else out.otherwise(F.lit(self.default))


def _cuts(v: np.ndarray, most: int) -> np.ndarray:
    """Thresholds half-way between neighbouring values, at most ``most`` of them by rank."""
    u = np.unique(v)
    mid = (u[1:] + u[:-1]) / 2
    if len(mid) > most:
        mid = mid[np.linspace(0, len(mid) - 1, most).astype(int)]
    return mid


def _best_condition(x, y, names, cover, cuts):
    """The condition that raises FOIL's information gain most on the covered rows."""
    p0, n0 = int((cover & y).sum()), int((cover & ~y).sum())
    if not p0 or not n0:
        return None
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    pos, neg = x[cover & y], x[cover & ~y]
    for j, name in enumerate(names):
        if not len(cuts[j]):
            continue
        sp, sn = np.sort(pos[:, j]), np.sort(neg[:, j])
        p_low = np.searchsorted(sp, cuts[j], side="left")
        n_low = np.searchsorted(sn, cuts[j], side="left")
        for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -1.0)
            k = int(np.argmax(g))
            if g[k] > gain:
                gain, best = float(g[k]), Condition(name, above, float(cuts[j][k]))
    return best


def _prune(conditions, x, y, names):
    def worth(cs):
        hit = Rule(tuple(cs), "").holds(x, names)
        p, n = int((hit & y).sum()), int((hit & ~y).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = list(conditions)
    while len(best) > 1 and worth(best[:-1]) > worth(best):
        best.pop()
    return best, worth(best)


def _one_rule(x, target, names, cuts, free, rng, max_conditions):
    """Grow and prune one rule on a fresh split of the free rows; None if it is not worth keeping."""
    rows = rng.permutation(np.flatnonzero(free))
    # every third row of each side prunes, so that a rare class is on both sides
    side = np.zeros(len(x), dtype=bool)
    for part in (rows[target[rows]], rows[~target[rows]]):
        side[part[2::3]] = True
    grow, prune = free & ~side, free & side
    cover, conditions = grow.copy(), []
    while (cover & ~target).any() and len(conditions) < max_conditions:
        c = _best_condition(x, target, names, cover, cuts)
        if c is None:
            break
        conditions.append(c)
        cover &= c.holds(x, names)
    if not conditions:
        return None
    if (prune & target).any():
        conditions, value = _prune(conditions, x[prune], target[prune], names)
        if value <= 0:
            return None
    return tuple(conditions)


def _fit_once(x, labels, names, cuts, order, seed, max_conditions, least_precision, tries):
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    free = np.ones(len(x), dtype=bool)
    for kind in order[:-1]:
        target = labels == kind
        left = tries
        while left and (free & target).any():
            conditions = _one_rule(x, target, names, cuts, free, rng, max_conditions)
            rule = Rule(conditions, str(kind)) if conditions else None
            hit = free & rule.holds(x, names) if rule else np.zeros(len(x), dtype=bool)
            right = int((hit & target).sum())
            if not right or right < least_precision * hit.sum():
                left -= 1
                continue
            left = tries
            rules.append(rule)
            free &= ~hit
    return RuleList(tuple(rules), str(order[-1]))


def fit(
    x: np.ndarray,
    labels: np.ndarray,
    names: list[str],
    *,
    seeds: int = 8,
    max_conditions: int = 6,
    max_cuts: int = 200,
    least_precision: float = 0.9,
    tries: int = 4,
) -> RuleList:
    """Fit a rule list; of ``seeds`` random splits the one with the fewest errors is taken.

    A rule is kept if at least ``least_precision`` of the free rows it covers have its
    label; after ``tries`` rejected rules in a row the class is done. NaN must have been
    replaced before; ties break by feature order and by seed. No rows give an empty list.
    """
    x = np.asarray(x, dtype=float)
    labels = np.asarray(labels, dtype=object)
    kinds, counts = np.unique(labels.astype(str), return_counts=True)
    if not len(kinds):
        return RuleList((), "")
    order = [k for _, k in sorted(zip(counts, kinds))]
    cuts = [_cuts(x[:, j], max_cuts) for j in range(x.shape[1])]
    best, least = None, None
    for seed in range(seeds):
        r = _fit_once(x, labels, names, cuts, order, seed, max_conditions, least_precision, tries)
        cost = (int((r.predict(x, names) != labels).sum()), sum(len(q.conditions) for q in r.rules))
        if least is None or cost < least:
            best, least = r, cost
    return best
