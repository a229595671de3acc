"""Decision trees of Spark's ML library as column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_LINE = re.compile(r"\s*(?:(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+))")


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: Leaf | Split
    high: Leaf | Split


def parsed(model) -> Leaf | Split:
    """A tree from the text form of a fitted tree model."""
    lines = iter([m for m in map(_LINE.fullmatch, model.toDebugString.splitlines()) if m])

    def node() -> Leaf | Split:
        line = next(lines)
        if line[5]:
            return Leaf(float(line[5]))
        low = node()
        next(lines)  # the other branch repeats the condition, turned round
        return Split(int(line[2]), float(line[4]), low, node())

    return node()


def value(tree: Leaf | Split, features: list[Column]) -> Column:
    """The tree's prediction."""
    if isinstance(tree, Leaf):
        return F.lit(tree.value)
    low, high = (value(child, features) for child in (tree.low, tree.high))
    return F.when(features[tree.feature] <= tree.threshold, low).otherwise(high)


Condition = tuple[int, bool, float]


def rules(tree: Leaf | Split, path: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """Conditions (feature, above, threshold) from the root to every node below it."""
    found = [path] if path else []
    if isinstance(tree, Split):
        for child, above in ((tree.low, False), (tree.high, True)):
            found += rules(child, (*path, (tree.feature, above, tree.threshold)))
    return found


def shortened(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The same rule with the tightest condition per feature and side, in order."""
    tightest: dict[tuple[int, bool], float] = {}
    for feature, above, threshold in path:
        key = feature, above
        best = max if above else min
        tightest[key] = best(tightest.get(key, threshold), threshold)
    return tuple((f, above, t) for (f, above), t in sorted(tightest.items()))


def holds(rule: tuple[Condition, ...], features: list[Column]) -> Column:
    """Whether all of a rule's conditions hold."""
    held = F.lit(True)
    for feature, above, threshold in rule:
        column = features[feature]
        held = held & (column > threshold if above else column <= threshold)
    return held
