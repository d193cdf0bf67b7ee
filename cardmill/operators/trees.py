"""Fitted trees as tables of nodes: scores as generated code (M3, M5) and SHAP values (M6).

A score is one column expression, a CASE per inner node, so scoring needs no vectors and no model
objects and stays in generated code. SHAP values follow the path-dependent definition: what a feature is
worth is its mean gain over all orders in which features become known, and a split on an unknown
feature counts both sides by the training rows they covered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.operators.evaluation import labelled
from cardmill.operators.sampling import seeded_sample

NODES = (
    "tree int, weight double, node int, feature int, threshold double, left int, right int, value double, cover double"
)
#: How a member's sum becomes a score. A boosted member of MLlib counts its sum twice.
LINKS = {"mean": "{}", "logistic": "1D / (1D + EXP(-2D * {}))", "sigmoid": "1D / (1D + EXP(-1D * {}))"}
#: Distinct features of a path up to which all combinations of known sides are tabled.
TABLED = 10


@dataclass(frozen=True)
class Tree:
    """Nodes by position, the root first; ``feature`` is -1 in a leaf. At most the threshold goes left."""

    weight: float
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    cover: list[float]


@dataclass(frozen=True)
class Path:
    """A leaf: its value, and for each feature on the way the interval and the share of rows kept."""

    value: float
    features: list[int]
    above: list[float]
    up_to: list[float]
    share: list[float]


@dataclass(frozen=True)
class TreeSet:
    """A member: weighted trees over named features and how their sum becomes a score."""

    names: list[str]
    trees: list[Tree]
    link: str = "mean"

    def raw(self) -> Column:
        """The weighted sum. A missing number goes right like NaN."""
        return F.expr(self._text())

    def score(self) -> Column:
        return F.expr(LINKS[self.link].format(f"({self._text()})"))

    def _text(self) -> str:
        def case(tree: Tree, node: int) -> str:
            f = tree.feature[node]
            if f < 0:
                return f"{tree.value[node]!r}D"
            left, right = case(tree, tree.left[node]), case(tree, tree.right[node])
            return f"CASE WHEN `{self.names[f]}` <= {tree.threshold[node]!r}D THEN {left} ELSE {right} END"

        return " + ".join(f"{tree.weight!r}D * {case(tree, 0)}" for tree in self.trees) or "0D"

    def paths(self) -> list[Path]:
        """All leaves, with the weight of their tree in the value."""
        out = []
        for tree in self.trees:
            todo = [(0, {})]
            while todo:
                node, known = todo.pop()
                f = tree.feature[node]
                if f < 0:
                    sides = list(known.values())
                    columns = ([s[i] for s in sides] for i in range(3))
                    out.append(Path(tree.weight * tree.value[node], list(known), *columns))
                    continue
                above, up_to, share = known.get(f, (-np.inf, np.inf, 1.0))
                for child, low, high in (
                    (tree.left[node], above, min(up_to, tree.threshold[node])),
                    (tree.right[node], max(above, tree.threshold[node]), up_to),
                ):
                    part = tree.cover[child] / tree.cover[node]
                    todo.append((child, known | {f: (low, high, share * part)}))
        return out

    def base(self) -> float:
        """The sum when no feature is known."""
        return sum(p.value * float(np.prod(p.share)) for p in self.paths())

    def write(self, spark: SparkSession, path: str) -> None:
        """One row per node."""
        rows = [
            (number, float(tree.weight), node, *[column[node] for column in _columns(tree)])
            for number, tree in enumerate(self.trees)
            for node in range(len(tree.feature))
        ]
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str, names: list[str], link: str = "mean") -> TreeSet:
        """The stored nodes; there are as many as the model has, whatever it was trained on."""
        trees: dict[int, list] = {}
        for row in spark.read.schema(NODES).parquet(path).orderBy("tree", "node").collect():
            trees.setdefault(row.tree, []).append(row)
        columns = ("feature", "threshold", "left", "right", "value", "cover")
        return cls(names, [Tree(own[0].weight, *[[r[c] for r in own] for c in columns]) for own in trees.values()], link)

    @classmethod
    def of(cls, spark: SparkSession, model, names: list[str], path: str) -> TreeSet:
        """The trees of a boosted or forest model, read from where it is saved in ``path``."""
        boosted = isinstance(model, GBTClassificationModel)
        if not boosted and not isinstance(model, RandomForestClassificationModel):
            raise TypeError(f"no trees known in {type(model).__name__}")
        model.write().overwrite().save(path)
        nodes: dict[int, list] = {}
        for row in spark.read.parquet(f"{path}/data").collect():
            nodes.setdefault(row.treeID, []).append(row.nodeData)
        weights = list(model.treeWeights)
        total = 1.0 if boosted else sum(weights)
        trees = []
        for number in sorted(nodes):
            own = sorted(nodes[number], key=lambda n: n.id)
            if any(n.split.numCategories >= 0 for n in own if n.leftChild >= 0):
                raise ValueError("a split on categories has no threshold")
            stats = [n.impurityStats for n in own]
            value = [n.prediction for n in own] if boosted else [s[1] / sum(s) for s in stats]
            cover = [s[0] for s in stats] if boosted else [sum(s) for s in stats]
            inner = [n.leftChild >= 0 for n in own]
            feature = [n.split.featureIndex if i else -1 for n, i in zip(own, inner)]
            threshold = [n.split.leftCategoriesOrThreshold[0] if i else 0.0 for n, i in zip(own, inner)]
            left, right = [n.leftChild for n in own], [n.rightChild for n in own]
            trees.append(Tree(weights[number] / total, feature, threshold, left, right, value, cover))
        return cls(names, trees, "logistic" if boosted else "mean")


def _columns(tree: Tree) -> tuple[list, ...]:
    return tree.feature, tree.threshold, tree.left, tree.right, tree.value, tree.cover


def gains(known: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What each feature of a path is worth to the rows, per unit of the leaf's value.

    ``known`` says, by row and feature, whether the row takes the path's side; ``share`` is what
    an unknown feature lets through. The product of ``share + known * x`` over the other features
    has in ``x**k`` the sum over all sets of ``k`` known ones, which count k! (n-k-1)! / n! times.
    """
    rows, n = known.shape
    order = np.array([factorial(k) * factorial(n - k - 1) / factorial(n) for k in range(n)])
    out = np.empty((rows, n))
    for f in range(n):
        others = [j for j in range(n) if j != f]
        sets = np.ones((rows, 1))
        for j in others:
            with_j = np.zeros((rows, sets.shape[1] + 1))
            with_j[:, :-1] = sets * share[j]
            with_j[:, 1:] += sets * known[:, j : j + 1]
            sets = with_j
        out[:, f] = (known[:, f] - share[f]) * (sets @ order)
    return out


class Explainer:
    """SHAP values of many rows at once; a path's values for all combinations of sides are tabled."""

    def __init__(self, member: TreeSet):
        self.width, self.paths = len(member.names), []
        for path in member.paths():
            n = len(path.features)
            table = None
            if 0 < n <= TABLED:
                sides = (np.arange(2**n)[:, None] >> np.arange(n)) & 1
                table = path.value * gains(sides.astype(float), np.array(path.share))
            self.paths.append((path, table))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.where(np.isnan(x), np.inf, x)
        out = np.zeros((len(x), self.width))
        for path, table in self.paths:
            if not path.features:
                continue
            own = x[:, path.features]
            known = (own > np.array(path.above)) & (own <= np.array(path.up_to))
            if table is None:
                out[:, path.features] += path.value * gains(known.astype(float), np.array(path.share))
            else:
                out[:, path.features] += table[known @ (1 << np.arange(len(path.features)))]
        return out


def shap_values(rows: DataFrame, members: list[TreeSet], keep: list[str]) -> DataFrame:
    """``keep``, ``base_value`` and ``shap_<feature>``: the mean of the members' SHAP values.

    They add up to the mean of the members' raw sums. Missing numbers go right like NaN. Rows are
    explained batch by batch where they are; only the trees are sent.
    """
    names = members[0].names
    base = sum(m.base() for m in members) / len(members)
    fields = [rows.schema[k] for k in keep] + [T.StructField(f"shap_{n}", T.DoubleType()) for n in names]

    def explained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        explainers = [Explainer(m) for m in members]
        for batch in batches:
            x = batch[[f"_x{i}" for i in range(len(names))]].to_numpy(float)
            values = sum(e(x) for e in explainers) / len(explainers)
            yield pd.concat(
                [batch[keep], pd.DataFrame(values, columns=[f"shap_{n}" for n in names], index=batch.index)], axis=1
            )

    inputs = rows.select(*keep, *[F.col(n).cast("double").alias(f"_x{i}") for i, n in enumerate(names)])
    out = inputs.mapInPandas(explained, T.StructType(fields))
    return out.withColumn("base_value", F.lit(float(base)))


def shap_importance(
    dataset: DataFrame, members: list[TreeSet], key: str = "TransactionID", sample_size: int = 2000, seed: int = 42
) -> DataFrame:
    """M6: features ranked by their mean absolute SHAP value over a seeded sample."""
    names = members[0].names
    sample = seeded_sample(dataset.select(key, *names), key, sample_size, seed)
    values = shap_values(sample, members, [key])
    means = values.agg(*[F.avg(F.abs(f"shap_{n}")).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names])
    return means.select(F.inline(pairs)).orderBy(F.desc("importance"), "feature")


@dataclass
class CompiledEnsemble:
    """M3: the blend of two members as column expressions; takes the place of a fitted ensemble."""

    boosted: TreeSet
    second: TreeSet
    boosted_weight: float = 0.5
    second_weight: float = 0.5
    threshold: float = 0.5

    @property
    def feature_names(self) -> list[str]:
        return self.boosted.names

    @property
    def members(self) -> list[TreeSet]:
        return [self.boosted, self.second]

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``boosted_score``, ``second_score`` and the blended ``fraud_score``."""
        both = df.select("*", self.boosted.score().alias("boosted_score"), self.second.score().alias("second_score"))
        weights = {"boosted_score": self.boosted_weight, "second_score": self.second_weight}
        parts = [F.lit(float(w)) * F.col(name) for name, w in weights.items()]
        return both.withColumn("fraud_score", reduce(lambda a, b: a + b, parts))

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """M4: add the label at the tuned threshold, or at another one."""
        cut = self.threshold if threshold is None else threshold
        return self.score(df).withColumn("prediction", labelled(F.col("fraud_score"), cut))
