"""Optimizer steps as Column arithmetic.

An optimizer is written once for a single cell (weight, gradient, state), and applied either to scalar columns or to
every position of array columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Optimizer:
    """``states`` maps a state name to its first value; ``cell`` returns the new weight ``w`` and states.

    ``steps`` is the number of this step for the row, from 1.
    """

    states: Mapping[str, float] = {}

    def cell(self, w: Column, g: Column, s: Mapping[str, Column], steps: Column) -> dict[str, Column]:
        raise NotImplementedError


@dataclass(frozen=True)
class SGD(Optimizer):
    lr: float = 0.01
    momentum: float = 0.0
    dampening: float = 0.0
    nesterov: bool = False
    weight_decay: float = 0.0

    @property
    def states(self):
        return {"velocity": 0.0} if self.momentum else {}

    def cell(self, w, g, s, steps):
        if self.weight_decay:
            g = g + F.lit(self.weight_decay) * w
        if not self.momentum:
            return {"w": w - F.lit(self.lr) * g}
        velocity = F.lit(self.momentum) * s["velocity"] + F.lit(1 - self.dampening) * g
        step = g + F.lit(self.momentum) * velocity if self.nesterov else velocity
        return {"w": w - F.lit(self.lr) * step, "velocity": velocity}


@dataclass(frozen=True)
class Adam(Optimizer):
    lr: float = 0.001
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    weight_decay: float = 0.0
    amsgrad: bool = False

    @property
    def states(self):
        return {"m": 0.0, "v": 0.0, **({"v_max": 0.0} if self.amsgrad else {})}

    def cell(self, w, g, s, steps):
        m = F.lit(self.beta1) * s["m"] + F.lit(1 - self.beta1) * g
        v = F.lit(self.beta2) * s["v"] + F.lit(1 - self.beta2) * g * g
        m_hat = m / (F.lit(1.0) - F.pow(F.lit(self.beta1), steps))
        v_hat = v / (F.lit(1.0) - F.pow(F.lit(self.beta2), steps))
        out = {"m": m, "v": v}
        if self.amsgrad:
            v_hat = F.greatest(s["v_max"], v_hat)
            out["v_max"] = v_hat
        step = F.lit(self.lr) * m_hat / (F.sqrt(v_hat) + F.lit(self.eps))
        if self.weight_decay:
            step = step + F.lit(self.lr * self.weight_decay) * w
        return {"w": w - step, **out}


@dataclass(frozen=True)
class Adagrad(Optimizer):
    lr: float = 0.01
    eps: float = 1e-10
    initial: float = 0.1
    weight_decay: float = 0.0

    @property
    def states(self):
        return {"acc": self.initial}

    def cell(self, w, g, s, steps):
        if self.weight_decay:
            g = g + F.lit(self.weight_decay) * w
        acc = s["acc"] + g * g
        return {"w": w - F.lit(self.lr) * g / (F.sqrt(acc) + F.lit(self.eps)), "acc": acc}


@dataclass(frozen=True)
class FTRL(Optimizer):
    alpha: float = 0.05
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    power: float = -0.5

    @property
    def states(self):
        return {"z": 0.0, "n": 0.0}

    def cell(self, w, g, s, steps):
        n = s["n"] + g * g
        sigma = (F.pow(n, F.lit(-self.power)) - F.pow(s["n"], F.lit(-self.power))) / F.lit(self.alpha)
        z = s["z"] + g - sigma * w
        shrunk = -(z - F.signum(z) * F.lit(self.l1)) / (
            F.lit(self.l2) + (F.lit(self.beta) + F.sqrt(n)) / F.lit(self.alpha)
        )
        return {"w": F.when(F.abs(z) <= self.l1, F.lit(0.0)).otherwise(shrunk), "z": z, "n": n}


def step_scalars(df: DataFrame, optimizer: Optimizer, weight: str = "w", grad: str = "g", steps: str = "steps") -> DataFrame:
    """One step on scalar columns; state columns must exist."""
    count = F.col(steps) if steps in df.columns else F.lit(1)
    new = optimizer.cell(F.col(weight), F.col(grad), {s: F.col(s) for s in optimizer.states}, count)
    return df.withColumns({weight: new["w"], **{s: new[s] for s in optimizer.states}})


def step_arrays(
    df: DataFrame, optimizer: Optimizer, weight: str = "embedding", grad: str = "grad", steps: str = "steps"
) -> DataFrame:
    """One step on array columns; rows whose gradient is NULL stay as they are."""
    names = [weight, grad, *optimizer.states]
    cells = F.arrays_zip(*[F.col(n) for n in names])
    count = F.col(steps) if steps in df.columns else F.lit(1)

    def move(c: Column) -> Column:
        new = optimizer.cell(
            c[weight].cast("double"), c[grad].cast("double"), {s: c[s] for s in optimizer.states}, count
        )
        return F.struct(*[v.alias(k) for k, v in new.items()])

    moved = df.withColumn("_new", F.when(F.col(grad).isNotNull(), F.transform(cells, move)))
    weights = F.col("_new.w").cast(df.schema[weight].dataType)
    out = {weight: F.coalesce(weights, F.col(weight))}
    out.update({s: F.coalesce(F.col(f"_new.{s}"), F.col(s)) for s in optimizer.states})
    return moved.withColumns(out).drop("_new")


def zero_share(df: DataFrame, weight: str) -> DataFrame:
    """Share of weights that are exactly zero."""
    return df.agg(F.avg(F.when(F.col(weight) == 0, 1.0).otherwise(0.0)).alias("sparsity"), F.count("*").alias("weights"))
