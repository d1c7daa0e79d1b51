"""Labelled rows to learn from, and the small fits that run on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import held_out

#: Most labelled rows of a class that a fit uses.
MAX_FIT = 10_000


def labelled_ids(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``fit_id, y``: every row to learn a label from.  Held-out ids, null ids, and labels
    other than 0 and 1 are left out; an id is used once (its largest label)."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    return rows.groupBy(F.col(id_col).alias("fit_id")).agg(F.max(label).cast("int").alias("y"))


def fit_rows(labels: DataFrame, label: str, id_col: str = "doc_id", max_rows: int = MAX_FIT) -> DataFrame:
    """``fit_id, y, weight``: the rows to learn a label from, at most ``max_rows``
    of each class, those of the smallest hashes of the id; ``weight`` is how many
    rows of its class each stands for.  Held-out ids, null ids, and labels other
    than 0 and 1 are left out; an id is used once (its largest label)."""
    rows = labelled_ids(labels, label, id_col)
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    some = None
    for y in (0, 1):
        weight = max(1.0, sizes.get(y, 0) / max_rows)
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("fit_id"), "fit_id").limit(max_rows).withColumn("weight", F.lit(weight))
        some = part if some is None else some.unionByName(part)
    return some


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
