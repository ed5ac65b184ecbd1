"""Column roles of a panel and training matrices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

TASKS = {"regression": "target_t_plus_", "classification": "direction_t_plus_"}


@dataclass(frozen=True)
class Roles:
    date: str
    target: str
    groups: list[str]
    ids: list[str]
    numeric: list[str]
    categorical: list[str]

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical


def infer_roles(
    panel: DataFrame,
    date: str = "date_id",
    target: str = "price_rice",
    groups: Sequence[str] = ("region_id", "rice_id"),
    as_category: Sequence[str] = (),
) -> Roles:
    """Roles by declared type; ids, targets and the latest flag are never features.

    ``as_category`` names number columns that stand for categories.
    """
    ids = [date, *groups]
    taken = {*ids, target, "row_is_latest"}
    numeric, categorical = [], []
    for f in panel.schema.fields:
        if f.name in taken or f.name.startswith(tuple(TASKS.values())):
            continue
        if isinstance(f.dataType, T.StringType) or f.name in as_category:
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(f.name)
    return Roles(date, target, list(groups), ids, numeric, categorical)


def label_name(task: str, horizon: int) -> str:
    task = task.strip().lower()
    if task not in TASKS:
        raise ValueError("task must be 'regression' or 'classification'")
    return f"{TASKS[task]}{horizon}"


def training_matrix(
    panel: DataFrame, horizon: int, task: str = "regression", roles: Roles | None = None
) -> DataFrame:
    """Ids, features and label of all rows whose label is known.

    The month stays in the row, so folds can never point at the wrong rows.
    """
    label = label_name(task, horizon)
    roles = roles or infer_roles(panel)
    return panel.select(*roles.ids, *roles.features, label).na.drop(subset=[label])


def align_columns(df: DataFrame, columns: Sequence[str], dtypes: dict[str, str] | None = None) -> DataFrame:
    """Exactly ``columns``: missing ones become null, others are dropped."""
    dtypes = dtypes or {}
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast(dtypes.get(c, "double")).alias(c)
            for c in columns
        ]
    )
