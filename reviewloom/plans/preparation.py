"""Raw reviews to a flat, de-duplicated, pruned table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewloom.operators.nested import flatten_json
from reviewloom.operators.quality import dedupe, drop_columns, prune_sparse
from reviewloom.session import materialize


def prepare(
    raw: DataFrame,
    keys: list[str],
    order: list[str],
    style: str = "style",
    min_non_null: int = 10_000,
) -> DataFrame:
    """Keep one row per key, flatten the attributes that occur often enough, drop sparse ones.

    Rows are de-duplicated raw, with the attributes still one text, and written once. The keys of
    the attributes are then counted, and columns are built for the frequent ones only.
    """
    placeholders = drop_columns(raw, regex=rf"^{style}_dup\d+$", only_null=True)
    unique = materialize(dedupe(placeholders, keys, order), "deduplicated")
    dense = prune_sparse(unique, f"{style}_", min_non_null)
    return flatten_json(dense, style, f"{style}_", min_non_null=min_non_null)
