"""Prepare-only entry point: load, audit, clean, encode, assign folds.

This is the base every later stage reads. The fold-assigned modeling table is
written once to the shared checkpoint folder, so every later job (IG per fold,
boosting levels, metrics) reads a stable, lineage-free input.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.operators.audit import clean_dataset, without_missing
from cvforge.operators.encode import EncodedTable, encode_features, split_features_target
from cvforge.operators.split import assign_folds, distinct_in_fold_order, ntile_of
from cvforge.plans.datasets import Binding
from cvforge.session import write_shared


@dataclass
class Prepared:
    binding: Binding
    clean: DataFrame
    encoded: EncodedTable
    folded: DataFrame  # keys, row_id, encoded features, target code, fold
    k: int
    cleaned: bool = True

    @property
    def features(self) -> list[str]:
        return self.encoded.features

    @property
    def target(self) -> str:
        return self.binding.spec.target

    @property
    def n_classes(self) -> int:
        return len(self.encoded.target.classes)

    @property
    def nullable(self) -> list[str]:
        """Encoded features that may hold missing values (IG imputes them per fold)."""
        if self.cleaned:
            return list(self.encoded.coerced)
        return [enc for _, enc, src_role, _, _ in self.encoded.role_rows if src_role == "numeric"]

    def roles(self) -> dict[str, str]:
        return {enc: role for _, enc, _, role, _ in self.encoded.role_rows}


def prepare(binding: Binding, k: int = 10, seed: int = 42, clean: bool = True, materialize: bool = False) -> Prepared:
    """Clean, validate, encode and assign folds.

    With ``materialize`` the validation queries (null target, classes, unknown categories, nominal
    domains) read the rows without missing values, where copies change nothing; then one shuffle
    drops copies and brings the rows in fold order, and the cleaned table is written once to the
    shared folder (as Parquet, so readers scan only their columns) in that order. If many rows share
    their key, or without cleaning, the cleaned table and the rows in fold order are written one after the other.
    """
    raw = binding.raw
    spec = binding.spec
    if clean and materialize:
        kept = without_missing(raw)
        encoded = encode_features(kept, spec, split_features_target(kept, spec.target, spec.exclude))
        ties = encoded.columns[len(encoded.key_cols) :]
        if found := distinct_in_fold_order(kept, spec.key_cols, ties, seed):
            rows, cleaned = found
            encoded = replace(encoded, df=cleaned.select(*encoded.columns))
            fold = ntile_of(F.col("_row_id"), F.col("_total"), k)
            folded = rows.select(*encoded.columns, F.col("_row_id").alias("row_id"), fold.alias("fold"))
            return Prepared(binding, cleaned, encoded, folded, k, clean)
    cleaned = clean_dataset(raw) if clean else raw
    if materialize:
        cleaned = write_shared(cleaned, "clean")
    features = split_features_target(cleaned, spec.target, spec.exclude)
    encoded = encode_features(cleaned, spec, features)
    folded = assign_folds(encoded.df, spec.key_cols, k=k, seed=seed)
    return Prepared(binding, cleaned, encoded, folded, k, clean)
