"""Cleaning and conformance (C1-C17): drops, dedup, null handling, casts, audits, quarantine.

Nothing here collects: audits return the offending rows as DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.joins import anti, semi
from paddock.operators.windows import best_row


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; a name that is not there is ignored."""
    return df.drop(*cols)


def project(df: DataFrame, cols: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Keep columns, optionally renamed."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in cols])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order`` (pandas ``drop_duplicates`` keeps the first;
    Spark has no file order, so the order is explicit)."""
    return best_row(df, keys, order)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop any row with a null (NaN counts as null, as in pandas ``dropna``)."""
    cols = [f for f in df.schema.fields if subset is None or f.name in subset]
    keep = None
    for f in cols:
        ok = F.col(f.name).isNotNull()
        if f.dataType.typeName() in ("double", "float"):
            ok = ok & ~F.isnan(F.col(f.name))
        keep = ok if keep is None else keep & ok
    return df if keep is None else df.where(keep)


def keep_keys_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose (composite) key is present in ``other``."""
    return semi(df, other, on)


def split_by(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of ``col`` to partition a workload by (one task group per value)."""
    return df.select(col).distinct()


def to_bool(c) -> Column:
    """Numeric to boolean, non-zero is true; NaN and null are true (pandas ``astype(bool)``)."""
    c = _c(c)
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(True)).otherwise(c.cast("double") != 0)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def fk_orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
               parent_cols: Sequence[str] | None = None) -> DataFrame:
    """C14: child rows whose foreign key has no parent. A null in the key exempts the row (SQL)."""
    parent_cols = list(parent_cols or child_cols)
    child_cols = list(child_cols)
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)])
    nonnull = child
    for c in child_cols:
        nonnull = nonnull.where(F.col(c).isNotNull())
    return anti(nonnull, p, child_cols)


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad). ``rules`` maps a reason to a condition that
    marks a row bad; ``bad`` carries the first failing reason in ``_reason``.

    The loaders skipped bad files and went on; here bad rows are kept aside with
    a reason and the load continues with the good ones.
    """
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(rules.items())):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_reason", reason)
    return tagged.where(F.col("_reason").isNull()).drop("_reason"), tagged.where(F.col("_reason").isNotNull())


def modulus_sample(df: DataFrame, id_col: str, modulus: int, remainder: int = 0) -> DataFrame:
    """C16, portable form: every row whose id is ``remainder`` modulo ``modulus``
    (``modulus=20`` keeps 5 %); deterministic in every engine."""
    return df.where(F.pmod(F.col(id_col), F.lit(modulus)) == remainder)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """C16, as ``sample(frac, random_state)``: a Bernoulli sample (count is not exact)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def distinct_pairs(df: DataFrame, cols: Sequence[str] = ("session_key", "driver_number")) -> DataFrame:
    """C17: distinct key pairs (how ``telemetrys_laps`` is built from ``laps``)."""
    return df.select(*cols).distinct()
