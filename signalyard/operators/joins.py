"""Joins: JN1-JN7.

Nothing here looks at sizes: a plain equi-join lets Spark broadcast a side
that is small (by the size of its files, or by what its stage wrote) and
split a day that holds a third of all rows (AQE skew join).  Sides that are
one or a few rows per day are written once by their callers
(``session.materialise``), so their size is known when the plan is made.
``salted_join`` spreads a hot key where AQE is off."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                salt: int = 16) -> DataFrame:
    """Equi-join on ``keys`` with the left side salted: each left row gets a
    salt in [0, salt) from a hash of its other columns (so that a task that is
    run again deals its rows the same way), each right row is copied once per
    salt value.  Only valid for ``inner`` and ``left`` joins (right rows are
    replicated, so a right/full join would duplicate unmatched rights)."""
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins only")
    if salt <= 1:
        return left.join(right, keys, how)
    l2 = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
    r2 = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return l2.join(r2, keys + ["_salt"], how).drop("_salt")


def join_on_dates(left: DataFrame, right: DataFrame, keys=("date_start", "date_end"),
                  how: str = "inner") -> DataFrame:
    """JN1/JN2: equi-join two feeds on their date range."""
    return left.join(right, list(keys), how)


def full_outer_on(left: DataFrame, right: DataFrame, keys: list[str],
                  null_safe: bool = False) -> DataFrame:
    """JN3/JN5: full outer join with coalesced keys (pandas ``merge(how=
    "outer")``).  ``null_safe`` matches null with null, as pandas does for
    NaN keys."""
    lk = {k: f"_l_{k}" for k in keys}
    rk = {k: f"_r_{k}" for k in keys}
    l2 = left.select(*[F.col(c).alias(lk.get(c, c)) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(rk.get(c, c)) for c in right.columns])
    conds = [(l2[lk[k]].eqNullSafe(r2[rk[k]]) if null_safe else l2[lk[k]] == r2[rk[k]])
             for k in keys]
    j = l2.join(r2, reduce(lambda a, b: a & b, conds), "full_outer")
    others = [c for c in j.columns if c not in lk.values() and c not in rk.values()]
    return j.select(*[F.coalesce(F.col(lk[k]), F.col(rk[k])).alias(k) for k in keys], *others)


def rows_to_add(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """JN4 (FIX of Q3/Q4): rows of ``new`` whose key is not in ``existing``.
    A true left anti join, so no value columns of ``existing`` leak in and
    an empty target returns all rows.  Keys are de-duplicated first, which
    turns into a partial aggregate before the shuffle."""
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")


def replace_or_add(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """JN4 with ``on_conflict="replace"`` (Q5 option): keys present in
    ``new`` take the new rows, all other existing rows stay."""
    keep = existing.join(new.select(*keys).distinct(), keys, "left_anti")
    return keep.unionByName(new, allowMissingColumns=True)


def attach_row(df: DataFrame, one_row: DataFrame, name: str = "_m") -> DataFrame:
    """Attach the single row of ``one_row`` as struct column ``name`` via a
    scalar subquery: evaluated once, shipped to tasks as a constant, no
    join.  ``one_row`` is cut to one row, so the bound is by construction;
    an empty ``one_row`` gives a null struct."""
    s = one_row.limit(1).select(F.struct(*one_row.columns)).scalar()
    return df.withColumn(name, s)


def with_defaults(requests: DataFrame, means: DataFrame, columns: list[str]) -> DataFrame:
    """JN7/IMP4/MAP1: fill each missing input from the one-row ``means``
    frame, then 0.0 (an absent means row still yields the 0.0 defaults)."""
    j = attach_row(requests, means.select(*columns), "_m")
    return j.select(*[c for c in requests.columns if c not in columns],
                    *[F.coalesce(F.col(c).cast("double"), F.col(f"_m.{c}").cast("double"),
                                 F.lit(0.0)).alias(c) for c in columns])


def full_outer_split(big: DataFrame, small: DataFrame, keys: list[str],
                     null_safe: bool = False, big_keys: DataFrame | None = None) -> DataFrame:
    """JN3 for keys that repeat much on one side (many articles a day): ``big
    LEFT JOIN small`` plus the ``small`` rows whose key does not occur in
    ``big``.  Equal to a full outer join, which Spark cannot split on a hot
    key; the left join it can split, or broadcast, and the keys of ``big`` are
    de-duplicated before they are shuffled (``big_keys`` hands them in where
    the caller has them already)."""
    if big_keys is None:
        big_keys = big.select(*keys).distinct()
    if not null_safe:
        left = big.join(small, keys, "left")
        only_small = small.join(big_keys, keys, "left_anti")
        return left.unionByName(only_small, allowMissingColumns=True)
    rk = {k: f"_r_{k}" for k in keys}
    same = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(rk[k])) for k in keys])
    right = small.select(*[F.col(c).alias(rk.get(c, c)) for c in small.columns])
    left = big.join(right, same, "left").drop(*rk.values())
    other = big_keys.select(*[F.col(k).alias(rk[k]) for k in keys])
    return left.unionByName(small.join(other, same, "left_anti"), allowMissingColumns=True)
