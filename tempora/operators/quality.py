"""Declared constraints of the reference's DDL, checked on DataFrames (K9).

NOT NULL, varchar(n), UNIQUE, FOREIGN KEY and ``default now()``:

* ``apply_defaults`` fills NULLs of defaulted columns;
* ``split`` returns (accepted rows, rejected rows + reason) for an ingest
  path - a quarantine instead of a failed transaction;
* ``UniqueIngest`` appends batches to a versioned table and keeps a column's values unique across them;
* ``violations`` reports the count per check as a table.

Row checks are column expressions (one pass); UNIQUE is a partial
aggregate per key; FOREIGN KEY is a join against the referenced keys (Spark
broadcasts them only when their measured size allows).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.session import checkpointed
from tempora.sources.versioned import Conflict, Store


@dataclass
class Constraints:
    table: str
    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    unique: Sequence[str] = ()                     # one key column per entry
    foreign_keys: Sequence[tuple[str, DataFrame, str]] = ()   # (column, dim, dim column)
    default_now: Sequence[str] = ()

    def row_checks(self) -> list[tuple[str, Column]]:
        checks = [(f"not_null:{c}", F.col(c).isNull()) for c in self.not_null]
        checks += [(f"too_long:{c}", F.length(F.col(c)) > n) for c, n in self.max_length.items()]
        return checks


def apply_defaults(df: DataFrame, c: Constraints, now: Column | None = None) -> DataFrame:
    now = now if now is not None else F.current_timestamp()
    if not c.default_now:
        return df
    return df.withColumns({col: F.coalesce(F.col(col), now.cast(df.schema[col].dataType))
                           for col in c.default_now})


def _with_fk_flags(df: DataFrame, c: Constraints) -> DataFrame:
    out = df
    for i, (col, dim, dim_col) in enumerate(c.foreign_keys):
        keys = dim.select(F.col(dim_col).alias(f"_fk{i}")).distinct().withColumn(
            f"_fk{i}_hit", F.lit(True))
        out = out.join(keys, out[col] == keys[f"_fk{i}"], "left").drop(f"_fk{i}")
    return out


def split(df: DataFrame, c: Constraints) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-reason); the first failing check names the
    reason.  UNIQUE is not a row check here - see ``violations``."""
    flagged = _with_fk_flags(apply_defaults(df, c), c)
    reason = None
    checks = c.row_checks() + [
        (f"fk:{col}", F.col(col).isNotNull() & F.col(f"_fk{i}_hit").isNull())
        for i, (col, _, _) in enumerate(c.foreign_keys)]
    for name, cond in checks:
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    reason = reason if reason is not None else F.lit(None).cast("string")
    helper = [f"_fk{i}_hit" for i in range(len(c.foreign_keys))]
    tagged = flagged.withColumn("_reason", reason).drop(*helper)
    accepted = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    rejected = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return accepted, rejected


class UniqueIngest:
    """Appends batches under all declared constraints, UNIQUE included: the first row of a key is taken, every later
    one - of the same batch or of another - is rejected with its reason.

    The keys taken so far are a table of the same store, in folders sorted by key; accepted rows, new
    keys and rejected rows are one commit, so a batch that runs again or two loaders side by side can't
    take a key twice.  Within a batch the first row of a key is a partial aggregate and rows are told
    apart by a number of their own, so a key that a third of all rows share is no hot group.  A null key is
    no duplicate, as in SQL."""

    def __init__(self, store: Store, constraints: Constraints, order: Sequence[str]):
        if len(constraints.unique) != 1:
            raise ValueError("exactly one UNIQUE column: with more, which row is first depends on all of them")
        self.store, self.rules, self.order = store, constraints, list(order)
        self.table, self.key = constraints.table, constraints.unique[0]

    def append(self, rows: DataFrame, batch: int) -> int | None:
        """One batch; the version it made, or None if it was taken before."""
        store, keys = self.store, f"{self.table}_keys"
        if store.committed(self.table, batch):
            return None
        # numbered and kept: both outcomes are read from the same rows
        numbered = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
        good, bad = split(numbered, self.rules)
        first = F.min_by(F.struct(*[F.col(c) for c in numbered.columns]),
                         F.struct(*[F.col(c) for c in self.order], F.col("_row"))).alias("r")
        chosen = good.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(first).select("r.*")
        while True:
            state = store.state()
            held = state.parts(keys)
            fresh = chosen
            if held:
                fresh = chosen.join(store.frame(keys, held, state), self.key, "left_anti")
            fresh = checkpointed(fresh)
            taken = fresh.unionByName(good.filter(F.col(self.key).isNull()).select(*fresh.columns))
            double = good.join(taken.select("_row"), "_row", "left_anti").withColumn(
                "reason", F.lit(f"unique:{self.key}"))
            commit = store.begin()
            commit.add(self.table, taken.drop("_row"))
            commit.add(f"{self.table}_rejected", bad.unionByName(double.select(*bad.columns)).drop("_row"))
            n = fresh.count()
            new = fresh.select(self.key)
            old = held[len(held) - _tail(held, n):]
            if old:  # keys of like number are merged, so folders stay few
                new = new.unionByName(store.frame(keys, old, state))
                commit.remove(old)
            commit.add(keys, new.repartition(self.key).sortWithinPartitions(self.key),
                       n + sum(p.rows for p in old))
            commit.expect(keys, {None}, held)
            try:
                return commit.commit(self.table, batch)
            except Conflict:  # another loader has taken keys meanwhile
                continue


def _tail(parts: list, rows: int) -> int:
    """How many of the newest folders have at most twice the rows that came after them."""
    n = 0
    while n < len(parts) and parts[-1 - n].rows <= 2 * rows:
        rows += parts[-1 - n].rows
        n += 1
    return n


def violations(df: DataFrame, c: Constraints) -> DataFrame:
    """(table, check, violations) for every declared check, zero included."""
    parts: list[DataFrame] = []
    row = c.row_checks()
    if row:
        counts = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).alias(f"c{i}")
                          for i, (_, cond) in enumerate(row)])
        stack = ", ".join(f"'{name}', coalesce(c{i}, 0)" for i, (name, _) in enumerate(row))
        parts.append(counts.selectExpr(f"stack({len(row)}, {stack}) AS (check, violations)"))
    for col in c.unique:
        dup = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0))
                    .alias("violations")))
        parts.append(dup.select(F.lit(f"unique:{col}").alias("check"), "violations"))
    for col, dim, dim_col in c.foreign_keys:
        keys = dim.select(F.col(dim_col).alias("_k"))
        orphans = df.filter(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_k"), "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"fk:{col}").alias("check"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(c.table).alias("table"), "check",
                      F.col("violations").cast("bigint").alias("violations"))
