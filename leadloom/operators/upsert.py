"""Keyed upserts on plain tables: the batch is folded to one row per key, full-outer-joined with the old rows and merged column by column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a column is merged, given (new, old).
Rule = Callable[[Column, Column], Column]


def prefer_new(new: Column, old: Column) -> Column:
    return F.coalesce(new, old)


def prefer_old(new: Column, old: Column) -> Column:
    return F.coalesce(old, new)


def union_distinct(new: Column, old: Column) -> Column:
    """Both arrays' values once each, sorted; a missing array leaves the other as it is."""
    return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(F.array_sort(F.array_distinct(F.concat(old, new))))


def unless_empty_object(new: Column, old: Column) -> Column:
    """A JSON text replaces the old one unless it is "{}" and there is an old one."""
    return F.when(new.isNull() | ((new == "{}") & old.isNotNull()), old).otherwise(new)


def fold(batch: DataFrame, keys: list[str], order: str, rules: dict[str, Rule]) -> DataFrame:
    """One row per key, as if the batch's rows were applied one after the other in ``order``."""
    aggs = []
    for c in batch.columns:
        if c in keys or c == order:
            continue
        rule = rules.get(c, prefer_new)
        present = F.when(F.col(c).isNotNull(), F.col(order))
        if rule is prefer_old:
            aggs.append(F.min_by(c, present).alias(c))
        elif rule is union_distinct:
            aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c))
        elif rule is unless_empty_object:
            full = F.when(F.col(c) != "{}", F.col(order))
            aggs.append(F.coalesce(F.max_by(c, full), F.max_by(c, present)).alias(c))
        else:
            aggs.append(F.max_by(c, present).alias(c))
    folded = batch.groupBy(*keys).agg(*aggs)
    unions = [c for c, r in rules.items() if r is union_distinct and c in batch.columns]
    return folded.withColumns({c: F.when(F.size(c) > 0, F.col(c)) for c in unions})


def upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, Rule], default: Rule = prefer_new) -> DataFrame:
    """``old`` with the rows of ``new`` (one per key) merged in by ``rules``; keys only in one of them stay as they are."""
    n, o = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns]), old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns])
    on = [F.col(f"n_{k}") == F.col(f"o_{k}") for k in keys]
    both = n.join(o, on, "full_outer")
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"n_{c}"), F.col(f"o_{c}")).alias(c))
        elif c not in new.columns:
            out.append(F.col(f"o_{c}").alias(c))
        else:
            out.append(rules.get(c, default)(F.col(f"n_{c}"), F.col(f"o_{c}")).alias(c))
    return both.select(*out)


#: Rules of the canonical company table; every other column keeps its old value where the new one is null.
COMPANY_RULES: dict[str, Rule] = {
    "first_seen": prefer_old,
    "alias_names": union_distinct,
    "website_tech_stack": unless_empty_object,
    "behavioral_signals": unless_empty_object,
    "lead_quality": unless_empty_object,
}


def upsert_companies(companies: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    """The canonical table after a batch; rows of one key apply in ``order``."""
    return upsert(companies, fold(batch, ["dedupe_key"], order, COMPANY_RULES), ["dedupe_key"], COMPANY_RULES)


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """New rows replace old ones of their key altogether, but for the columns ``keep``."""
    came = F.lit(True)
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns], came.alias("_came"))
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns])
    both = n.join(o, [F.col(f"n_{k}") == F.col(f"o_{k}") for k in keys], "full_outer")

    def merged(c: str) -> Column:
        first, second = (f"o_{c}", f"n_{c}") if c in keep else (f"n_{c}", f"o_{c}")
        return (F.coalesce(first, second) if c in keep else F.when(F.col("_came"), F.col(first)).otherwise(F.col(second))).alias(c)

    return both.select(*[merged(c) for c in old.columns])


def set_checkpoints(old: DataFrame, new: DataFrame, as_of: Column) -> DataFrame:
    """Checkpoints (run_id, stage_key, status, started_at, completed_at, meta, updated_at) after ``new`` (run_id, stage_key, status,
    meta): a first one starts now even when completed; a later one completes only when it says so; its meta wins over the old."""
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in ("run_id", "stage_key", "status", "meta")])
    both = n.join(old, (F.col("n_run_id") == F.col("run_id")) & (F.col("n_stage_key") == F.col("stage_key")), "full_outer")
    came, fresh = F.col("n_run_id").isNotNull(), F.col("run_id").isNull()
    nothing = F.create_map().cast("map<string,string>")
    old_meta, new_meta = F.coalesce("meta", nothing), F.coalesce("n_meta", nothing)
    kept = F.map_filter(old_meta, lambda k, _: ~F.map_contains_key(new_meta, k))
    return both.select(
        F.coalesce("n_run_id", "run_id").alias("run_id"),
        F.coalesce("n_stage_key", "stage_key").alias("stage_key"),
        F.when(came, F.col("n_status")).otherwise(F.col("status")).alias("status"),
        F.when(fresh, as_of).otherwise(F.col("started_at")).alias("started_at"),
        F.when(came & (F.col("n_status") == "completed"), as_of).otherwise(F.col("completed_at")).alias("completed_at"),
        F.when(came, F.map_concat(kept, new_meta)).otherwise(F.col("meta")).alias("meta"),
        F.when(came, as_of).otherwise(F.col("updated_at")).alias("updated_at"),
    )
