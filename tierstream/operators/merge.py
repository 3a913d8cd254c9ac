"""Merging a batch of rows into a table, with the rules written down as data.

A :class:`Policy` says which rows meet and what happens then. ``merge_effects``
applies it with DataFrame joins for tables without a native merge;
``Policy.to_sql`` writes the same rules as a MERGE statement for tables with one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


class MergeError(ValueError):
    """Several source rows would change the same target row."""


@dataclass(frozen=True)
class Clause:
    """One WHEN MATCHED rule. ``when`` is SQL over the row aliases ``t`` and ``s``;
    ``assign`` maps target columns to SQL, ``None`` takes all from the source."""

    action: str  # "update" or "delete"
    when: str | None = None
    assign: dict[str, str] | None = None


@dataclass(frozen=True)
class Policy:
    """Match keys, WHEN MATCHED rules in order, and insert of what matches nothing.

    ``on`` pairs a target expression with a source expression, both SQL without
    alias. ``eligible`` restricts the target rows that can match at all.
    """

    on: tuple[tuple[str, str], ...]
    matched: tuple[Clause, ...] = ()
    eligible: str | None = None

    def to_sql(self, table: str, source_view: str, columns: list[str]) -> str:
        """The policy as a MERGE statement."""
        match = [f"t.{target} = s.{source}" for target, source in self.on]
        if self.eligible:
            match.append(f"t.{self.eligible}")
        lines = [f"MERGE INTO {table} AS t USING {source_view} AS s ON {' AND '.join(match)}"]
        for clause in self.matched:
            guard = f" AND {clause.when}" if clause.when else ""
            if clause.action == "delete":
                effect = "DELETE"
            else:
                assign = clause.assign or {c: f"s.{c}" for c in columns}
                effect = "UPDATE SET " + ", ".join(f"t.{c} = {e}" for c, e in assign.items())
            lines.append(f"WHEN MATCHED{guard} THEN {effect}")
        values = ", ".join(f"s.{c}" for c in columns)
        lines.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({values})")
        return "\n".join(lines)


# --- the five table policies -------------------------------------------------

# Type 2 history: close the current version; rows without merge key are new versions.
BOOK_HISTORY = Policy(
    on=(("book_id", "merge_key"),),
    eligible="current",
    matched=(Clause("update", assign={"current": "false", "end_date": "s.effective_date"}),),
)

# Insert only.
NEW_ORDERS = Policy(on=(("order_id", "order_id"), ("order_timestamp", "order_timestamp")))

# Type 1 with deletes. A row that matches nothing is stored whatever its status.
CUSTOMER_STATE = Policy(
    on=(("customer_id", "customer_id"),),
    matched=(
        Clause("update", when="s.row_time > t.row_time AND s.row_status = 'update'"),
        Clause("delete", when="s.row_time > t.row_time AND s.row_status = 'delete'"),
    ),
)

# Driven by the change feed; the commit time of the change is the clock.
CUSTOMER_ORDER_STATE = Policy(
    on=(("order_id", "order_id"), ("customer_id", "customer_id")),
    matched=(
        Clause("update", when="s.processed_timestamp > t.processed_timestamp AND s._change_type = 'update_postimage'"),
        Clause("delete", when="s.processed_timestamp > t.processed_timestamp AND s._change_type = 'delete'"),
    ),
)

# Plain upsert of running aggregates.
AUTHOR_WINDOWS = Policy(on=(("time", "time"), ("author", "author")), matched=(Clause("update"),))


# --- merge on plain frames ---------------------------------------------------


def merge_effects(target: DataFrame, source: DataFrame, policy: Policy, row_id: list[str]) -> DataFrame:
    """What a batch does to a table: ``t`` (the target row, null for an insert), ``action``
    (insert, update, delete), ``after`` (resulting row, null for a delete) and the target
    row's ``row_id`` columns.

    Only rows that change come back. ``source`` should be persisted. Several effects on one
    ``row_id`` mean that source rows contradict each other; the caller has to refuse them.

    Rows that cannot match, because a key is null or the target row is not eligible, stay
    out of the join, so they never gather in one task.
    """
    fields = [field for field in target.schema if field.name not in row_id]
    target_rows = target.select(F.struct(*[F.col(f.name) for f in fields]).alias("t"), *row_id)
    source_rows = source.select(F.struct("*").alias("s"))
    source_keys = [F.expr(f"s.{expression}") for _, expression in policy.on]
    target_keys = [F.expr(f"t.{expression}") for expression, _ in policy.on]
    complete = _all([key.isNotNull() for key in source_keys])
    can_match = _all([key.isNotNull() for key in target_keys])
    if policy.eligible:
        can_match &= F.coalesce(F.expr(f"t.{policy.eligible}"), F.lit(False))
    same_keys = _all([t == s for t, s in zip(target_keys, source_keys)])
    # The target is cut to the batch's keys first: a semi-join can broadcast the source and
    # leave the target where it lies, which the outer join alone could not.
    keyed = source_rows.filter(complete)
    partners = target_rows.filter(can_match).join(keyed, same_keys, "left_semi")
    pairs = keyed.join(partners, same_keys, "left")
    alone = source_rows.filter(~complete).select(
        "s", *[F.lit(None).cast(target_rows.schema[c].dataType).alias(c) for c in ("t", *row_id)]
    )
    decided = pairs.select("s", "t", *row_id).unionByName(alone).withColumn("rule", _rule(policy))
    changes = decided.filter(F.col("rule") != _KEEP)
    return changes.select("t", _action(policy).alias("action"), _after(policy, fields).alias("after"), *row_id)


# Outcomes of a pair that no WHEN MATCHED rule decides.
_KEEP, _INSERT = -1, -2


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result &= condition
    return result


def _rule(policy: Policy) -> Column:
    """Number of the first rule that holds for a pair; without one the target row stays."""
    chosen = F.when(F.col("t").isNull(), _INSERT)
    for number, clause in enumerate(policy.matched):
        chosen = chosen.when(F.expr(clause.when) if clause.when else F.lit(True), number)
    return chosen.otherwise(_KEEP)


def _action(policy: Policy) -> Column:
    name = F.when(F.col("rule") == _INSERT, "insert")
    for number, clause in enumerate(policy.matched):
        name = name.when(F.col("rule") == number, clause.action)
    return name


def _after(policy: Policy, fields: list[StructField]) -> Column:
    """The resulting row. Source columns are found by name and cast to the target's types."""

    def row(assign: dict[str, str], rest: str) -> Column:
        values = [F.expr(assign.get(field.name, f"{rest}.{field.name}")) for field in fields]
        return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, fields)])

    result = F.when(F.col("rule") == _INSERT, row({}, "s"))
    for number, clause in enumerate(policy.matched):
        if clause.action == "update":
            effect = row(clause.assign, "t") if clause.assign else row({}, "s")
            result = result.when(F.col("rule") == number, effect)
    return result


def change_rows(effects: DataFrame, keep: list[str], before: bool = True) -> DataFrame:
    """Effects as rows of a change feed: table columns, ``_effect`` (the kind of change) and
    the columns to keep. ``before`` adds the row as it was before an update."""

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("_effect"), F.col(row).alias("row"))

    update = [change("update_postimage", "after")]
    rows = (
        F.when(F.col("action") == "insert", F.array(change("insert", "after")))
        .when(F.col("action") == "delete", F.array(change("delete", "t")))
        .otherwise(F.array(*[change("update_preimage", "t")] * before, *update))
    )
    return effects.select(F.explode(rows).alias("change"), *keep).select("change.row.*", "change._effect", *keep)
