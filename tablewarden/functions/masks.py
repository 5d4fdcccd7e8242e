"""Column masks and row filters, looked up by the name the contract declares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import Caller, Env, bounded_values

REDACTED = "REDACTED"


def mask_pii(col: Column, caller: Caller, env: Env, data_type: T.DataType | None = None) -> Column:
    """The value for members of the readers group, else `REDACTED`.

    A null is redacted too, so absence is not disclosed. Text has a literal to
    show; any other type is hidden as a typed null. Membership is known when the
    plan is built, so Catalyst folds the branch away.
    """
    if data_type is None or isinstance(data_type, T.StringType):
        hidden = F.lit(REDACTED)
    else:
        hidden = F.lit(None).cast(data_type)
    return F.when(F.lit(caller.member_of(env.readers)), col).otherwise(hidden)


Mask = Callable[..., Column]
MASKS: dict[str, Mask] = {"security.mask_pii": mask_pii}


def scope_filter(
    caller: Caller, env: Env, scope: DataFrame, column: str, team: str,
    scope_column: str | None = None,
) -> Column | DataFrame:
    """What the caller may see of `column`.

    Readers see everything, a member of `team` the values the scope table gives
    them, everybody else nothing. Returns a predicate, or a key frame to
    semi-join with when the caller's scope is too long to inline. The scope table
    names the value `scope_column`, or as the table does.
    """
    if caller.member_of(env.readers):
        return F.lit(True)
    if not caller.member_of(env.group(team)):
        return F.lit(False)
    mine = scope.filter(F.col("user_email") == caller.user).select(
        F.col(scope_column or column).alias(column)
    )
    values = bounded_values(mine, column)
    if values is None:
        return mine.distinct()
    return F.col(column).isin(*values) if values else F.lit(False)


def filter_by_cost_centre(caller: Caller, env: Env, scope: DataFrame, column: str):
    """The value is passed by place: a table may name its cost centre as it likes."""
    return scope_filter(caller, env, scope, column, "finance_team", scope_column="cost_centre")


RowFilter = Callable[[Caller, Env, DataFrame, str], Column | DataFrame]
ROW_FILTERS: dict[str, RowFilter] = {"security.filter_by_cost_centre": filter_by_cost_centre}


def register_masks(spark: SparkSession, caller: Caller, env: Env, name: str = "mask_pii") -> None:
    """Make the text mask callable from SQL; Catalyst inlines the function body."""
    body = "value" if caller.member_of(env.readers) else f"'{REDACTED}'"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body}"
    )
