"""Row and column access by role."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.plans.star import Star

STORE_OPERATIONS, COMMERCIAL = "Store operations", "Commercial"
STORE_FACTS = (
    "fact_sales", "fact_store_day", "fact_stockout_risk", "fact_stockout_run", "stockout_store_week",
    "fact_promo_event")
NETWORK_ONLY = frozenset({"promo_family_summary", "stockout_bh_summary"})


class RoleError(ValueError):
    """A user with no role or with more than one."""


@dataclass(frozen=True)
class Role:
    """What a role may see. ``own_stores``: only rows of the stores in the user's access list."""

    own_stores: bool
    denied_tables: frozenset[str] = frozenset()
    denied_columns: frozenset[str] = frozenset()


#: The only place where the rules stand: selections and the access matrix follow from it.
RULES: dict[str, Role] = {
    STORE_OPERATIONS: Role(True, NETWORK_ONLY, frozenset({"unit_cost"})),
    COMMERCIAL: Role(False, frozenset({"user_access"})),
}


def own_access(access: DataFrame, user: str) -> DataFrame:
    return access.filter(F.col("user_principal_name") == user)


def _as_role(star: Star, user: str, role: Role) -> Star:
    """The star under a role: stores and facts of the user's stores only, denied tables empty, denied columns gone."""
    def access() -> DataFrame:
        return own_access(star.table("user_access"), user)

    def allowed() -> DataFrame:
        return star.table("dim_store").join(access().select("store_key"), "store_key", "left_semi")

    def visible(fact: str):
        return lambda: star.table(fact).join(access().select("store_key"), "store_key", "left_semi").join(
            star.table("dim_store").select("store_key"), "store_key", "left_semi")

    limited = star
    if role.own_stores:
        own = {fact: visible(fact) for fact in STORE_FACTS if fact in star.sources}
        limited = star.with_tables(**own, dim_store=allowed, user_access=access)
    limited = limited.with_tables(dim_item=lambda: star.table("dim_item").drop(*role.denied_columns))
    return replace(limited, denied_tables=star.denied_tables | role.denied_tables,
                   denied_columns=star.denied_columns | role.denied_columns)


def store_operations(star: Star, user: str) -> Star:
    """Only the user's stores, in every related table; no unit cost, no network-wide results."""
    return _as_role(star, user, RULES[STORE_OPERATIONS])


def commercial(star: Star) -> Star:
    """All stores and columns, but not the access list."""
    return _as_role(star, "", RULES[COMMERCIAL])


def secure(star: Star, user: str, roles: dict[str, list[str]]) -> Star:
    """The star as a user sees it. Exactly one role per user."""
    held = [role for role, members in roles.items() if user in members]
    if len(held) != 1:
        raise RoleError(f"{user} holds {len(held)} roles; a query needs exactly one")
    return _as_role(star, user, RULES[held[0]])


def access_matrix(star: Star, members: DataFrame) -> DataFrame:
    """Per user (user, role): stores seen, access rows seen, and whether unit cost is visible.

    One plan for all users: a user's rows of the store and access tables are counted behind the same row rule, table and
    column denials that a report of that user goes through. Users whose role sees only its own stores meet them by their access rows.
    """
    spark = members.sparkSession
    rules = spark.createDataFrame(
        [(name, r.own_stores, "dim_store" in r.denied_tables, "user_access" in r.denied_tables, "unit_cost" not in r.denied_columns)
         for name, r in RULES.items()], "role string, own boolean, no_stores boolean, no_access boolean, cost_visible boolean")
    users = members.join(rules, "role", "left")
    stores, access = star.table("dim_store").select("store_key"), star.table("user_access")
    mine = users.filter("own").select("user").join(access.withColumnRenamed("user_principal_name", "user"), "user")
    own = mine.groupBy("user").agg(F.count(F.lit(1)).alias("own_access"))
    own_stores = mine.select("user", "store_key").distinct().join(stores, "store_key").groupBy("user").agg(F.count(F.lit(1)).alias("own_stores"))
    every_store = stores.agg(F.count(F.lit(1)).alias("n")).scalar()
    every_row = access.agg(F.count(F.lit(1)).alias("n")).scalar()
    seen = lambda own_count, every, denied: F.when(denied, 0).when(F.col("own"), F.coalesce(own_count, F.lit(0))).otherwise(every)
    return users.join(own, "user", "left").join(own_stores, "user", "left").select(
        "user", "role",
        seen("own_stores", every_store, F.col("no_stores")).alias("stores"),
        seen("own_access", every_row, F.col("no_access")).alias("access_rows"), "cost_visible")
