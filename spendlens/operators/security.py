"""Row-level security: a star narrowed to what one user may see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..star import Star

# The default rule parameters.
OPEN_SUBSCRIPTIONS = ("Dev", "Test")
ADMINS = ("admin@company.com",)


def visible_resources(star: Star, user: str) -> DataFrame:
    """Resources of the user's business unit or team. Administrators are no exception."""
    return star.dim_resource.filter((F.col("businessUnit") == user) | (F.col("team") == user))


def visible_subscriptions(
    star: Star, user: str, open_subscriptions: Sequence[str] = OPEN_SUBSCRIPTIONS, admins: Sequence[str] = ADMINS
) -> DataFrame:
    """Everything for administrators, the open subscriptions for everyone else."""
    if user in admins:
        return star.dim_subscription
    return star.dim_subscription.filter(F.col("subscriptionName").isin(*open_subscriptions))


class SecuredStar(Star):
    """Both rules combined: a fact row is visible when every related dimension member is."""

    def __init__(self, base: Star, resources: DataFrame | None, subscriptions: DataFrame | None):
        super().__init__()
        self._base = base
        self._members = {}
        if resources is not None:
            self.dim_resource = resources
            self._members["resourceKey"] = resources.select("resourceKey")
        if subscriptions is not None:
            self.dim_subscription = subscriptions
            self._members["subscriptionKey"] = subscriptions.select("subscriptionKey")

    def __getattr__(self, name: str):
        """Facts are narrowed by attribute as well; other tables are the base's."""
        table = getattr(self.__dict__["_base"], name)
        return self._visible(table, name) if name.startswith("fact_") else table

    def _visible(self, rows: DataFrame, name: str = "fact") -> DataFrame:
        related = [key for key in self._members if key in rows.columns]
        if self._members and not related:
            raise PermissionError(f"{name} is not related to a secured dimension")
        for key in related:
            rows = rows.join(self._members[key], key, "left_semi")
        return rows

    def cost(self, columns, since=None, until=None):
        keys = [k for k in self._members if k not in columns]
        return self._visible(self._base.cost([*columns, *keys], since, until)).select(*columns)

    def utilization(self, since=None, until=None):
        return self._visible(self._base.utilization(since, until))

    def anomalies(self, since=None, until=None):
        return self._visible(self._base.anomalies(since, until))


def secured(
    star: Star, user: str, open_subscriptions: Sequence[str] = OPEN_SUBSCRIPTIONS, admins: Sequence[str] = ADMINS
) -> SecuredStar:
    return SecuredStar(
        star, visible_resources(star, user), visible_subscriptions(star, user, open_subscriptions, admins)
    )
