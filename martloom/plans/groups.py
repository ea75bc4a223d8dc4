"""Group activity marts of a messenger: readers, joiners, conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def users_with_messages(membership: DataFrame, messages: DataFrame) -> DataFrame:
    """Users per group who wrote at least one message anywhere.

    ``membership`` has ``group_id, user_id``; ``messages`` has ``user_id``.  Pairs are made
    distinct first, so the semi join sees each user of a group once.
    """
    members = membership.select("group_id", "user_id").distinct()
    writers = messages.select("user_id").distinct()
    return members.join(writers, "user_id", "left_semi").groupBy("group_id").agg(
        F.count("*").alias("cnt_users_in_group_with_messages"))


def oldest_groups(groups: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` groups registered first; ``groups`` has ``group_id, registration_dt``."""
    return groups.orderBy("registration_dt", "group_id").limit(n)


def users_added(history: DataFrame, groups: DataFrame, n: int = 10, event: str = "add") -> DataFrame:
    """Users added to each of the oldest groups; ``history`` has ``group_id, user_id, event``."""
    # n rows by construction, so the broadcast has a fixed size
    old = F.broadcast(oldest_groups(groups, n).select("group_id"))
    return history.filter(F.col("event") == event).join(old, "group_id").groupBy("group_id").agg(
        F.countDistinct("user_id").alias("cnt_added_users"))


def group_conversion(membership: DataFrame, messages: DataFrame, history: DataFrame, groups: DataFrame,
                     n: int = 10, event: str = "add") -> DataFrame:
    """Share of added users who write, for the oldest groups, best first."""
    added = users_added(history, groups, n, event)
    active = users_with_messages(membership, messages)
    ratio = F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")
    return (added.join(active, "group_id", "left").withColumn("group_conversion", ratio)
            .orderBy(F.desc_nulls_last("group_conversion"), "group_id"))
