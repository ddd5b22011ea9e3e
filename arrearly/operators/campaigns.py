"""Campaign groups as data: a table (group, campaign) in place of lists in code.

A campaign may be in several groups, and one named twice in a group counts once. Rows
with a NULL group or campaign are ignored. A call of a campaign that is in no group, or of no
campaign, is in none; a group without campaigns holds no call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearly.params import Params

QUEUE, CONTACT = "queue", "contact"
MOST_CAMPAIGNS = 100_000  # broadcast up to this many campaigns, counted first


def groups_of(spark: SparkSession, p: Params) -> DataFrame:
    """The run's two campaign lists as a table."""
    rows = [(QUEUE, c) for c in p.queue_campaigns] + [(CONTACT, c) for c in p.contact_campaigns]
    return spark.createDataFrame(rows, "`group` string, campaign string")


def campaign_sets(groups: DataFrame) -> DataFrame:
    """(campaign, groups): one row per campaign, with the set of its groups."""
    return (
        groups.where(F.col("group").isNotNull() & F.col("campaign").isNotNull())
        .groupBy("campaign").agg(F.collect_set("group").alias("groups"))
    )


def with_groups(calls: DataFrame, groups: DataFrame, most: int = MOST_CAMPAIGNS, out: str = "groups") -> DataFrame:
    """``calls`` with the set of groups of each call (empty, never NULL), in one
    pass for all groups. The dimension is broadcast if it has at most ``most``
    campaigns; beyond that it is a plain join, where AQE may split a hot campaign."""
    sets = campaign_sets(groups).withColumnRenamed("groups", out)
    if sets.limit(most + 1).count() <= most:
        sets = F.broadcast(sets)
    none = F.array().cast("array<string>")
    joined = calls.join(sets, calls["campaignName"] == sets["campaign"], "left").drop("campaign")
    return joined.withColumn(out, F.coalesce(F.col(out), none))


def in_group(group: str, out: str = "groups") -> Column:
    return F.array_contains(F.col(out), group)


def group_calls(calls: DataFrame, groups: DataFrame, group: str, most: int = MOST_CAMPAIGNS) -> DataFrame:
    """Calls of one group: a semi join, broadcast after its size is checked."""
    names = groups.where((F.col("group") == group) & F.col("campaign").isNotNull()).select(F.col("campaign").alias("campaignName")).distinct()
    if names.limit(most + 1).count() <= most:
        names = F.broadcast(names)
    return calls.join(names, "campaignName", "left_semi").select(*calls.columns)


def campaign_group_calls(calls: DataFrame, groups: DataFrame, most: int = MOST_CAMPAIGNS) -> DataFrame:
    """(account, queue_calls, contact_calls, unconnected_contact_calls) of each
    account with a call of either group, from one pass."""
    queue, contact = in_group(QUEUE), in_group(CONTACT)
    silent = F.col("connected").isNull() | (F.col("connected") == 0)
    return (
        with_groups(calls, groups, most).where(queue | contact)
        .groupBy("loanAccountNumber")
        .agg(F.count_if(queue).alias("queue_calls"), F.count_if(contact).alias("contact_calls"),
             F.count_if(contact & silent).alias("unconnected_contact_calls"))
    )
