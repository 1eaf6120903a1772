"""Tag-usage features: how much a user and the user's followers used a tag before an anchor time.

For an anchor T and a day d of 24 hours, a use at time ts counts
  in the label      when T - d <= ts < T,
  in the features   when T - 4d < ts < T - d.
Anchors are a daily sequence. Solving the bounds for the anchor number, a use falls into at most one
label and three feature windows, so it is copied to its anchors and never compared with all of them.
Users' counts are added up before they meet the follower relation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.windows import floor_div, from_micros, micros
from weirflow.session import scratch_path

DAY = 86_400_000_000
LOOKBACK_DAYS = 3
#: Followers' counts that each task may hold, a few dozen bytes each.
BROADCAST_COUNTS = 500_000


@dataclass(frozen=True)
class Anchors:
    """Anchor times ``first + n days`` for n = 0 … count - 1. ``first`` is microseconds since 1970."""

    first: int
    count: int

    @classmethod
    def daily(cls, first: str, count: int) -> Anchors:
        from datetime import UTC, datetime

        return cls(int(datetime.fromisoformat(first).replace(tzinfo=UTC).timestamp()) * 1_000_000, count)

    @classmethod
    def covering(cls, uses: DataFrame, ts: str = "ts") -> Anchors:
        """Every midnight after the first use up to the one after the last, so that each use is in some label."""
        bounds = uses.agg(*[F.floor(micros(f(ts)) / F.lit(DAY)).cast("long") for f in (F.min, F.max)]).first()
        if bounds[0] is None:
            return cls(0, 0)
        return cls((bounds[0] + 1) * DAY, bounds[1] - bounds[0] + 1)

    def time(self, number: Column) -> Column:
        return from_micros(F.lit(self.first) + number * F.lit(DAY))


def _offset(ts: str, anchors: Anchors) -> Column:
    return micros(ts) - F.lit(anchors.first)


def _numbers(low: Column, high: Column, anchors: Anchors) -> Column:
    """The anchor numbers from ``low`` to ``high`` that exist."""
    low = F.greatest(low, F.lit(0).cast("long"))
    high = F.least(high, F.lit(anchors.count - 1).cast("long"))
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def use_counts(uses: DataFrame, user: str, tag: str, ts: str, anchors: Anchors) -> DataFrame:
    """Per user, tag and anchor: ``label`` and ``num_tweets``, for anchors where one of them is not 0."""
    offset = _offset(ts, anchors)
    # ts < T <= ts + d holds for one anchor, ts + d < T < ts + 4d for at most three
    label_no = floor_div(offset, DAY) + 1
    low = floor_div(offset + DAY, DAY) + 1
    high = -floor_div(-(offset + (LOOKBACK_DAYS + 1) * DAY), DAY) - 1

    def tagged(numbers: Column, is_label: int) -> Column:
        return F.transform(numbers, lambda n: F.struct(n.alias("anchor_no"), F.lit(is_label).alias("is_label")))

    hit = F.explode(
        F.concat(
            tagged(_numbers(label_no, label_no, anchors), 1), tagged(_numbers(low, high, anchors), 0)
        )
    )
    return (
        uses.select(user, tag, hit.alias("__hit"))
        .groupBy(user, tag, F.col("__hit.anchor_no").alias("anchor_no"))
        .agg(F.sum("__hit.is_label").alias("label"), F.sum(1 - F.col("__hit.is_label")).alias("num_tweets"))
    )


def follower_counts(
    counts: DataFrame, relations: DataFrame, user: str, follower: str, tag: str, value: str, name: str, held: int = BROADCAST_COUNTS
):
    """Add up the followers' counts for each user, tag and anchor.

    A user's counts of a tag travel as one row of lists. When all followers have ``held`` counts at most, these rows are sent to each
    task and the relations, dealt by user, meet them where they are added up. Otherwise they are dealt by user and tag.
    """
    spark = relations.sparkSession
    rest = [c for c in counts.columns if c not in (user, tag)]
    theirs = counts.withColumnRenamed(user, follower).join(relations.select(follower).distinct(), follower, "left_semi")
    lists = theirs.groupBy(follower, tag).agg(F.collect_list(F.struct(*rest)).alias("__hits"))
    path = scratch_path(spark, "followers")
    lists.select(follower, tag, *[F.col(f"__hits.{c}").alias(c) for c in rest]).write.parquet(path)
    packed = spark.read.parquet(path)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = relations.select(user, follower)
    if (packed.agg(F.sum(F.size(value))).first()[0] or 0) <= held:
        met = pairs.repartition(tasks, user).join(F.broadcast(packed), follower)
    else:
        met = pairs.join(packed, follower).drop(follower).repartition(tasks, user, tag)
    hits = met.select(user, tag, F.inline(F.arrays_zip(*rest)))
    return hits.groupBy(user, *[c for c in counts.columns if c not in (user, value)]).agg(F.sum(value).alias(name))


def known_users(relations: DataFrame, uses: DataFrame, profiles: DataFrame, user: str, follower: str):
    """Uses by users with a profile, and the relations between such users."""
    uses = uses.join(profiles.select(user), user, "left_semi")
    people = uses.select(user).distinct()
    pairs = (
        relations.select(user, follower)
        .distinct()
        .join(people, user, "left_semi")
        .join(people.withColumnRenamed(user, follower), follower, "left_semi")
    )
    return uses, pairs


def training_rows(
    uses: DataFrame,
    relations: DataFrame,
    profiles: DataFrame,
    anchors: Anchors,
    user: str = "user_id",
    tag: str = "hashtag",
    ts: str = "ts",
    follower: str = "follower",
) -> DataFrame:
    """One row per user, tag and anchor at which the user had used the tag more than a day before."""
    uses, pairs = known_users(relations, uses, profiles, user, follower)
    # eligible from the first anchor with T - d > first use
    first = uses.groupBy(user, tag).agg(F.min(ts).alias("__first"))
    low = floor_div(_offset("__first", anchors) + DAY, DAY) + 1
    last = F.lit(anchors.count - 1).cast("long")
    eligible = first.select(user, tag, F.explode(_numbers(low, last, anchors)).alias("anchor_no"))
    own = use_counts(uses, user, tag, ts, anchors)
    theirs = neighbour_counts(own, pairs, user, follower, tag)
    on = [user, tag, "anchor_no"]
    rows = eligible.join(own, on, "left").join(theirs, on, "left")
    filled = rows.na.fill(0, ["label", "num_tweets", "num_user_relations"])
    return filled.withColumn("anchor", anchors.time(F.col("anchor_no"))).drop("anchor_no").join(profiles, user)


def neighbour_counts(own: DataFrame, pairs: DataFrame, user: str, follower: str, tag: str) -> DataFrame:
    """Per user, tag and anchor: the uses of the user's followers in the feature window."""
    theirs = own.where("num_tweets > 0").select(user, tag, "anchor_no", "num_tweets")
    return follower_counts(theirs, pairs, user, follower, tag, "num_tweets", "num_user_relations")


def scoring_rows(
    uses: DataFrame,
    relations: DataFrame,
    profiles: DataFrame,
    as_of: str,
    user: str = "user_id",
    tag: str = "hashtag",
    ts: str = "ts",
    follower: str = "follower",
) -> DataFrame:
    """One row per user and used tag, with the uses of the last three days before ``as_of`` and after."""
    uses, pairs = known_users(relations, uses, profiles, user, follower)
    recent = F.col(ts) > F.expr(f"timestamp_ntz'{as_of}' - interval {LOOKBACK_DAYS} days")
    own = uses.groupBy(user, tag).agg(F.sum(F.when(recent, 1).otherwise(0)).alias("num_tweets"))
    theirs = follower_counts(
        own.where("num_tweets > 0"), pairs, user, follower, tag, "num_tweets", "num_user_relations"
    )
    rows = own.join(theirs, [user, tag], "left").na.fill(0, ["num_user_relations"])
    return rows.withColumn("anchor", F.expr(f"timestamp_ntz'{as_of}'")).join(profiles, user)


def ego_rows(uses, relations, profiles, ego, wanted_tag: str, user: str, follower: str, tag: str) -> DataFrame:
    """Uses of one tag by one user and that user's followers, with their profiles."""
    followers = (
        relations.where(F.lower(F.col(user).cast("string")) == F.lower(F.lit(str(ego))))
        .select(F.col(follower).alias(user))
        .distinct()
    )
    itself = profiles.where(F.lower(F.col(user).cast("string")) == F.lower(F.lit(str(ego)))).select(user)
    people = followers.unionByName(itself).distinct()
    members = profiles.join(people, user, "left_semi")
    return uses.where(F.lower(tag) == F.lower(F.lit(wanted_tag))).join(members, user)
