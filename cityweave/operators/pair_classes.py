"""Pairs of users that share a channel, as classes: exact, without listing pairs.

Users with the same set of channels are interchangeable in every channel, so
they form a class.  Within a channel, the pairs of users are then the pairs of
its classes: a result of class rows, each with the number of user pairs that
it stands for, plus the membership.  What the reference lists in full follows
by joining each class with its members.

* ``channel_classes``: the membership, one row a user.
* ``class_channels``: the channels of each class, with its size; linear in the
  subscriptions of the classes, not of the users.
* ``channel_pair_classes``: per channel, how many pairs each class forms with
  itself and with all classes after it.  A channel of c classes gives c rows,
  not c * c: the classes after one are told by their number.
* ``contact_exceptions``: the contact pairs inside each channel, the complement
  of the pairs without contact; linear in the contacts times the shorter of
  the two users' channel lists.

A NULL channel equals no other and takes no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def channel_classes(channels: DataFrame) -> DataFrame:
    """``user_id, class_id``: users of one channel set share a class, named by its least user.

    Sets are compared by their sorted channels: those of a user meet in one
    place, as in any set of a user's; classes are then an aggregate with a
    partial minimum, however many users share a set.
    """
    sets = _channel_sets(channels)
    least = sets.groupBy("_set").agg(F.min("user_id").alias("class_id"))
    return sets.join(least, "_set").select("user_id", "class_id")


def _channel_sets(channels: DataFrame) -> DataFrame:
    """``user_id, _set``: 256 bits that name the user's channel set, found without gathering the set.

    Sums of two independent hashes of the channels and their number are the
    same for equal sets and are partial sums for users of many channels; the
    distinct input makes every channel count once.
    """
    named = channels.where("subscription_channel is not null")
    text = F.col("subscription_channel").cast("string")
    halves = [F.conv(F.substring(F.sha2(text, 256), at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16, 31, 46)]
    return named.groupBy("user_id").agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(halves)]).alias("_set"))


def class_channels(channels: DataFrame, classes: DataFrame) -> DataFrame:
    """``class_id, subscription_channel, class_users``: each class's channels, taken from its least user."""
    sizes = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_users"))
    named = channels.where("subscription_channel is not null").withColumnRenamed("user_id", "class_id")
    return named.join(sizes, "class_id").select("class_id", "subscription_channel", "class_users")


def channel_pair_classes(channels: DataFrame, classes: DataFrame) -> DataFrame:
    """Per channel and class ``class_no, class_users, pairs_within, pairs_after``.

    ``class_no`` numbers a channel's classes by id.  The class forms
    ``pairs_within`` unordered pairs of its own users and ``pairs_after`` with
    the users of all classes of a larger number: every pair of the channel is
    counted once.  The running sums are found in ranges of classes, so no
    channel is gathered in one task.
    """
    rows = class_channels(channels, classes)
    n = int(channels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "subscription_channel", "class_id").withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("subscription_channel", "_part").orderBy("class_id")
    placed = ranged.select(
        "*",
        F.row_number().over(inside).alias("_no"),
        F.sum("class_users").over(inside).alias("_upto"),
    )
    parts = placed.groupBy("subscription_channel", "_part").agg(F.max("_no").alias("_nos"), F.max("_upto").alias("_users"))
    before = Window.partitionBy("subscription_channel").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("subscription_channel")
    parts = parts.select(
        "subscription_channel",
        "_part",
        F.coalesce(F.sum("_nos").over(before), F.lit(0)).alias("_nos_before"),
        F.coalesce(F.sum("_users").over(before), F.lit(0)).alias("_users_before"),
        F.sum("_users").over(all_of).alias("_all"),
    )
    users = F.col("class_users")
    half = F.when(users % 2 == 0, (users / 2).cast("bigint") * (users - 1)).otherwise(users * ((users - 1) / 2).cast("bigint"))
    return placed.join(parts, ["subscription_channel", "_part"]).select(
        "subscription_channel",
        "class_id",
        (F.col("_no") + F.col("_nos_before")).cast("bigint").alias("class_no"),
        "class_users",
        half.alias("pairs_within"),
        (users * (F.col("_all") - F.col("_users_before") - F.col("_upto"))).cast("bigint").alias("pairs_after"),
    )


def contact_exceptions(channels: DataFrame, contacts: DataFrame) -> DataFrame:
    """``subscription_channel, user_left, user_right``: contact pairs that share the channel.

    Pairs without contact are the pairs of ``channel_pair_classes`` less these.
    Each contact pair expands only the channels of its end with fewer of them
    and keeps those that the other end also has.
    """
    named = channels.where("subscription_channel is not null")
    per_user = named.groupBy("user_id").agg(F.count(F.lit(1)).alias("_h"))
    sized = (
        contacts.where("user_left < user_right")
        .join(per_user.select(F.col("user_id").alias("user_left"), F.col("_h").alias("_hl")), "user_left")
        .join(per_user.select(F.col("user_id").alias("user_right"), F.col("_h").alias("_hr")), "user_right")
    )
    left = F.col("_hl") <= F.col("_hr")
    probe, other = (F.when(left, F.col(a)).otherwise(F.col(b)) for a, b in (("user_left", "user_right"), ("user_right", "user_left")))
    oriented = sized.select("user_left", "user_right", probe.alias("_probe"), other.alias("_other"))
    own = oriented.join(named.select(F.col("user_id").alias("_probe"), "subscription_channel"), "_probe")
    shared = own.join(named.withColumnRenamed("user_id", "_other"), ["_other", "subscription_channel"], "left_semi")
    return shared.select("subscription_channel", "user_left", "user_right")


def class_exceptions(exceptions: DataFrame, classes: DataFrame, pair_classes: DataFrame) -> DataFrame:
    """Per channel and class the contact pairs that ``pairs_within`` and ``pairs_after`` hold:
    ``subscription_channel, class_id, contacts_within, contacts_after``."""
    named = exceptions
    for end in ("left", "right"):
        named = named.join(classes.select(F.col("user_id").alias(f"user_{end}"), F.col("class_id").alias(f"_{end}")), f"user_{end}")
    first = F.least("_left", "_right").alias("class_id")  # classes are numbered by id
    within = F.col("_left") == F.col("_right")
    counted = named.select("subscription_channel", first, within.alias("_w")).groupBy("subscription_channel", "class_id")
    counted = counted.agg(F.count_if("_w").alias("contacts_within"), F.count_if(~F.col("_w")).alias("contacts_after"))
    return pair_classes.select("subscription_channel", "class_id").join(counted, ["subscription_channel", "class_id"])


def pairs_without_contact_classes(channels: DataFrame, contacts: DataFrame, classes: DataFrame) -> DataFrame:
    """``channel_pair_classes`` with the pairs in contact taken away: ``free_within``, ``free_after``."""
    pairs = channel_pair_classes(channels, classes)
    taken = class_exceptions(contact_exceptions(channels, contacts), classes, pairs)
    none = F.lit(0)
    return pairs.join(taken, ["subscription_channel", "class_id"], "left").select(
        *pairs.columns,
        (F.col("pairs_within") - F.coalesce("contacts_within", none)).alias("free_within"),
        (F.col("pairs_after") - F.coalesce("contacts_after", none)).alias("free_after"),
    )


def expand(pair_classes: DataFrame, classes: DataFrame) -> DataFrame:
    """Every pair row ``subscription_channel, user_left, user_right`` of the classes.

    Quadratic in the users of a channel: for a look at some channels, and tests.
    """
    a = pair_classes.select("subscription_channel", F.col("class_id").alias("_a"), F.col("class_no").alias("_na"))
    b = pair_classes.select("subscription_channel", F.col("class_id").alias("_b"), F.col("class_no").alias("_nb"))
    both = a.join(b, "subscription_channel").where("_na <= _nb")
    u = classes.select(F.col("class_id").alias("_a"), F.col("user_id").alias("_u"))
    v = classes.select(F.col("class_id").alias("_b"), F.col("user_id").alias("_v"))
    pairs = both.join(u, "_a").join(v, "_b").where("_na < _nb or _u < _v")
    return pairs.select("subscription_channel", F.least("_u", "_v").alias("user_left"), F.greatest("_u", "_v").alias("user_right"))
