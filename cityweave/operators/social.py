"""Pair recommendations: users sharing a channel, never in contact, within a radius.

The reference enumerates every pair of users of each channel and only then
filters by distance, which is quadratic in the size of a channel.  Here pairs
are only formed inside (channel, grid cell) neighbourhoods: each subscriber
is placed at its latest position, a 3-D grid of cells (twice the radius)
turns "within ``max_km``" into an equi-join on the neighbouring cells within
reach of each member, and the exact distance is checked afterwards.  The output keeps the reference's row
multiplicity (one row per shared channel, one per tied zone city).

Hot (channel, cell) keys -- skewed in output, not input -- are salted on both
sides; see ``_split_hot_cells``.  Pairs are not moved once they are formed: the
members bring the contacts (``_near_contacts``) and zones that a pair needs, so
what is shuffled follows the members, not the pairs.

Channel-wide pair *counts* are computed arithmetically (``n*(n-1)/2`` minus
the contact pairs inside the channel) without ever emitting the pairs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.calendar import DEFAULT_TIME_ZONE, local_time
from cityweave.functions.geo import (
    CELL_WIDENING,
    cell_width,
    cos_lat,
    forward_cells_within,
    grid_position,
    haversine_km,
    unit_vector,
    within_km,
)
from cityweave.functions.parsing import parse_timestamp, to_user_id
from cityweave.operators.nearest import nearest_city
from cityweave.session import scratch_table

# Fixed value: recommendation radius of the reference, km (strict '<').
DEFAULT_MAX_KM = 1.0

# Default grid cell side as a multiple of the radius.  Wider cells hold more
# candidates each, but a member then reaches far fewer neighbour cells (about
# 4 probe copies at 2x instead of 14 at 1x): less to shuffle.
CELL_FACTOR = 2.0

# Side of the blocks into which the candidates of a hot (channel, cell) are split.
HOT_CELL_ROWS = 2000

# Most blocks on either side of a hot (channel, cell), and so most copies of its members: above
# ``MAX_SALTS * hot_rows`` members the blocks grow instead, or the copies would grow with the pairs.
MAX_SALTS = 16

# Which field holds the actor of each kind of action.
ACTION_ACTOR = (
    ("reaction", "reaction_from"),
    ("message", "message_from"),
    ("subscription", "usr"),
)


def user_channels(events: DataFrame) -> DataFrame:
    """Distinct ``(user_id, subscription_channel)`` of subscriptions."""
    return (
        events.where((F.col("event_type") == F.lit("subscription")) & F.col("usr").isNotNull())
        .select(to_user_id("usr").alias("user_id"), "subscription_channel")
        .where(F.col("user_id").isNotNull())
        .distinct()
    )


def contact_pairs(events: DataFrame) -> DataFrame:
    """Distinct unordered ``(user_left <= user_right)`` of users who messaged."""
    a = to_user_id("message_from")
    b = to_user_id("message_to")
    return (
        events.where(
            (F.col("event_type") == F.lit("message"))
            & F.col("message_from").isNotNull()
            & F.col("message_to").isNotNull()
        )
        .select(F.least(a, b).alias("user_left"), F.greatest(a, b).alias("user_right"))
        .where(F.col("user_left").isNotNull() & F.col("user_right").isNotNull())
        .distinct()
    )


def latest_action(events: DataFrame) -> DataFrame:
    """Each user's latest located action (reaction, message or subscription).

    One scan: the actor column follows the event type.  The latest row is a
    ``max`` over ``struct(action_time, lat, lon, event_type)`` -- a partial
    aggregation, so a hot user is reduced map-side.  Ties on time resolve to
    the larger (lat, lon, event_type); NULL times lose to any time.
    """
    is_kind = [(F.col("event_type") == F.lit(kind), F.col(field).cast("string")) for kind, field in ACTION_ACTOR]
    actor: Column = F.when(*is_kind[0])
    for cond, value in is_kind[1:]:
        actor = actor.when(cond, value)
    actions = events.where(
        F.col("event_type").isin([k for k, _ in ACTION_ACTOR])
        & F.col("datetime").isNotNull()
        & F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
    ).select(
        to_user_id(actor).alias("user_id"),
        parse_timestamp("datetime").alias("action_time"),
        "lat",
        "lon",
        "event_type",
    ).where(F.col("user_id").isNotNull())
    latest = actions.groupBy("user_id").agg(
        F.max(F.struct("action_time", "lat", "lon", "event_type")).alias("_a")
    )
    return latest.select("user_id", "_a.action_time", "_a.lat", "_a.lon", "_a.event_type")


def channel_pair_counts(channels: DataFrame) -> DataFrame:
    """Per channel: subscribers and the number of unordered subscriber pairs."""
    counted = channels.groupBy("subscription_channel").agg(F.count(F.lit(1)).alias("n_users"))
    # an unnamed channel equals no other, so its subscribers form no pair
    # halve the even factor first: n*(n-1) alone would overflow long long
    # before the pair count itself does
    pairs = F.expr(
        "CASE WHEN subscription_channel IS NULL THEN 0 WHEN n_users % 2 = 0 THEN (n_users div 2) * (n_users - 1)"
        " ELSE n_users * ((n_users - 1) div 2) END"
    )
    return counted.withColumn("n_pairs", pairs)


def pairs_without_contact_counts(channels: DataFrame, contacts: DataFrame) -> DataFrame:
    """Per channel: pairs, pairs already in contact, and pairs without contact.

    A contact pair counts in every channel both users subscribe to.  Each
    pair expands only the channels of its end with *fewer* subscriptions and
    keeps those the other end also has (a semi-join), so the work per pair is
    ``min(channels(a), channels(b))`` -- a user with huge contact and channel
    lists never multiplies the two.
    """
    per_user = channels.groupBy("user_id").agg(F.count(F.lit(1)).alias("_h"))
    sized = (
        contacts.where(F.col("user_left") < F.col("user_right"))
        .join(per_user.select(F.col("user_id").alias("user_left"), F.col("_h").alias("_hl")), "user_left")
        .join(per_user.select(F.col("user_id").alias("user_right"), F.col("_h").alias("_hr")), "user_right")
    )
    left_smaller = F.col("_hl") <= F.col("_hr")
    oriented = sized.select(
        F.when(left_smaller, F.col("user_left")).otherwise(F.col("user_right")).alias("_probe"),
        F.when(left_smaller, F.col("user_right")).otherwise(F.col("user_left")).alias("_other"),
    )
    shared = oriented.join(
        channels.select(F.col("user_id").alias("_probe"), "subscription_channel"), "_probe"
    ).join(
        channels.select(F.col("user_id").alias("_other"), "subscription_channel"),
        ["_other", "subscription_channel"],
        "left_semi",
    )
    in_contact = shared.groupBy("subscription_channel").agg(F.count(F.lit(1)).alias("n_contact_pairs"))
    return (
        channel_pair_counts(channels)
        .join(in_contact, "subscription_channel", "left")
        .select(
            "subscription_channel",
            "n_pairs",
            F.coalesce("n_contact_pairs", F.lit(0)).cast("bigint").alias("n_contact_pairs"),
            (F.col("n_pairs") - F.coalesce("n_contact_pairs", F.lit(0))).cast("bigint").alias(
                "n_pairs_without_contact"
            ),
        )
    )


def pair_distance(pairs: DataFrame, positions: DataFrame) -> DataFrame:
    """Both users' latest positions and their distance, for a table of pairs.

    Pairs where either user has no position are dropped.
    """
    pos = positions.select("user_id", "lat", "lon")
    left = pos.select(
        F.col("user_id").alias("user_left"),
        F.col("lat").alias("user_left_lat"),
        F.col("lon").alias("user_left_lon"),
    )
    right = pos.select(
        F.col("user_id").alias("user_right"),
        F.col("lat").alias("user_right_lat"),
        F.col("lon").alias("user_right_lon"),
    )
    return (
        pairs.join(left, "user_left")
        .join(right, "user_right")
        .select(
            "user_left",
            "user_right",
            "user_left_lat",
            "user_left_lon",
            "user_right_lat",
            "user_right_lon",
            haversine_km("user_left_lat", "user_left_lon", "user_right_lat", "user_right_lon").alias(
                "distance_km"
            ),
        )
    )


def nearby_pairs(
    channels: DataFrame,
    positions: DataFrame,
    contacts: DataFrame,
    max_km: float = DEFAULT_MAX_KM,
    cell_km: float | None = None,
    distinct_pairs: bool = False,
    left_carry: tuple[str, ...] = (),
    hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Pairs ``user_left < user_right`` sharing a channel, not in contact,
    whose latest positions are closer than ``max_km``.

    One row per shared channel (reference multiplicity) unless
    ``distinct_pairs``.  ``cell_km`` is the grid cell side (default
    ``CELL_FACTOR * max_km``, never below ``max_km``); the result does not
    depend on it.  ``left_carry`` names extra ``positions`` columns to keep
    for the left user.

    A (channel, cell) group of n members yields ~n^2/2 candidate pairs from
    only n input rows, so its skew is invisible to AQE (which looks at input
    bytes).  Groups above ``hot_rows`` members are therefore salted on both
    sides (``_split_hot_cells``): every task of such a group joins about
    ``hot_rows`` x ``hot_rows`` candidates, or one part in ``MAX_SALTS ** 2``.
    """
    width = cell_width(max_km, CELL_FACTOR * max_km if cell_km is None else cell_km)
    carry = list(left_carry)
    members = (
        # cell, cosine and vector are found once per user, below the join: above it every use would repeat their trigonometry
        channels.join(positions.select("user_id", "lat", "lon", grid_position("lat", "lon", width).alias("_pos"),
                                       cos_lat("lat").alias("_cos"),
                                       *[v.alias(n) for n, v in zip(("_x", "_y", "_z"), unit_vector("lat", "lon"), strict=True)], *carry), "user_id")
        .withColumn("_cell", F.struct(F.col("_pos.cx").alias("cx"), F.col("_pos.cy").alias("cy"),
                                      F.col("_pos.cz").alias("cz")))
        .join(_near_contacts(contacts, positions, max_km), "user_id", "left")
    )
    # Each member probes its own cell and those of the 13 "forward"
    # neighbours that lie within the radius of it; every unordered pair is
    # met exactly once.
    reach = max_km * CELL_WIDENING
    probe = members.select(
        "subscription_channel",
        F.explode(forward_cells_within("_pos", width, reach)).alias("_p"),
        F.col("user_id").alias("_u1"),
        F.col("lat").alias("_lat1"),
        F.col("lon").alias("_lon1"),
        F.col("_cos").alias("_cos1"),
        *[F.col(f"_{axis}").alias(f"_{axis}1") for axis in "xyz"],
        F.col("_known").alias("_known1"),
        *[F.col(c).alias(f"_1_{c}") for c in carry],
    ).select(
        "subscription_channel",
        F.struct(F.col("_p.cx").alias("cx"), F.col("_p.cy").alias("cy"), F.col("_p.cz").alias("cz")).alias(
            "_cell"
        ),
        F.col("_p.own").alias("_own"),
        "_u1",
        "_lat1",
        "_lon1",
        "_cos1",
        *[f"_{axis}1" for axis in "xyz"],
        "_known1",
        *[f"_1_{c}" for c in carry],
    )
    build = members.select(
        "subscription_channel",
        "_cell",
        F.col("user_id").alias("_u2"),
        F.col("lat").alias("_lat2"),
        F.col("lon").alias("_lon2"),
        F.col("_cos").alias("_cos2"),
        *[F.col(f"_{axis}").alias(f"_{axis}2") for axis in "xyz"],
        F.col("_known").alias("_known2"),
        *[F.col(c).alias(f"_2_{c}") for c in carry],
    )
    probe, build, join_key = _split_hot_cells(probe, build, hot_rows)
    u1, u2 = F.col("_u1"), F.col("_u2")

    def pick(first: str, second: str) -> Column:
        return F.expr(f"if(_u1 > _u2, `{second}`, `{first}`)")

    def knows(known: str, other: Column) -> Column:
        return F.coalesce(F.array_contains(known, other), F.lit(False))

    # in the order of their costs: each pair of members is tested, and the distance is found once for a pair that is listed
    distance = haversine_km("_lat1", "_lon1", "_lat2", "_lon2", "_cos1", "_cos2")
    near = (
        probe.join(build, join_key)
        .where(F.expr("if(_ordered, _u1 < _u2, _u1 != _u2)"))
        .where(within_km([f"_{axis}1" for axis in "xyz"], [f"_{axis}2" for axis in "xyz"], distance, max_km))
        .where(~knows("_known1", u2) & ~knows("_known2", u1))
        .select(
            F.least(u1, u2).alias("user_left"),
            F.greatest(u1, u2).alias("user_right"),
            pick("_lat1", "_lat2").alias("user_left_lat"),
            pick("_lon1", "_lon2").alias("user_left_lon"),
            pick("_lat2", "_lat1").alias("user_right_lat"),
            pick("_lon2", "_lon1").alias("user_right_lon"),
            distance.alias("distance_km"),
            *[pick(f"_1_{c}", f"_2_{c}").alias(c) for c in carry],
        )
    )
    return near.distinct() if distinct_pairs else near


def _near_contacts(contacts: DataFrame, positions: DataFrame, max_km: float) -> DataFrame:
    """``user_id, _known``: the contacts within ``max_km`` of each user, each pair listed by one end.

    The end with fewer of them lists the other, so a list holds at most
    ``sqrt(2 * pairs)`` users however many contacts a user has.
    """
    met = pair_distance(contacts.where("user_left < user_right").select("user_left", "user_right"), positions)
    met = met.where(F.col("distance_km") < F.lit(float(max_km))).select("user_left", "user_right").distinct()
    ends = met.select("user_left").unionAll(met.select("user_right")).withColumnRenamed("user_left", "user_id")
    per_user = ends.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    sized = met.join(per_user.select(F.col("user_id").alias("user_left"), F.col("_n").alias("_nl")), "user_left").join(
        per_user.select(F.col("user_id").alias("user_right"), F.col("_n").alias("_nr")), "user_right")
    fewer = F.col("_nl") <= F.col("_nr")
    owner = F.when(fewer, F.col("user_left")).otherwise(F.col("user_right")).alias("user_id")
    other = F.when(fewer, F.col("user_right")).otherwise(F.col("user_left")).alias("_other")
    return sized.select(owner, other).groupBy("user_id").agg(F.collect_list("_other").alias("_known"))


def _split_hot_cells(probe: DataFrame, build: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt the (channel, cell) keys on which more than ``hot_rows ** 2`` candidates meet.

    Both sides are counted per key (map-side partial sums): probe copies come
    from neighbouring cells too, so a cell with few members of its own can be
    hot.  A hot key gets ``ceil(probe / hot_rows)`` x ``ceil(build / hot_rows)``
    salts, at most ``MAX_SALTS`` a side: a probe row hashes its user into salt ``a`` and is copied for every
    ``b``, a build row the other way round, so each pair of rows meets once, and
    about ``hot_rows`` x ``hot_rows`` of them in one place.  The hot keys are
    joined on; Spark broadcasts their table if it turns out small.

    Members that probe their own cell (``_own``) meet each other from both
    sides.  Where both sides have as many salts, equal users have equal salts,
    so a block below the diagonal holds the pairs of the block above it: it is
    left out, and above the diagonal all pairs count.
    """
    key = ["subscription_channel", "_cell"]

    def counted(side: DataFrame, name: str) -> DataFrame:
        return side.where("subscription_channel is not null").groupBy(*key).agg(F.count(F.lit(1)).alias(name))

    def salts(n: str, out: str) -> Column:
        return F.least(F.ceil(F.col(n) / F.lit(hot_rows)), F.lit(MAX_SALTS)).cast("int").alias(out)

    hot = (
        counted(probe, "_np")
        .join(counted(build, "_nb"), key)
        .where(F.col("_np").cast("double") * F.col("_nb") > F.lit(float(hot_rows) ** 2))
        .select(*key, salts("_np", "_sa"), salts("_nb", "_sb"))
        # few more probes than members: as many salts
        .withColumn("_sb", F.when(F.col("_sa").between(F.col("_sb"), 2 * F.col("_sb")), F.col("_sa")).otherwise(F.col("_sb")))
    )
    # without salts in common, every block of own probes is met, and the smaller user probes
    diagonal = F.coalesce(F.col("_own") & (F.col("_sa") == F.col("_sb")), F.lit(False)) if "_own" in probe.columns else F.lit(False)

    def salted(side: DataFrame, user: str, own: str, n_own: str, other: str, n_other: str, first: Column) -> DataFrame:
        mine, theirs = (F.coalesce(F.col(c), F.lit(1)) for c in (n_own, n_other))
        return (
            side.join(hot, key, "left")
            .withColumn(own, F.pmod(F.xxhash64(user), mine).cast("int"))
            .withColumn(other, F.explode(F.sequence(first, theirs - 1)))
        )

    zero = F.lit(0)
    probe = salted(probe, "_u1", "_a", "_sa", "_b", "_sb", F.when(diagonal, F.col("_a")).otherwise(zero))
    if "_own" in probe.columns:
        # in a block above the diagonal, users are told apart by their salts
        probe = probe.withColumn("_ordered", F.col("_own") & ~(diagonal & (F.col("_a") < F.col("_b"))))
    probe = probe.drop("_sa", "_sb")
    build = salted(build, "_u2", "_b", "_sb", "_a", "_sa", zero).drop("_sa", "_sb")
    return probe, build, [*key, "_a", "_b"]


def zoned_positions(positions: DataFrame, cities: DataFrame) -> DataFrame:
    """Latest positions with ``zone_ids``: the nearest city ids (ties kept).

    ``positions`` is already partitioned by ``user_id`` (it is an aggregate on
    it), so grouping the per-row search back to one row per user adds no shuffle.
    """
    located = nearest_city(positions.select("user_id", "lat", "lon"), cities, key=None)
    return located.groupBy("user_id", "lat", "lon").agg(F.collect_list("city_id").alias("zone_ids"))


def zoned_nearby_pairs(
    events: DataFrame,
    cities: DataFrame,
    max_km: float = DEFAULT_MAX_KM,
    cell_km: float | None = None,
    distinct_pairs: bool = False,
    hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Nearby pairs with the left user's zone: one row per tied zone city."""
    # written once: both sides of the pair join and the contacts read it
    positions = scratch_table(events.sparkSession, "zoned-positions", zoned_positions(latest_action(events), cities))
    near = nearby_pairs(
        user_channels(events),
        positions,
        contact_pairs(events),
        max_km=max_km,
        cell_km=cell_km,
        distinct_pairs=distinct_pairs,
        left_carry=("zone_ids",),
        hot_rows=hot_rows,
    )
    return with_zones(near)


def with_zones(near: DataFrame) -> DataFrame:
    """One row per zone city of the left user, from ``zone_ids``.

    The zones are found once a user (``zoned_positions``) and carried by
    ``nearby_pairs``: pairs are many more than users.  A user without a place
    on the globe has no zone and is near nobody.
    """
    columns = [c for c in near.columns if c != "zone_ids"]
    return near.select(*columns, F.explode("zone_ids").alias("zone_id"))


def _run_stamp(as_of) -> tuple[Column, Column]:
    if as_of is None:
        return F.current_date(), F.current_timestamp()
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime.combine(as_of, _dt.time())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(_dt.timezone.utc)
    text = as_of.strftime("%Y-%m-%d %H:%M:%S")
    ts = F.to_timestamp(F.lit(text))
    return F.to_date(ts), ts


RECOMMENDATION_COLUMNS = ("user_left", "user_right", "processed_dttm", "zone_id", "local_time")


def pair_recommendations(
    events: DataFrame,
    cities: DataFrame,
    max_km: float = DEFAULT_MAX_KM,
    as_of=None,
    tz: str = DEFAULT_TIME_ZONE,
    cell_km: float | None = None,
    distinct_pairs: bool = False,
) -> DataFrame:
    """The recommendation mart.

    ``processed_dttm`` and ``local_time`` stamp the run: the current date and
    time (UTC, shown in ``tz``), or ``as_of`` for reproducible runs.
    """
    return stamped(zoned_nearby_pairs(events, cities, max_km, cell_km, distinct_pairs), as_of, tz)


def stamped(zoned: DataFrame, as_of=None, tz: str = DEFAULT_TIME_ZONE) -> DataFrame:
    """Zoned pairs with the run's date and local time: the mart's columns."""
    day, ts = _run_stamp(as_of)
    return zoned.withColumn("processed_dttm", day).withColumn("local_time", local_time(ts, tz)).select(*RECOMMENDATION_COLUMNS)
