"""DataFrame-in, DataFrame-out operators of the three marts."""

from cityweave.operators.nearest import nearest_by_place, nearest_city
from cityweave.operators.leaves import PlaceIndex, place_index
from cityweave.operators.profile import (
    closest_message_cities,
    current_city,
    home_city,
    message_points,
    per_city_counts,
    travel_events,
    travel_stats,
    user_geo_profile,
)
from cityweave.operators.social import (
    channel_pair_counts,
    contact_pairs,
    latest_action,
    nearby_pairs,
    pair_distance,
    pair_recommendations,
    pairs_without_contact_counts,
    user_channels,
)
from cityweave.operators.zones import (
    closest_event_cities,
    located_events,
    zone_metrics,
    zone_month_metrics,
    zone_week_metrics,
)

__all__ = [
    "PlaceIndex",
    "channel_pair_counts",
    "closest_event_cities",
    "closest_message_cities",
    "contact_pairs",
    "current_city",
    "home_city",
    "latest_action",
    "located_events",
    "message_points",
    "nearby_pairs",
    "nearest_by_place",
    "nearest_city",
    "pair_distance",
    "pair_recommendations",
    "pairs_without_contact_counts",
    "place_index",
    "per_city_counts",
    "travel_events",
    "travel_stats",
    "user_channels",
    "user_geo_profile",
    "zone_metrics",
    "zone_month_metrics",
    "zone_week_metrics",
]
