"""cityweave: geo-social event marts built from Spark DataFrames.

Three marts over date-partitioned social events with coordinates and a city
dictionary:

* a geographic profile per user (current city, home city, itinerary, local time),
* weekly and monthly activity per city,
* pair recommendations for users who share a channel, never messaged each
  other and were last seen within a kilometre.

Every operator takes and returns DataFrames (or Columns); nothing is collected
to the driver.
"""

from cityweave.operators.nearest import nearest_city
from cityweave.operators.profile import user_geo_profile
from cityweave.operators.social import pair_recommendations
from cityweave.operators.zones import zone_metrics
from cityweave.session import prepare_session

__all__ = ["nearest_city", "pair_recommendations", "prepare_session", "user_geo_profile", "zone_metrics"]
