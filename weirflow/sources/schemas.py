"""Column layouts of the inputs. Nothing is inferred."""

from __future__ import annotations

LINKS = "src long, dst long"
TITLES = "id long, title string"
RELATIONS = "screen_name string, follower string"
TEXT_LOG = "ts timestamp_ntz, node int, log_text string"
TXN_LOG = "ts timestamp_ntz, client_id long, cxid long, zxid long, operation string, extra string"
METRIC_POINT = "metric string, ts timestamp_ntz, value double, tags map<string,string>"

# The fields of a stored tag use after the user name, in file order, with their types.
TAG_USE_FIELDS = (
    ("hashtag", "string"), ("ts_ms", "long"), ("quote_count", "int"), ("reply_count", "int"),
    ("retweet_count", "int"), ("favorite_count", "int"), ("favorited", "boolean"), ("retweeted", "boolean"),
    ("filter_level", "string"),
)

# The fields of a stored user after the user name, in file order, with their types.
USER_FIELDS = (
    ("followers_count", "int"), ("friends_count", "int"), ("listed_count", "int"), ("created_ms", "long"),
    ("favourites_count", "int"), ("time_zone", "string"), ("geo_enabled", "boolean"), ("verified", "boolean"),
    ("statuses_count", "int"), ("contributors_enabled", "boolean"), ("is_translator", "boolean"),
    ("profile_use_background_image", "boolean"), ("default_profile", "boolean"),
    ("default_profile_image", "boolean"), ("following", "boolean"), ("follow_request_sent", "boolean"),
    ("notifications", "boolean"), ("translator_type", "string"),
)
