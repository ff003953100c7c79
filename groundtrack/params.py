"""Fixed values that define the results.

These must equal the values the original application uses, otherwise the
answers differ. They are stated here once, in natural order, and every
operator takes them as overridable defaults.
"""

# --- fixed values -----------------------------------------------------------
EARTH_RADIUS_KM = 6371.0          # mean Earth radius used by haversine
COVERAGE_RADIUS_KM = 2500.0       # ground coverage radius, same for all objects
LOOKBACK_S = 300                  # motion vector: trailing history, inclusive
MOTION_TOP_N = 5                  # vectors kept per response message
REQUIRED_SATELLITES = 5           # overlap gate of the original (== 5)
WINDOW = "30 minutes"             # sliding track window length
SLIDE = "2 minutes"               # sliding track window slide
WATERMARK = "10 minutes"          # allowed lateness of the sliding windows
RETAIN_S = 1800                   # track retention: window_end at most this old
MIN_TRACK_POINTS = 2              # fewer points draw no track
SAT_IDS = ("49810", "43566", "43056", "41550", "41174")
HISTORY_SAT_ID = "49810"          # the one object whose history is archived
OBSERVER = (12.97623, 77.60329)   # fixed observer (lat, lon)
TOPIC_PREFIX = "satellite-"       # one topic per object: satellite-<id>
TOPIC_PATTERN = r"^satellite-\d+$"
REQUEST_TOPIC = "observer_location"
RESPONSE_TOPIC = "observer_response"
MOTION_TOPIC = "motion_vector_response"
UNKNOWN_NAME = "Unknown"          # satname when the API document has none
MAP_TITLE = "Satellite Tracking - "   # map title, before the time range
POPUP = "%s (ID: %s)"             # end-marker popup: name and id
PATH_POPUP = "%s Path"            # path popup: name
OBSERVER_POPUP = "Observer: %s"   # observer marker popup: place
OBSERVER_NAME = "Bangalore"       # place of the fixed observer
UPDATED = "Last updated: "        # second line of the map title, before the time
# request choice -> action
ACTIONS = {1: "motion_vector", 2: "overlap", 3: "closest", 4: "exit"}
UNKNOWN_ACTION = "unknown"
VALID_CHOICES = (1, 2, 3)
# --- end of fixed values ----------------------------------------------------

# Our own defaults (not from the original application).
ASOF_BUCKET_S = 3600              # closest / as-of: width of a time bucket (not a bound on age)
MOTION_CHUNK_S = 21600            # time chunk that splits one object's history
