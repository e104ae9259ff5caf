"""Query parameters (thresholds, sizes, seeds), chosen once for every scale."""

FREQUENT_HOST_MIN = 10        # G3: more than this many requests
TOP_ENDPOINTS = 10            # G5, G6
DISTINCT_404_LIMIT = 40       # G11
TOP_404_ENDPOINTS = 20        # G12
TOP_404_HOSTS = 25            # G13
TOP_ERROR_DAYS = 5            # G15
LOWEST_IDF = 11               # E4
IDF_BINS = 50                 # E5
BEST_MIN_RATINGS = 40         # R3 (the reference's 500, scaled to this data)
BEST_N = 20
RECOMMEND_MIN_RATINGS = 35    # R14 (the reference's 75, scaled)
RECOMMEND_N = 20
SAMPLE_N = 50
SAMPLE_SEED = 42
SMALL_N = 10
LIST_CHUNK = 100              # P7: values in a list
COLLECT_CHUNK = 64            # A6: values in a chunk
MIN_SIMILARITY = 0.02         # E13: pairs at or above it are joined; the sweep starts there
USERS_ASKED = 5               # J5: the most active users, ties by id
LOOKUP_ITEM = 1               # P10: one benchmark record
COSINE_LEFT, COSINE_RIGHT = 0, 0   # E9: one benchmark record, one document
# The new user's own ratings (item, rating), as the reference's user
# rates a handful of titles by hand.
NEW_USER_PICKS = ((1, 5.0), (2, 4.0), (3, 4.0), (5, 3.0), (8, 5.0),
                  (13, 2.0), (21, 4.0), (34, 3.0), (55, 5.0), (89, 1.0))
ALS_RANK = 8
