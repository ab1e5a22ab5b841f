"""Names, weights and sizes that results depend on."""

# --- fixed values: event types and their weights -------------------------
VIEW = "view"
ADD_TO_CART = "addtocart"
TRANSACTION = "transaction"
EVENT_TYPES = (VIEW, ADD_TO_CART, TRANSACTION)
INTENT_EVENT_TYPES = (ADD_TO_CART, TRANSACTION)
EVENT_WEIGHTS = {VIEW: 1.0, ADD_TO_CART: 3.0, TRANSACTION: 5.0}
VALID_WEIGHTS = (1.0, 3.0, 5.0)

# weight of an event type that is not in EVENT_WEIGHTS
CURATED_UNKNOWN_WEIGHT = 0.0
CONTENT_UNKNOWN_WEIGHT = 1.0

# --- fixed values: item properties ---------------------------------------
CATEGORY_PROPERTY = "categoryid"
AVAILABILITY_PROPERTY = "available"
SELECTED_PROPERTIES = (CATEGORY_PROPERTY, AVAILABILITY_PROPERTY)
TRUE_TEXTS = ("1", "true")
FALSE_TEXTS = ("0", "false")
UNKNOWN_CATEGORY = -1

# --- fixed values: lineage labels ----------------------------------------
# Batch sorts above api, so a batch row wins an equal timestamp.
EVENT_SOURCE = "catalog"
BATCH_SOURCE = "catalog_batch"
API_SOURCE = "catalog_api"
BATCH_FEED = "item_properties_part1"
DELTA_FEED = "item_properties_delta"

# --- fixed values: model parameters --------------------------------------
TOP_K = 10
SERVING_TOP_K = 5
TEST_WINDOW_DAYS = 14
PLOTTED_TOP_N = 20
EXAMPLE_USERS = 5
EXAMPLE_TOP_K = 5
CONTENT_EXAMPLE_ROWS = 25
ACTIVE_USER_LIMIT = 5
TOP_PROPERTY_LIMIT = 30
TREE_SAMPLE_LIMIT = 20
HISTOGRAM_BINS = 50
CLIP_QUANTILE = 0.99
MIN_COVERAGE = 0.5

POPULARITY_KEY = "popularity"
POPULARITY_FAMILY = "global_popularity_baseline"
POPULARITY_NAME = "popularity_recommender"
POPULARITY_TYPE = "event_weighted_global_popularity"
CONTENT_KEY = "content_based"
CONTENT_FAMILY = "content_based_filtering"
CONTENT_NAME = "content_based_recommender"
CONTENT_TYPE = "category_content_based_filtering"

DAY_MS = 86_400_000

# Scores are kept at nine decimals: far finer than any real difference, and
# coarse enough that an order never hangs on the last bit of a logarithm.
SCORE_DECIMALS = 9

# Ranks at the head of a ranking that are broadcast; all others are shuffled.
HEAD_RANKS = 10_000
