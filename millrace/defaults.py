"""Fixed values that results depend on, plus the defaults built from them."""

# Results must equal those of existing pipelines, so these are
# stated literally and kept together.
HASH_SALT = "salt_key"
HASH_COLUMN = "salt"
KEY_COLUMN = "id"
REQUIRED_COLUMNS = ("id", "name", "city")
PROCESSED_AT = "processing_timestamp"
INGESTED_AT = "ingest_time"
READ_AT = "read_timestamp"
CORRUPT_COLUMN = "_corrupt_record"
CHUNK_ROWS = 2000
SHARD_MB = 100
SHARD_MB_LARGE_INPUT = 200
SHARD_MB_SMALL_INPUT = 20
LARGE_INPUT_MB = 1000
SMALL_INPUT_MB = 100
JDBC_BATCH_ROWS = 1000
TRIGGER = "5 seconds"
SAMPLE_ROWS = 5

# The review record, in declared order, all fields nullable.
REVIEW_DDL = (
    "Id int, ProductId string, UserId string, ProfileName string, HelpfulnessNumerator int, "
    "HelpfulnessDenominator int, Score int, Time int, Summary string, Text string, "
    "ingest_time timestamp"
)

# The flat entity and item records produced from nested documents.
ENTITY_DDL = (
    "id string, name string, city string, rating string, rating_count string, "
    "cost string, cuisine string, lic_no string, link string, address string"
)
ITEM_DDL = (
    "restaurant_id string, restaurant_name string, city string, category string, "
    "dish string, price string, veg_or_non_veg string"
)
