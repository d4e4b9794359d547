"""Names, settings and limits that the systems around this engine
already use, so that its results and tables can take the place of theirs."""

# Topics of the message feed.
TOPIC_BLOCKS = "topic_raw_blocks"
TOPIC_TRANSACTIONS = "topic_raw_transactions"
TOPIC_LOGS = "topic_raw_logs"

# Models of the warehouse.
SILVER_TRANSACTIONS = "stg_transactions"
GOLD_WHALES = "mart_smart_money"

# A wallet with more transactions than this is a whale.
WHALE_THRESHOLD = 5

# Chains that silver may contain, and chains that are published.
ACCEPTED_CHAINS = ("ethereum", "bsc", "polygon")
PUBLISHED_CHAINS = ("ethereum", "bsc")

# Watermark of a chain that has none yet.
START_BLOCK = 10_000

# Rows of the top-k reports.
REPORT_ROWS = 5

# Pace of the streams, shards of the speed store, rows per database batch.
TRIGGER_INTERVAL = "10 seconds"
SHARDS = 2
JDBC_BATCH_ROWS = 1000
