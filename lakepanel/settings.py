"""Parameters of the registered queries (shared by the Spark and SQL sides)."""

# Panel support threshold for the registered queries.  The library default
# is 100 resolved loans; driver tables at sf0.01 hold at most ~45 per cell.
QUERY_MIN_RESOLVED = 20
# Row floor for the complaint bronze load.
ROW_FLOOR = 1000
# Months before this key are checked for taxonomy coverage.
TAXONOMY_CUTOFF = "1998-01"
# Columns summarised by ``column_summary``.
SUMMARY_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
# Numeric ones, whose mean and standard deviation are reported.
MOMENT_COLUMNS = SUMMARY_COLUMNS[:8]
# History backfill: the history extract starts at [0], the bulk extract ends at [1].
HISTORY_SPLIT = ("2024-01-10", "2024-01-20")
# History extract header -> canonical name (it has no ``props`` column).
HISTORY_RENAMES = {
    "Event ID": "event_id",
    "Timestamp": "ts",
    "User": "user_id",
    "Type": "event_type",
    "Value": "value",
}
# NDJSON landing: this month is landed a second time to show a resumed month
# replaces only itself.
RELAND_MONTH = "1996-03"
# Month-file history: history files hold orders before [1]; the bulk extract
# starts at [0] (the two overlap).
ORDERS_SPLIT = ("1998-07-01", "1999-01-01")
# Streaming schema growth: documents in this language arrive first, with
# fewer columns; the rest arrive later with new columns in the middle.
FIRST_ARRIVAL_LANG = "en"
# Rows a month needs to count as covered or backfilled.
MONTH_MIN_ROWS = 170
# Months that the first of two backfill runs lands.
BACKFILL_FIRST = 30
# Support thresholds whose kept cells are reported.
SUPPORT_THRESHOLDS = (20, 100)
