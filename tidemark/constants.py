"""Fixed values.

These strings and numbers must equal what downstream stores already hold:
ids, prefixes, file types, synonyms and request limits. Changing one would
duplicate documents or break access on the next sync.
"""

# Document id schemes and source tags.
ROW_ID_SCHEME = "databricks_row"
FILE_ID_SCHEME = "databricks_volume"
ARTICLE_ID_SCHEME = "cms_article"
KB_ID_SCHEME = "snow_kb"
KB_ID_SCHEME_PLAIN = "kb_"
POLICY_ID_SCHEME = "sf:dms"
ROW_SOURCE_TAG = "databricks_uc_table"
FILE_SOURCE_TAG = "databricks_uc_volume"
POLICY_SOURCE_TAG = "sap_successfactors"
POLICY_DOC_TYPE = "hr_policy"
ID_MAX_CHARS = 1024

# Access list prefixes and markers.
EXTERNAL_GROUP = "external_group:"
EXTERNAL_USER = "external_user:"
NO_READERS = "external_user:__no_readers_sentinel__"
ALL_EMPLOYEES = "ALL_EMPLOYEES"

# File types by extension.
MIME_BY_EXTENSION = {
    "pdf": "application/pdf",
    "txt": "text/plain",
    "md": "text/markdown",
    "html": "text/html",
    "htm": "text/html",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "json": "application/json",
    "csv": "text/csv",
}
MIME_DEFAULT = "application/octet-stream"

# Request and file limits.
DOCS_PER_SHARD = 1000
FILES_PER_REQUEST = 100
DOCS_PER_INLINE_REQUEST = 100
MAPPINGS_PER_REQUEST = 100
IDS_PER_PURGE = 100_000
BYTES_PER_FILE = 2 * 1024**3
BYTES_PER_CONTENT_FILE = 100 * 1024**2
ROW_CAP = 1000
SMALL_TABLE_ROWS = 50_000
SCALE_GATE_ROWS = 100_000

# Words a user may say for a metric or a dimension.
TERM_SYNONYMS = {
    "customer segment": "segment",
    "tier": "segment",
    "geo": "region",
    "territory": "region",
    "product category": "category",
    "revenue": "net_revenue",
    "net sales": "net_revenue",
    "sales": "net_revenue",
    "order count": "total_orders",
    "units": "units_sold",
    "volume": "units_sold",
    "AOV": "avg_order_value",
}

# Keys of an identity configuration file.
CONFIG_GROUP = "databricks_group"
CONFIG_USER = "databricks_user_name"
CONFIG_TARGET_GROUP = "google_group"
CONFIG_TARGET_EMAIL = "google_email"
