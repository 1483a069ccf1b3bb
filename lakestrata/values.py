"""Fixed values of the data model.

They decide visible results (keys, imputed cells, reasons), so they are stated
once, here, as plain text.
"""

# --- fixed values -----------------------------------------------------------
KEY_DELIMITER = "||"
SHA_BITS = 256

UNKNOWN_NAME = "Unknown"
UNKNOWN_CITY = "Unknown"
UNKNOWN_STATE = "UN"
IMPUTED_EMAIL_PREFIX = "unknown+"
IMPUTED_EMAIL_SUFFIX = "@imputed.invalid"

OPEN_END = "9999-12-31 23:59:59"

QUARANTINE_LAYER = "bronze"
ENTITY_TRANSACTION = "transaction"
ENTITY_CUSTOMER = "customer"
REASON_MISSING_PRODUCT = "product_id_not_in_bronze_product_feed"
REASON_EMAIL = "email_null_will_impute_in_dim"

BUCKET_MISSING_PRODUCT = "missing_product"
BUCKET_EMAIL = "email_null_audit"
BUCKET_OTHER = "other"
# ---------------------------------------------------------------------------
