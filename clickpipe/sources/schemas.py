"""Declared input schemas (S4), corrected and actually applied by the readers.

Identifier columns are 64-bit: at the target scale display ids overflow int.
``nullable=False`` marks columns whose nulls the readers' ``invalid`` policy deals
with.  The column names are fixed values, the contract of the inputs.
"""

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)

EVENT_SCHEMA = StructType([
    StructField("display_id", LongType(), False),
    StructField("uuid", StringType(), False),
    StructField("document_id", LongType(), False),
    StructField("timestamp", LongType(), False),
    StructField("platform", IntegerType(), False),
    StructField("geo_location", StringType(), False),
])

# Columns the job uses: (display_id, ad_id, clicked).
TRAIN_SCHEMA = StructType([
    StructField("display_id", LongType(), False),
    StructField("ad_id", LongType(), False),
    StructField("clicked", IntegerType(), False),
])

# Ad dimension; the campaign column is ``campaign_id``.
PROMOTED_CONTENT_SCHEMA = StructType([
    StructField("ad_id", LongType(), False),
    StructField("document_id", LongType(), False),
    StructField("campaign_id", IntegerType(), False),
    StructField("advertiser_id", IntegerType(), False),
])

SCHEMAS = {
    "event": EVENT_SCHEMA,
    "train": TRAIN_SCHEMA,
    "promoted_content": PROMOTED_CONTENT_SCHEMA,
}
