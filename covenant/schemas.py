"""Row types shared by sources, operators and sinks."""

from pyspark.sql import types as T

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
HEADERS = T.ArrayType(HEADER)

MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)

ENVELOPE = T.StructType(
    MESSAGE.fields
    + [
        T.StructField("payload_checksum", T.StringType()),
        T.StructField("checksum_algorithm", T.StringType()),
    ]
)

ATTRIBUTES = "array<struct<name:string,value:string>>"

CHUNK = T.StructType(
    [
        T.StructField("file_sequence_id", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("total_chunks", T.IntegerType()),
        T.StructField("is_last_chunk", T.BooleanType()),
        T.StructField("chunk_data", T.BinaryType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_checksum", T.StringType()),
    ]
)

# The field names of the JSON file reference and of the grants and consumer documents.
FILE_REQUEST = "sourceType string, storageContainer string, path string"

_ATTRIBUTE_JSON = "struct<name:string,value:string,type:string>"
_CONSUMER_JSON = (
    "struct<name:string,idpClientId:string,scheduleType:string,scheduleExpression:string,"
    f"attributes:array<{_ATTRIBUTE_JSON}>>"
)
_CONFIGURATION_JSON = (
    "struct<productId:bigint,consumerId:bigint,grantedTs:timestamp,validity:decimal(10,0),scheduleType:string,"
    f"scheduleExpression:string,destination:string,attributes:array<{_ATTRIBUTE_JSON}>>"
)
_PRODUCT_JSON = (
    "struct<name:string,topic:string,source:string,type:string,"
    f"consumers:array<{_CONSUMER_JSON}>,configurations:array<{_CONFIGURATION_JSON}>>"
)
_PRODUCER_JSON = (
    "struct<name:string,description:string,active:boolean,host:string,port:decimal(10,0),tls:boolean,"
    f"idpClientId:string,products:array<{_PRODUCT_JSON}>>"
)
PRODUCERS = f"array<{_PRODUCER_JSON}>"
GRANTS_DOCUMENT = f"clientId string, producers {PRODUCERS}"
CONSUMER_DOCUMENT = (
    f"clientId string, name string, scheduleType string, scheduleExpression string, producers {PRODUCERS}"
)

PROGRESS = T.StructType(
    [
        T.StructField("client", T.StringType()),
        T.StructField("server", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("run", T.LongType()),
    ]
)
