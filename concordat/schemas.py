"""Record layouts and the fixed values every module shares."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Column names, status words, weights and thresholds of the data model.
CLIENT_COLUMNS = (
    "client_id",
    "entity_name",
    "entity_lei",
    "country",
    "legal_form",
    "contact_email",
    "contact_phone",
)
REGISTRY_COLUMNS = ("lei", "name", "country", "legal_form", "status", "registration_authority")

VERIFIED = "VERIFIED"
MISMATCH = "MISMATCH"
INACTIVE = "INACTIVE"
MISSING = "MISSING"
UNVERIFIED = "UNVERIFIED"
ACTIVE_REGISTRATION = "ACTIVE"
UNMATCHED = (MISMATCH, MISSING, UNVERIFIED)

# Score weights in tenths, so that sums are exact.
NAME_TENTHS = 4
COUNTRY_TENTHS = 2
LEGAL_FORM_TENTHS = 2
ACTIVE_TENTHS = 2
NOT_FOUND_TENTHS = 1

MIN_OVERALL_SCORE = 0.7
MAX_MISSING_SHARE = 0.1
MAX_INACTIVE_SHARE = 0.05
MIN_CONFIDENCE = 0.80

LOOKUP_BATCH = 200
STAGED_LIMIT = 50000
LISTING_LIMIT = 1000
CANDIDATES = 5
# End of fixed values.

CLIENT = T.StructType(_strings(*CLIENT_COLUMNS))
REGISTRY = T.StructType(_strings(*REGISTRY_COLUMNS))

STAGED = T.StructType([*CLIENT.fields, T.StructField("ingested_at", T.TimestampType())])

RESULT = T.StructType(
    [
        *_strings("client_id", "entity_lei", "entity_name", "verification_status"),
        T.StructField("name_match", T.BooleanType()),
        T.StructField("country_match", T.BooleanType()),
        T.StructField("legal_form_match", T.BooleanType()),
        *_strings("lei_status"),
        T.StructField("issues", T.ArrayType(T.StringType())),
        *_strings("gleif_name", "gleif_country"),
        T.StructField("quality_score", T.DoubleType()),
    ]
)
RESULT_COLUMNS = tuple(RESULT.fieldNames())

CURATED = T.StructType([*RESULT.fields, T.StructField("processed_at", T.TimestampType())])
CURATED_COLUMNS = tuple(CURATED.fieldNames())

HISTORY = T.StructType(
    [
        *_strings("run_id"),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("verified", T.LongType()),
        T.StructField("mismatched", T.LongType()),
        T.StructField("inactive", T.LongType()),
        T.StructField("missing", T.LongType()),
        T.StructField("overall_score", T.DoubleType()),
    ]
)

REGISTRY_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "attributes",
            T.StructType(
                [
                    T.StructField(
                        "entity",
                        T.StructType(
                            [
                                T.StructField("legalName", T.StructType(_strings("name"))),
                                T.StructField("legalAddress", T.StructType(_strings("country"))),
                                T.StructField("legalForm", T.StructType(_strings("name"))),
                            ]
                        ),
                    ),
                    T.StructField("registration", T.StructType(_strings("status"))),
                    T.StructField("registrationAuthority", T.StructType(_strings("id"))),
                ]
            ),
        ),
    ]
)
REGISTRY_PAGE = T.StructType([T.StructField("data", T.ArrayType(REGISTRY_RECORD))])
