"""Table schemas. Absent and null are the same thing everywhere."""

from __future__ import annotations

from pyspark.sql import types as T


def _columns(names: str, kind: T.DataType) -> dict[str, T.DataType]:
    return {name: kind for name in names.split()}


def _table(order: str, *typed: dict[str, T.DataType]) -> T.StructType:
    """Columns in ``order``; those without a listed type are text."""
    kinds = {name: kind for group in typed for name, kind in group.items()}
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in order.split()])


TEXT_LIST = T.ArrayType(T.StringType())

PROPERTY_INDEX = _table(
    """vendor type property_id link listing_type created_date last_indexed_date last_crawled_date
    property_size_raw property_size property_size_unit property_price_raw property_price
    property_price_unit property_area posted_date""",
    _columns("created_date last_indexed_date last_crawled_date", T.TimestampType()),
    _columns("property_size property_price", T.DoubleType()),
)

LISTING = _table(
    """key vendor type property_id link crawled_date posted_date expire_date title description address
    area ward district city price_raw price price_unit price_per_sqm property_size_raw property_size
    property_size_unit distance_to_road frontage ownership_certificate road_width num_floors
    num_bedrooms num_bathrooms house_orientation balcony_orientation furniture images videos
    listing_type contact_name contact_address contact_phone contact_mobile contact_email contact_link
    project_name project_owner project_scale project_link""",
    _columns("crawled_date", T.TimestampType()),
    _columns(
        """price price_per_sqm property_size distance_to_road frontage num_floors num_bedrooms
        num_bathrooms""",
        T.DoubleType(),
    ),
    _columns("images videos", TEXT_LIST),
)

FETCH_CHECK = _table(
    "status date ip", _columns("status", T.IntegerType()), _columns("date", T.TimestampType())
)
JOBS = _table("host job_id state start_time end_time", _columns("start_time end_time", T.TimestampType()))
SEEDS = _table(
    "spider vendor max_depth start_index crawl_urls",
    _columns("max_depth start_index", T.IntegerType()),
    _columns("crawl_urls", T.MapType(T.StringType(), TEXT_LIST)),
)
TASKS = _table("spider vendor types", _columns("types", TEXT_LIST))

INDEX_KEYS = ["vendor", "type", "property_id"]
# Non-key columns an index insert writes; last_crawled_date is left to the claim step.
INDEX_INSERTED = [
    "created_date", "listing_type", "last_indexed_date", "property_size_raw", "property_size",
    "property_size_unit", "property_price_raw", "property_price", "property_price_unit",
    "property_area", "posted_date", "link",
]
CONTACT_COLUMNS = [
    "contact_name", "contact_address", "contact_phone", "contact_mobile", "contact_email", "contact_link",
]

# One parsed page: elements and text nodes, numbered together in document order.
# A node n lies inside element e exactly when e.seq < n.seq <= e.end_seq. Arrays are in that order too, so what lies
# inside e is one run of each: ``size`` elements after e's own ``place``, ``n_texts`` texts from ``text_place``.
# ``own`` has the places of the texts directly below e. Places count from 1.
ELEMENT = _table(
    "seq end_seq parent_seq tag id class_attr classes attrs own_text place size text_place n_texts own",
    _columns("seq end_seq parent_seq", T.LongType()),
    _columns("place size text_place n_texts", T.IntegerType()),
    _columns("classes", TEXT_LIST),
    _columns("attrs", T.MapType(T.StringType(), T.StringType())),
    _columns("own", T.ArrayType(T.IntegerType())),
)
TEXT_NODE = _table("seq parent_seq text", _columns("seq parent_seq", T.LongType()))
