"""Price files and nested zonal price documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import to_num
from ..functions.timecols import parse_ts
from ..session import stage

# The two fields that mark a price record.
ZONE_FIELD, PRICE_FIELD = "Zone", "Price"

PRICE_CSV_SCHEMA = "`italian datetime` string, `datetime` string, price string"


def read_price_csv(spark: SparkSession, path: str, partition_schema: str = "zone string") -> DataFrame:
    """Price rows as text, one folder per zone (``zone=...``)."""
    return spark.read.schema(f"{PRICE_CSV_SCHEMA}, {partition_schema}").csv(path, header=True)


def coerce_prices(raw: DataFrame) -> DataFrame:
    """Text to typed prices; rows whose stamp or price cannot be read are dropped."""
    return raw.select(
        "zone", parse_ts("datetime").alias("ts"), to_num("price").alias("price")
    ).where(F.col("ts").isNotNull() & F.col("price").isNotNull())


# The walk opens one level at a time, as SQL over ``{src}``. A node that is an object with both fields is a hit; any
# other node gives way to those of its children that can hold records. Paths keep document order, and ``first_of`` the
# list whose first element the node is.
_OPEN = "(left({0}, 1) = '[' OR left({0}, 1) = chr(123))"
_MARK = f"""SELECT {{by}}, node, path, first_of, arr, obj,
    coalesce(map_contains_key(obj, '{ZONE_FIELD}') AND map_contains_key(obj, '{PRICE_FIELD}'), false) AS hit
  FROM (SELECT *, CASE WHEN left(node, 1) = '[' THEN from_json(node, 'array<string>') END AS arr,
    CASE WHEN left(node, 1) = chr(123) THEN from_json(node, 'map<string,string>') END AS obj FROM ({{src}}))"""
_CHILDREN = f"""SELECT {{by}}, s.node, s.path, s.first_of FROM (SELECT {{by}}, explode(filter(
    transform(coalesce(arr, map_values(obj), array()), (c, i) -> named_struct('node', ltrim(c), 'path', concat(path, array(i)),
      'first_of', CASE WHEN i = 0 AND arr IS NOT NULL THEN node END)), c -> {_OPEN.format("c.node")})) AS s FROM {{open}} WHERE NOT hit)"""


def first_records(docs: DataFrame, keys: Sequence[str], doc: str) -> DataFrame:
    """(keys, node, first_of) of the first match, depth-first, of every document that has one.

    Each level of nesting is one kept table, and the walk ends when a level leaves nothing to open, at any depth.
    """
    spark, by = docs.sparkSession, ", ".join(f"`{k}`" for k in keys)
    mark = _MARK.format(by=by, src="SELECT * FROM {src}")
    roots = docs.selectExpr(*[f"`{k}`" for k in keys], f"ltrim(`{doc}`) AS node", "CAST(array() AS ARRAY<INT>) AS path", "CAST(NULL AS STRING) AS first_of")
    level, hits = stage(spark.sql(mark, src=roots), "json-level"), None
    while True:
        found = level.where("hit").select(*keys, "node", "path", "first_of")
        hits = found if hits is None else hits.unionByName(found)
        level = stage(spark.sql(mark, src=spark.sql(_CHILDREN.format(by=by, open="{open}"), open=level)), "json-level")
        if level.isEmpty():
            return hits.groupBy(*keys).agg(F.min_by(F.struct("node", "first_of"), "path").alias("m"))


def extract_zone_prices(docs: DataFrame, keys: Sequence[str] = ("doc_id",), doc: str = "doc", missing: str = "raise") -> DataFrame:
    """Price records at any depth of JSON documents, in document order.

    The match that comes first depth-first wins: a list whose first element has both fields gives all its elements, an
    object with both fields gives itself. Documents without a match raise when they are read, or give no rows with
    ``missing="skip"``.
    """
    record = f"struct<{ZONE_FIELD}:string,{PRICE_FIELD}:string>"
    found = first_records(docs, keys, doc)
    if missing == "raise":
        found = docs.select(*keys).distinct().join(found, list(keys), "left")
    opened = found.selectExpr(
        *[f"`{k}`" for k in keys],
        f"""posexplode(CASE WHEN m IS NULL THEN raise_error('document without {ZONE_FIELD}/{PRICE_FIELD} records')
          WHEN m.first_of IS NOT NULL THEN from_json(m.first_of, 'array<{record}>')
          ELSE array(from_json(m.node, '{record}')) END) AS (position, r)""",
    )
    return opened.select(*keys, "position", F.col(f"r.{ZONE_FIELD}").alias("zone"), to_num(f"r.{PRICE_FIELD}").alias("price"))
