"""Views that give the driver's parquet tables the shape of the accident data.

The ``events`` table stands in for accidents: a grid point derived from the
event id (inside the tile grid, rows K..X and columns 2..6), the weekday of
the event time, and deterministic shares of rows with X missing or NaN, Y
missing, a blank or unknown weekday, or no event type, so that the dirty-data
paths are exercised. All of it is plain column arithmetic over the
whole table, so it scales with the input and Catalyst prunes the scan to
``event_id, ts`` (plus ``event_type`` where labels are used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.cyclic import WEEKDAY_NAMES, weekday_number
from tessera.sources.local import literal_table
from tessera.sources.schemas import ACCIDENT_FIELDS, position_of

_LINE = T.StructType([T.StructField("value", T.StringType())])

# Fixed values of the fixture view (shared with the SQL oracles).
X_BASE, X_MULT, X_SPAN = 100000, 7919, 600000
Y_BASE, Y_MULT, Y_SPAN = 6600000, 104729, 1150000
MISSING_X_EVERY = 97
NAN_X_EVERY = 101
MISSING_Y_EVERY = 89
BLANK_DAY_EVERY = 83
UNKNOWN_DAY_EVERY = 79
UNKNOWN_DAY = "Juhannus"
NO_TYPE_EVERY = 73


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _x(eid):
    x = (F.lit(X_BASE) + (eid * X_MULT) % X_SPAN).cast("double")
    return F.when(eid % MISSING_X_EVERY != 0, F.when(eid % NAN_X_EVERY == 0, F.lit(float("nan"))).otherwise(x))


def _y(eid):
    return F.when(eid % MISSING_Y_EVERY != 0, F.lit(Y_BASE) + (eid * Y_MULT) % Y_SPAN).cast("double")


def _type(eid):
    return F.when(eid % NO_TYPE_EVERY != 0, F.col("event_type"))


def weekday_name(ts, eid=None) -> F.Column:
    name = F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), weekday_number(ts))
    if eid is None:
        return name
    return F.when(eid % BLANK_DAY_EVERY == 0, F.lit(" ")).when(eid % UNKNOWN_DAY_EVERY == 0, F.lit(UNKNOWN_DAY)).otherwise(name)


def _whole(c):
    """Digits of a whole-metre coordinate, NaN as text, empty when missing."""
    return F.when(c.isNull(), F.lit("")).when(F.isnan(c), F.lit("NaN")).otherwise(c.cast("bigint").cast("string"))


def accident_points(spark: SparkSession, sf_dir: str, with_type: bool = False) -> DataFrame:
    """(id, X, Y, Vkpv[, event_type]) over the whole events table."""
    ev = table(spark, sf_dir, "events").where(F.col("event_id").isNotNull())
    eid = F.col("event_id")
    cols = [eid.alias("id"), _x(eid).alias("X"), _y(eid).alias("Y"), weekday_name("ts", eid).alias("Vkpv")]
    if with_type:
        cols.append(_type(eid).alias("event_type"))
    return ev.select(*cols)


def accident_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a full 102-column accident table (id, weekday name, X, Y
    filled in; other columns null), typed by the accident schema."""
    from tessera.sources.schemas import ACCIDENT_SCHEMA
    pts = accident_points(spark, sf_dir)
    filled = {"Onnett_id": F.col("id").cast("int"), "Vkpv": F.col("Vkpv"), "X": F.col("X"), "Y": F.col("Y")}
    return pts.select(*[(filled.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
                        for f in ACCIDENT_SCHEMA.fields])


def accident_lines(spark: SparkSession, sf_dir: str, with_header: bool = True) -> DataFrame:
    """Raw ``;``-separated lines in the accident table's 102-field layout, one
    per event (id, weekday name, X, Y at their positions; other fields empty)."""
    pts = accident_points(spark, sf_dir)
    at = {0: F.col("id").cast("string"), position_of("Vkpv"): F.col("Vkpv"),
          position_of("X"): _whole(F.col("X")), position_of("Y"): _whole(F.col("Y"))}
    fields = [at.get(i, F.lit("")) for i in range(len(ACCIDENT_FIELDS))]
    lines = pts.select(F.concat_ws(";", *fields).alias("value"))
    if with_header:
        header = ";".join(n for n, _ in ACCIDENT_FIELDS)
        lines = literal_table(spark, [(header,)], _LINE).unionByName(lines)
    return lines


def coordinate_lines(spark: SparkSession, sf_dir: str, parts: int = 4) -> DataFrame:
    """``x,y[,label]`` lines for ``parts`` files, each beginning with a header
    line: label = event type except for views and events without one (two
    fields only); events without X give a one-field line."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    x, y, kind = _x(eid), _y(eid), _type(eid)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    line = (F.when(x.isNull(), text(y))
            .when(F.coalesce(kind, F.lit("view")) == "view", F.concat_ws(",", text(x), text(y)))
            .otherwise(F.concat_ws(", ", text(x), text(y), kind)))
    body = ev.select(F.pmod(eid, F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("rank"), line.alias("value"))
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("value", T.StringType())])
    heads = literal_table(spark, [(k, 0, "X , Y, label") for k in range(parts)], schema)
    return heads.unionByName(body).repartition(parts, "part").sortWithinPartitions("rank").select("value")


# Shares of the described tables' rows that break a rule.
NO_ACCIDENT_EVERY, NO_PARTY_EVERY, TWICE_EVERY, NO_KEY_EVERY = 97, 53, 211, 199


def described_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The accident, party and person tables, whole in their columns: orders
    are accidents, their lines parties with a person each. Some accidents and
    parties are missing, some parties are there twice or lack their number."""
    from tessera.sources.schemas import ACCIDENT_SCHEMA, PARTY_SCHEMA, PERSON_SCHEMA

    def shaped(df: DataFrame, schema: T.StructType, **filled) -> DataFrame:
        return df.select(*[filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    party = lines.where((order + line) % NO_PARTY_EVERY != 0)
    party = party.unionByName(party.where(order % TWICE_EVERY == 0))
    number = F.when(F.col("l_partkey") % NO_KEY_EVERY != 0, line)
    return {
        "accident": shaped(orders.where(F.col("o_orderkey") % NO_ACCIDENT_EVERY != 0), ACCIDENT_SCHEMA,
                           Onnett_id=F.col("o_orderkey"), Vuosi=F.year("o_orderdate")),
        "party": shaped(party, PARTY_SCHEMA, Onnett_id=order, Osall_id=number, Osnro=line),
        "person": shaped(lines, PERSON_SCHEMA, Onnett_id=order, Osall_id=line, Henkilo_id=order * 8 + line),
    }
