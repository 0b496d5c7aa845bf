"""Schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


_TEXT, _INT, _DAY, _REAL = T.StringType(), T.IntegerType(), T.DateType(), T.DoubleType()
_INSTANT, _SENSOR = T.TimestampNTZType(), T.DecimalType(10, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


MATERIAL = _struct(material_id=_TEXT, material_name=_TEXT, material_type=_TEXT, category=_TEXT)
TIME_MEMBER = _struct(year=_INT, quarter=_INT, month=_INT, day=_INT, is_month=T.BooleanType())
PLAN_FACT = _struct(
    version=_TEXT, material_id=_TEXT, month=_DAY, measure=_TEXT, value=T.DecimalType(18, 2), inserted_at=_INSTANT
)
# Filters of stored movement keys, in partitions by month.
KEY_FILTER = _struct(
    blocks=T.LongType(), block=T.LongType(), keys=T.LongType(), w0=T.LongType(), w1=T.LongType(), w2=T.LongType(),
    w3=T.LongType(), part_month=_DAY,
)
# The latest state of the plan, in partitions by year, and digests of its versions.
PART_YEAR = "part_year"
PLAN_STATE = _struct(
    material_id=_TEXT, month=_DAY, measure=_TEXT, value=T.DecimalType(18, 2), version=_TEXT, inserted_at=_INSTANT,
    part_year=_INT,
)
SHUTDOWN_STATE = _struct(day=_DAY, measure=_TEXT, hours=_REAL, version=_TEXT, inserted_at=_INSTANT, part_year=_INT)
_DIGEST = dict(
    month=_DAY, measure=_TEXT, cells=T.LongType(), low=T.DecimalType(38, 0), high=T.DecimalType(38, 0)
)
STATE_DIGEST = _struct(**_DIGEST)
VERSION_DIGEST = _struct(version=_TEXT, **_DIGEST)
SHUTDOWN_FACT = _struct(version=_TEXT, day=_DAY, measure=_TEXT, hours=_REAL, inserted_at=_INSTANT)
MOVEMENT = _struct(doc_id=_TEXT, material_id=_TEXT, label=_TEXT, day=_DAY, cls=_TEXT, place=_INT, kg=_REAL)
TELEMETRY = _struct(
    ts=_INSTANT, run_flag=_SENSOR, feed=_SENSOR, coal=_SENSOR, dust_set=_SENSOR, humidity=_SENSOR,
    dust_out=_SENSOR, slag=_SENSOR,
)
# Facts with a day or an instant are stored in partitions of this month column.
PART_MONTH = "part_month"

LEDGER = _struct(source_file=_TEXT, loaded_at=_INSTANT)

# --- fixed values: columns of the movement feed, by type -------------------------------------
MOVEMENT_FEED_COLUMNS = (
    "BpzIdt", "MatIdt", "KeziBez", "ChgNmr", "BpdSort", "MatArt", "KstUrsache", "PrzPre",
    "LgrDW", "AbrSammler", "BucPer", "VrgGrp", "MngEinhIdt", "BucDat", "KwBezJahr_de",
    "KwBezMon_de", "LOrtIdt", "LOrtBez", "LPlzIdt", "LPlzBez", "LgrFirmIdt", "LgrFirmName",
    "MngW", "MngD", "Pb", "Ag", "Au", "Cu", "S", "Zn", "FeO", "SiO2", "CaO", "As", "Sb", "Bi",
    "Se", "Cl", "Cd",
)
MOVEMENT_FEED_INTS = ("VrgGrp", "MngEinhIdt", "LOrtIdt", "LPlzIdt", "LgrFirmIdt")
MOVEMENT_FEED_DATES = ("BucDat",)
MOVEMENT_FEED_FLOATS = (
    "MngW", "MngD", "Pb", "Ag", "Au", "Cu", "S", "Zn", "FeO", "SiO2", "CaO", "As", "Sb", "Bi",
    "Se", "Cl", "Cd",
)
MOVEMENT_FEED_MASSES = ("MngW", "MngD")
MOVEMENT_FEED_UNCLEANED = ("BucPer",)

# --- fixed values: columns of the telemetry feed, by position, with the names used here -------
TELEMETRY_FEED = {
    "Zeitstempel": "ts",
    "ANZEIGEREAKTORINBETRIEB": "run_flag",
    "MATERIALAUFGABEREAKTOR": "feed",
    "FEINKOHLEDOSIERUNG": "coal",
    "SOLLWERTFUERFLUGSTAUB": "dust_set",
    "FEUCHTEREGELUNG": "humidity",
    "AustragFlugstaubmenge21B001": "dust_out",
    "SchlackeSchlackenstich": "slag",
}
# ----------------------------------------------------------------------------------------------
