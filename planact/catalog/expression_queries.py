"""Scalar expressions and predicates, applied to whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.catalog import sql as q
from planact.catalog.core import query
from planact.functions import compare, dates, display, rounding
from planact.functions import materials as mat
from planact.operators import actuals, telemetry
from planact.operators import calendar as cal
from planact.sources import star_views as sv

# Every part key in one of the shapes ids come in: plain, too short, wrong first digit, suffixed.
_IDS_SQL = """v_ids as (
select p_partkey, case p_partkey % 8
  when 0 then '1' || lpad(cast(p_partkey as varchar), 6, '0')
  when 1 then '1' || lpad(cast(p_partkey as varchar), 5, '0')
  when 2 then '2' || lpad(cast(p_partkey as varchar), 6, '0')
  when 3 then '12' || lpad(cast(p_partkey as varchar), 5, '1') || '-b'
  when 4 then '11' || lpad(cast(p_partkey as varchar), 5, '0') || '-H1'
  when 5 then '13' || lpad(cast(p_partkey as varchar), 5, '0') || '-H2'
  when 6 then '1' || lpad(cast(p_partkey as varchar), 4, '0') || '-b'
  else null end id from part)"""


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")

    def shaped(prefix: str, width: int, fill: str = "0", suffix: str = ""):
        return F.concat(F.lit(prefix), F.lpad(key, width, fill), F.lit(suffix))

    shape = F.col("p_partkey") % 8
    shaped_id = (
        F.when(shape == 0, shaped("1", 6))
        .when(shape == 1, shaped("1", 5))
        .when(shape == 2, shaped("2", 6))
        .when(shape == 3, shaped("12", 5, "1", "-b"))
        .when(shape == 4, shaped("11", 5, "0", "-H1"))
        .when(shape == 5, shaped("13", 5, "0", "-H2"))
        .when(shape == 6, shaped("1", 4, "0", "-b"))
    )
    return sv.table(spark, sf, "part").select("p_partkey", shaped_id.alias("id"))


@query(
    "valid_material_ids",
    q.with_(_IDS_SQL)
    + r"""select p_partkey, id, case when id is null then 0
when regexp_matches(id, '^1[0-9]{6}$') then 1
when (contains(id, '-b') or contains(id, '-H1') or contains(id, '-H2')) and length(split_part(id, '-', 1)) = 7 then 1
else 0 end is_valid from v_ids""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(spark, sf).withColumn("is_valid", mat.is_valid_material_id(F.col("id")))


@query(
    "classified_materials",
    q.with_(_IDS_SQL)
    + """select p_partkey, case when starts_with(id, '11') then 'Cons' when starts_with(id, '121') then 'Paste'
else 'Others' end material_type, substr(id, 1, 2) || substr(id, 4, 1) || substr(id, 6) short_id,
case when starts_with(id, '1') then substr(id, 1, 2) || substr(id, 4, 1) || substr(id, 6) else id end short_if_one
from v_ids""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("id")
    return _ids(spark, sf).select(
        "p_partkey",
        mat.material_type_of(c).alias("material_type"),
        mat.normalize_material_id(c).alias("short_id"),
        mat.normalize_material_id(c, only_leading_one=True).alias("short_if_one"),
    )


@query(
    "selected_materials",
    q.with_(q.MATERIAL)
    + """select material_id, material_name, material_type, category from v_material
where lower(material_type) = 'others' and upper(category) in ('OX', 'RI')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Type and categories given in another case than stored."""
    return actuals.select_materials(sv.materials(spark, sf), actuals.Selection("OTHERS", (" ox", "ri ")))


@query(
    "movements_in_interval",
    q.with_(q.MOVEMENT)
    + f"""select doc_id, material_id, {q.DAY}, cls, place, cast(kg as double) kg from v_movement
where day between date '1997-03-15' and date '1999-02-10' and place in (53, 55)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = cal.in_interval(sv.movements(spark, sf), "1997-03-15", "1999-02-10").where(actuals.both_places())
    return rows.select("doc_id", "material_id", "day", "cls", "place", "kg")


@query(
    "telemetry_in_report_range",
    q.with_(q.TELEMETRY)
    + """select strftime(ts, '%Y-%m-%d %H:%M:%S') ts, run_flag::double run_flag, cast(feed as double) feed from v_telemetry
where cast(ts as date) between date '1998-01-01' and date '1998-02-01'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.in_report_range(sv.telemetry(spark, sf), "1998-01-17").select("ts", "run_flag", "feed")


@query(
    "production_days",
    q.with_(q.TELEMETRY)
    + """select strftime(cast(case when hour(ts) < 6 then ts - interval 1 day else ts end as date), '%Y-%m-%d') as day,
hour(ts) as hour, count(*) as rows from v_telemetry group by 1, 2""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return (
        sv.telemetry(spark, sf)
        .groupBy(dates.production_day(F.col("ts")).alias("day"), F.hour("ts").alias("hour"))
        .agg(F.count("*").alias("rows"))
    )


# Dates as text, one priority written the German way, one unreadable.
_TEXT_DATES_SQL = """v_text as (
select o_orderkey, case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y-%m-%d')
  when '2-HIGH' then 'n/a' else strftime(o_orderdate, '%d.%m.%Y') end txt from orders)"""


@query(
    "parsed_dates",
    q.with_(_TEXT_DATES_SQL)
    + """select o_orderkey, txt, strftime(d, '%Y-%m-%d') as day, strftime(d, '%d.%m.%Y') german, year(d) as year,
quarter(d) as quarter, month(d) as month, day(d) as day_of_month, strftime(date_trunc('month', d), '%Y-%m-%d') month_start,
strftime(last_day(d), '%Y-%m-%d') month_end from (
select *, cast(try_strptime(txt, '%d.%m.%Y') as date) d from v_text)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    urgency, day = F.col("o_orderpriority"), F.to_date("o_orderdate")
    text = (
        F.when(urgency == "1-URGENT", display.iso_day(day))
        .when(urgency == "2-HIGH", F.lit("n/a"))
        .otherwise(display.german_day(day))
    )
    rows = sv.table(spark, sf, "orders").select("o_orderkey", text.alias("txt"))
    d = F.col("d")
    return rows.withColumn("d", dates.parse_date(F.col("txt"))).select(
        "o_orderkey",
        "txt",
        d.alias("day"),
        display.german_day(d).alias("german"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.month_start(d).alias("month_start"),
        F.last_day(d).alias("month_end"),
    )


@query(
    "hours_to_month_end",
    """select o_orderkey, date_diff('second', o_orderdate, cast(last_day(o_orderdate) as timestamp) + interval 1 day)
/ 3600.0::double as hours, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') from_parts
from orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    end = F.date_add(F.last_day("o_orderdate"), 1).cast("timestamp_ntz")
    return sv.table(spark, sf, "orders").select(
        "o_orderkey",
        (dates.seconds_between(F.col("o_orderdate"), end) / 3600).alias("hours"),
        dates.date_from_parts(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("from_parts"),
    )


@query(
    "close_values",
    """select l_orderkey, l_linenumber, l_extendedprice, case
when coalesce(a, 0) = 0 and coalesce(b, 0) = 0 then 0 when a is null or b is null then 1
when abs(a - b) <= 1e-5 * greatest(abs(a), abs(b)) then 0 else 1 end changed from (
select l_orderkey, l_linenumber, l_extendedprice,
case when l_linenumber = 1 then null when l_linenumber = 2 then 0 else l_extendedprice end a,
case when l_discount = 0 then null when l_tax = 0 then l_extendedprice + 0.01
     else l_extendedprice + l_extendedprice * l_tax * 0.00025 end b from lineitem)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    a = F.when(F.col("l_linenumber") == 1, F.lit(None)).when(F.col("l_linenumber") == 2, F.lit(0.0)).otherwise(price)
    b = (
        F.when(F.col("l_discount") == 0, F.lit(None))
        .when(F.col("l_tax") == 0, price + 0.01)
        .otherwise(price + price * F.col("l_tax") * 0.00025)
    )
    return sv.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", compare.value_changed(a, b).alias("changed")
    )


@query(
    "half_even_rounding",
    q.with_("v_c as (select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18,2)) p, "
            "cast(l_extendedprice * 0.0125 as decimal(18,4)) s from lineitem)")
    + """select l_orderkey, l_linenumber, cast(p as double) price, cast(round_even(p, 0) as double) r0,
cast(round_even(p, 1) as double) r1, cast(round_even(s, 2) as double) r2, cast(round_even(s, 3) as double) r3 from v_c""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    small = (F.col("l_extendedprice") * 0.0125).cast("decimal(18,4)")
    return sv.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        price.alias("price"),
        *[rounding.half_even(price, n).alias(f"r{n}") for n in (0, 1)],
        *[rounding.half_even(small, n).alias(f"r{n}") for n in (2, 3)],
    )


@query(
    "tons_and_shares",
    q.with_(q.MOVEMENT)
    + f"""select doc_id, {q.DAY}, cast(kg as double) kg, cast(round_even(abs(kg) * 0.001, 1) as double) abs_tons,
cast(round_even(kg * 0.001, 1) as double) tons, cast(round_even(abs(kg) * 0.001, 0) as bigint) whole_tons,
cast({q.share("cast(round_even(abs(kg) * 0.001, 1) * 10 as hugeint)", "cast(round_even(abs(kg) * 0.001, 0) as hugeint)")}
as double) / 10 pct from v_movement""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Each movement in tons, and its tenths as a share of its whole tons."""
    rows = sv.movements(spark, sf).withColumn("mg", rounding.milligrams("kg"))
    rows = rows.select(
        "*",
        rounding.abs_tenth_tons("mg").alias("tenths"),
        rounding.signed_tenth_tons("mg").alias("signed"),
        rounding.abs_whole_tons("mg").alias("whole_tons"),
    )
    return rows.select(
        "doc_id",
        "day",
        "kg",
        rounding.tenths_to_decimal("tenths").alias("abs_tons"),
        rounding.tenths_to_decimal("signed").alias("tons"),
        "whole_tons",
        rounding.percentage("tenths", "whole_tons").alias("pct"),
    )


@query(
    "display_texts",
    q.with_(q.MOVEMENT)
    + f"""select doc_id, {q.DAY}, strftime(day, '%d.%m.%Y') german, cast(cast(round_even(abs(kg), 0) as bigint) as varchar) whole,
cast(cast(round_even(abs(kg), 0) as bigint) as varchar) || ' t' tons,
case when place = 55 then cast(cast(round_even(abs(kg) * 0.001, 1) as decimal(30,1)) as varchar) || ' %' else '0 %' end pct
from v_movement""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.abs("kg").cast("decimal(18,3)")
    thousandth = (amount * F.expr("0.001BD")).cast("decimal(18,6)")
    return sv.movements(spark, sf).select(
        "doc_id",
        "day",
        display.german_day(F.col("day")).alias("german"),
        display.whole(amount).alias("whole"),
        display.tons(amount).alias("tons"),
        display.percent(thousandth, F.col("place") == 55).alias("pct"),
    )
