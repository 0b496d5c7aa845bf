"""Feeds: the test tables are written as landed files and read back through the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact import schemas
from planact.catalog import sql as q
from planact.catalog.core import query
from planact.functions import cleaning, dates
from planact.operators import plan
from planact.plans import feed_loads, plan_load
from planact.session import scratch_path, stage, staging
from planact.sinks import tables as sink
from planact.sources import grids, ledger, movements, records, telemetry
from planact.sources import star_views as sv
from planact.streaming import ingest

YEARS = (1996, 1997, 1998, 1999)
_YEARS_SQL = ", ".join(str(y) for y in YEARS)
_VERSION = "V1"

# Sheets carry seven-digit ids led by the material type; keys too long for that go into a suffix.
_PREFIX_SQL = "case material_type when 'Cons' then '11' when 'Paste' then '121' else '13' end"
_SHEET_ID_SQL = (
    f"(case when length(material_id) <= 7 - length({_PREFIX_SQL}) "
    f"then {_PREFIX_SQL} || lpad(material_id, cast(7 - length({_PREFIX_SQL}) as int), '0') "
    f"else rpad({_PREFIX_SQL}, 7, '0') || '-b' || material_id end)"
)


def _sheet_id():
    kind = F.col("material_type")
    prefix = F.when(kind == "Cons", "11").when(kind == "Paste", "121").otherwise("13")
    width = F.lit(7) - F.length(prefix)
    plain_id = F.concat(prefix, F.lpad("material_id", width, F.lit("0")))
    return F.when(F.length("material_id") <= width, plain_id).otherwise(
        F.concat(F.rpad(prefix, 7, "0"), F.lit("-b"), F.col("material_id"))
    )


def sheet_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The plan of the version that the sheets show, written once for all of them."""
    return stage(plan.in_version(sv.plan(spark, sf, version=_VERSION), _VERSION), "sheet-plan")


def write_plan_sheet(spark: SparkSession, sf: str, measure: str, folder: str, facts: DataFrame | None = None) -> str:
    """One plan sheet of one version: months as columns, a version cell on top, some bad ids."""
    path = f"{folder}/{measure}"
    facts = (sheet_facts(spark, sf) if facts is None else facts).where(F.col("measure") == measure)
    months = plan.months_of(facts)
    wide = plan.pivot_months(facts, ["material_id"], months, (measure,))
    names = {c: m for m, c in zip(months, plan.month_columns(months, (measure,)))}
    rows = wide.join(sv.materials(spark, sf), "material_id").select(
        "material_name",
        _sheet_id().alias("id"),
        F.lit(None).cast("string").alias("dummy"),
        "category",
        *[F.col(c).cast("string").alias(f"{m} 00:00:00") for c, m in names.items()],
    )
    spare = [F.lit(None).cast("string").alias(c) for c in rows.columns[1:]]
    title = spark.range(0, 1, 1, 1).select(F.lit(_VERSION).alias("material_name"), *spare)
    # A material of category P comes a second time, with a bad id.
    ids = F.when(F.col("category") == "P", F.array(F.col("id"), F.substring("id", 2, 6))).otherwise(F.array("id"))
    rows = rows.withColumn("id", F.explode(ids))
    # The title's task is the first and so its file: it is the sheet's first data row.
    title.unionByName(rows).write.option("header", True).csv(path)
    return path


def write_shutdown_sheet(spark: SparkSession, sf: str, measure: str, folder: str) -> str:
    """A shutdown sheet: two header rows, date and hours among other cells, zeros written as text."""
    path = f"{folder}/{measure}_shutdown"
    hours = F.when(F.col("hours") == 0, "none").otherwise(F.col("hours").cast("string"))
    rows = (
        plan.in_version(sv.shutdown(spark, sf), _VERSION)
        .where(F.col("measure") == measure)
        .select(
            F.date_format("day", "dd.MM.yyyy").alias("a"),
            F.lit("x").alias("b"),
            F.lit("").alias("c"),
            F.lit("y").alias("d"),
            hours.alias("e"),
        )
    )
    heads = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(*[F.lit(v).alias(n) for n, v in zip("abcde", cells)])
                    for cells in (["Plan", "", "", "", ""], ["date", "b", "c", "d", "shutdown h"])
                ]
            )
        )
    )
    heads.unionByName(rows).write.csv(path)
    return path


_SHEET_SQL = (
    "v_sheet as (select " + _SHEET_ID_SQL + " material_id, material_type, material_name, category, month, budget, forecast "
    "from v_plan join v_material using (material_id) where version = 'V1')"
)


@query(
    "plan_sheet_rows",
    q.with_(q.MATERIAL, q.PLAN, _SHEET_SQL)
    + f"""select 'V1' as version, k.material_id, strftime(m.month, '%Y-%m-%d') as month, 'budget' measure,
cast(budget as double) as value
from (select distinct material_id from v_sheet) k cross join (select distinct month from v_plan) m
left join v_sheet s on s.material_id = k.material_id and s.month = m.month
where year(m.month) in ({_YEARS_SQL})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Written as a sheet, scanned, ids checked, months found in the headers, unpivoted."""
    folder, facts = scratch_path(spark, "workbook"), sheet_facts(spark, sf)
    forecast = grids.read_plan_grid(spark, write_plan_sheet(spark, sf, plan.FORECAST, folder, facts))
    grid = grids.read_plan_grid(spark, write_plan_sheet(spark, sf, plan.BUDGET, folder, facts))
    return grids.plan_rows(grid, plan.BUDGET, grids.version_of(forecast).scalar(), YEARS)


@query(
    "material_sheet_rows",
    q.with_(q.MATERIAL, q.PLAN, _SHEET_SQL)
    + """select distinct material_id, material_name, case when starts_with(material_id, '11') then 'Cons'
when starts_with(material_id, '121') then 'Paste' else 'Others' end material_type, category from v_sheet""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "workbook")
    return grids.material_rows(grids.read_plan_grid(spark, write_plan_sheet(spark, sf, plan.BUDGET, folder)))


@query(
    "shutdown_sheet_rows",
    q.with_(q.SHUTDOWN)
    + f"select 'V1' as version, {q.DAY}, 'budget' measure, cast(b_hours as double) as hours from v_shutdown "
    f"where version = 'V1' and year(day) in ({_YEARS_SQL})",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = write_shutdown_sheet(spark, sf, plan.BUDGET, scratch_path(spark, "workbook"))
    return grids.read_shutdown_grid(spark, path, plan.BUDGET, F.lit(_VERSION), YEARS)


@query(
    "loaded_workbook",
    q.with_(q.MATERIAL, q.PLAN, q.SHUTDOWN, _SHEET_SQL)
    + f"""select 'budget' measure, count(*) as rows, cast(sum(coalesce(budget, 0)) as double) total, 'plan' kind
from (select distinct material_id from v_sheet) k cross join (select distinct month from v_plan) m
left join v_sheet s on s.material_id = k.material_id and s.month = m.month where year(m.month) in ({_YEARS_SQL})
union all select 'forecast', count(*), cast(sum(coalesce(forecast, 0)) as double), 'plan'
from (select distinct material_id from v_sheet) k cross join (select distinct month from v_plan) m
left join v_sheet s on s.material_id = k.material_id and s.month = m.month where year(m.month) in ({_YEARS_SQL})
union all select 'budget', count(*), cast(sum(b_hours) as double), 'shutdown' from v_shutdown
where version = 'V1' and year(day) in ({_YEARS_SQL})
union all select 'forecast', count(*), cast(sum(f_hours) as double), 'shutdown' from v_shutdown
where version = 'V1' and year(day) in ({_YEARS_SQL})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A whole workbook loaded twice; the second load is refused, as its version is stored."""
    folder, facts = scratch_path(spark, "workbook"), sheet_facts(spark, sf)
    sheets = {m: write_plan_sheet(spark, sf, m, folder, facts) for m in (plan.BUDGET, plan.FORECAST)}
    sheets |= {f"{m}_shutdown": write_shutdown_sheet(spark, sf, m, folder) for m in (plan.BUDGET, plan.FORECAST)}
    store = plan_load.PlanStore(scratch_path(spark, "store"))
    for _ in range(2):
        plan_load.load_workbook(spark, sheets, store, YEARS)
    facts = spark.read.schema(schemas.PLAN_FACT).parquet(store.plan)
    down = spark.read.schema(schemas.SHUTDOWN_FACT).parquet(store.shutdown)

    def summed(df: DataFrame, value: str, kind: str) -> DataFrame:
        return df.groupBy("measure").agg(
            F.count("*").alias("rows"), F.sum(value).cast("double").alias("total"), F.lit(kind).alias("kind")
        )

    return summed(facts, "value", "plan").unionByName(summed(down, "hours", "shutdown"))


@query(
    "second_catalogue",
    q.with_(q.MATERIAL)
    + """select substr(id, 1, 2) || substr(id, 4, 1) || substr(id, 6) material_id, material_name, material_type,
case when category = 'RE' then '' else category end category
from (select '1' || lpad(material_id, 8, '0') id, * from v_material)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "catalogue")
    category = F.when(F.col("category") != "RE", F.col("category"))
    rows = sv.materials(spark, sf).select(
        F.concat(F.lit("1"), F.lpad("material_id", 8, "0")).alias("material_id"),
        "material_name",
        "material_type",
        category.alias("category"),
    )
    rows.write.option("header", True).csv(f"{folder}/sheet")
    plan_load.load_catalogue(spark, f"{folder}/sheet", f"{folder}/table")
    return spark.read.schema(schemas.MATERIAL).parquet(f"{folder}/table")


# --- movement feed ------------------------------------------------------------------------------


_TWO_LINES = ' "two\nlines", one cell'


def _comma(number, digits: int):
    return F.replace(number.cast(f"decimal(20,{digits})").cast("string"), F.lit("."), F.lit(","))


def raw_movements(spark: SparkSession, sf: str) -> DataFrame:
    """The feed as text: quoted headers, decimal commas, gaps, bad numbers and dates."""
    li = sv.table(spark, sf, "lineitem")
    flag, supplier, line = F.col("l_returnflag"), F.col("l_suppkey") % 3, F.col("l_linenumber")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"))
    given = {
        "BpzIdt": key,
        "MatIdt": F.col("l_partkey").cast("string"),
        "KeziBez": F.when(F.col("l_linestatus") == "O", F.concat(F.lit("M"), F.col("l_partkey").cast("string"), F.when(line == 6, _TWO_LINES).otherwise(""))),
        "MatArt": F.when(flag == "R", "ROH").when(flag == "A", "KRSM").otherwise("HIBE"),
        "BucPer": F.when(F.col("l_tax") > 0.04, F.lit("late")),
        "VrgGrp": F.when(line == 1, "abc").otherwise(line.cast("string")),
        "BucDat": F.when(line == 7, "unknown").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")),
        "LPlzIdt": F.when(supplier == 0, "55").when(supplier == 1, "53").otherwise("51"),
        "MngW": F.when(line == 3, "n/a").when(line == 5, "inf").otherwise(_comma(F.col("l_quantity"), 1)),
        "MngD": _comma(-F.col("l_quantity") * sv.KG_PER_UNIT, 3),
        "Pb": _comma(F.col("l_discount"), 2),
        "Zn": _comma(F.col("l_tax"), 2),
    }
    columns = [
        given.get(c, F.lit(None)).cast("string").alias(f"'{c} '" if c in ("MatIdt", "MngD") else c)
        for c in schemas.MOVEMENT_FEED_COLUMNS
    ]
    return li.select(*columns, F.lit("x").alias("Unnamed: 39"))


_CLEAN_CELLS = {
    "BpzIdt": "concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar))",
    "MatIdt": "cast(l_partkey as varchar)",
    "KeziBez": "case when l_linestatus = 'O' then concat('M', cast(l_partkey as varchar), "
    "case when l_linenumber = 6 then concat(' \"two', chr(10), 'lines\", one cell') else '' end) else ' ' end",
    "MatArt": "case l_returnflag when 'R' then 'ROH' when 'A' then 'KRSM' else 'HIBE' end",
    "BucPer": "case when l_tax > 0.04 then 'late' end",
    "VrgGrp": "case when l_linenumber = 1 then -1 else l_linenumber end",
    "BucDat": "case when l_linenumber = 7 then '1970-01-01' else strftime(l_shipdate, '%Y-%m-%d') end",
    "LPlzIdt": "case l_suppkey % 3 when 0 then 55 when 1 then 53 else 51 end",
    "MngW": "case when l_linenumber in (3, 5) then 0.0::double else cast(cast(l_quantity as decimal(20,1)) as double) end",
    "MngD": "cast(cast(-l_quantity * 137 as decimal(20,3)) as double)",
    "Pb": "cast(cast(l_discount as decimal(20,2)) as double)",
    "Zn": "cast(cast(l_tax as decimal(20,2)) as double)",
}
_DEFAULT_SQL = {
    **{c: "' '" for c in schemas.MOVEMENT_FEED_COLUMNS},
    **{c: "-1" for c in ("VrgGrp", "MngEinhIdt", "LOrtIdt", "LPlzIdt", "LgrFirmIdt")},
    **{c: "0.0::double" for c in "MngW MngD Pb Ag Au Cu S Zn FeO SiO2 CaO As Sb Bi Se Cl Cd".split()},
}


def _clean_sql(**changed: str) -> str:
    cells = {**_DEFAULT_SQL, **_CLEAN_CELLS, **changed}
    return "v_clean as (select " + ", ".join(f'{cells[c]} "{c}"' for c in schemas.MOVEMENT_FEED_COLUMNS) + " from lineitem)"


_CLEAN_SQL = _clean_sql()
# Landed files: those of the third kind have a misspelled header in place of Zn.
FILED_SQL = _clean_sql(Zn=f"case when l_orderkey % 3 = 2 then 0.0::double else {_CLEAN_CELLS['Zn']} end")


ROWS_PER_FILE = 1_000_000


def landed_lines(raw: DataFrame) -> DataFrame:
    """(kind, value): the records of the three kinds of files as text, made in one pass by all tasks and stored."""
    part = F.split("BpzIdt", "-")[0].cast("long") % 3
    headers, names = _headers(raw.columns), raw.columns
    cells = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in names[::-1]]
    few = [F.lit("e, e").alias(c) if c == "extra" else F.col(f"`{'Zn' if c == 'Znn' else c}`").alias(c) for c in headers["few"]]
    escape = {"escape": '"'}
    value = (
        F.when(part == 0, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), escape))
        .when(part == 1, F.concat_ws(",", *cells))
        .when(part == 2, F.to_csv(F.struct(*few), escape))
    )
    kind = F.when(part == 0, "plain").when(part == 1, "quoted").when(part == 2, "few")
    path = scratch_path(raw.sparkSession, "movement-text")
    lines = raw.select(value.alias("value"), kind.alias("kind")).where("kind is not null")
    lines.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return raw.sparkSession.read.schema("value string, kind string").parquet(path)


def _headers(names: list[str]) -> dict[str, list[str]]:
    few = ["Unnamed: 39", *[c for c in names[7::-1] if c != "ChgNmr"], *names[8:-1]]
    return {"plain": names, "quoted": names[::-1], "few": [*["Znn" if c == "Zn" else c for c in few], "extra"]}


def _landed_text(lines: DataFrame, header: str, end: str, files: int, most: int, folder: str) -> None:
    """So many files of lines, each led by the header; their tasks only copy the lines. Where there are fewer tasks than
    files, a task begins another file after ``most`` lines: a file does not grow with the input."""
    if files == 1:
        head = lines.sparkSession.range(1).select(F.lit(header).alias("value"))
        out = head.unionByName(lines).coalesce(1)
    else:
        most = most if lines.rdd.getNumPartitions() < files else 1 << 33
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) % most == 0  # of a file
        led = F.when(first, F.concat(F.lit(header + end), F.col("value"))).otherwise(F.col("value"))
        out = lines.coalesce(files).select(led.alias("value"))
    out.write.mode("append").option("lineSep", end).option("maxRecordsPerFile", 0 if files == 1 else most).text(folder)


def write_movement_files(raw: DataFrame, folder: str, **sizes: int) -> str:
    """Files of three kinds, with headers of their own: in order; permuted, all cells quoted, with a byte order mark
    and CRLF line ends; and with a column too few (one that is always empty), a misspelled one and one too many."""
    with staging(raw.sparkSession):
        return write_landed_files(landed_lines(raw), raw.columns, folder, **sizes)


def write_landed_files(
    lines: DataFrame, names: list[str], folder: str, rows_per_file: int = ROWS_PER_FILE, few_files: int | None = None
) -> str:
    """The files of ``landed_lines``, of about ``rows_per_file`` records; the third kind in ``few_files``, if that is given."""
    counts = {r["kind"]: r["count"] for r in lines.groupBy("kind").count().collect()}
    for kind, columns in _headers(names).items():
        files = -(-counts.get(kind, 0) // rows_per_file)
        if kind == "few" and few_files:
            files = few_files
        header, end = ",".join(columns), "\n"
        if kind == "quoted":
            header, end = "\ufeff" + header, "\r\n"
        most = rows_per_file + rows_per_file // 4
        _landed_text(lines.where(F.col("kind") == kind).select("value"), header, end, max(files, 1), most, f"{folder}/{kind}")
    return folder


@query("clean_movements", q.with_(_CLEAN_SQL) + "select * from v_clean")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return movements.clean_movements(raw_movements(spark, sf))


_BAD_CELLS = {"VrgGrp": "(1)", "BucDat": "(7)", "MngW": "(3, 5)"}


@query(
    "bad_movement_cells",
    "select "
    + ", ".join(
        f'count(*) filter (where l_linenumber in {_BAD_CELLS.get(c, "(-1)")})::bigint "{c}"'
        for c in schemas.MOVEMENT_FEED_COLUMNS
        if c in (*schemas.MOVEMENT_FEED_INTS, *schemas.MOVEMENT_FEED_DATES, *schemas.MOVEMENT_FEED_FLOATS)
    )
    + " from lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return movements.bad_cells(raw_movements(spark, sf))


KINDS, FILES = "{plain,quoted,few}", "part-*"  # the folders of landed files, and their names


@query("loaded_movement_files", q.with_(FILED_SQL) + "select * from v_clean")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Files with different headers, line ends and quoting, appended; loading them again, by blocks of lines, adds nothing."""
    folder = scratch_path(spark, "movements")
    write_movement_files(raw_movements(spark, sf), f"{folder}/landed")
    for split in (records.SPLIT_BYTES, 0):
        feed_loads.load_movements(spark, f"{folder}/landed/{KINDS}", f"{folder}/table", FILES, split)
    return spark.read.parquet(f"{folder}/table").select(*schemas.MOVEMENT_FEED_COLUMNS)


@query("movements_by_blocks", q.with_(FILED_SQL) + "select * from v_clean")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same files as large ones are read: as lines, put together into records by the quotes before them."""
    folder = write_movement_files(raw_movements(spark, sf), scratch_path(spark, "movements"))
    rows = movements.read_movement_files(spark, f"{folder}/{KINDS}", FILES, split_bytes=0)
    return movements.clean_movements(rows)


_FILED_BAD = {c: f"l_linenumber in {lines}" for c, lines in _BAD_CELLS.items()}


@query(
    "movement_load_counts",
    "select 'rows' as kind, '' as name, count(*) as n from lineitem union all select 'stored', '', count(*) from lineitem "
    + " ".join(f"union all select 'bad', '{c}', count(*) from lineitem where {w}" for c, w in _FILED_BAD.items())
    + " union all select 'files without', 'ChgNmr', 1 union all select 'files without', 'Zn', 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """What a load tells about itself: rows read and stored, bad cells by column, columns that files lack."""
    folder = scratch_path(spark, "movements")
    write_movement_files(raw_movements(spark, sf), f"{folder}/landed", few_files=1)
    load = feed_loads.load_movements(spark, f"{folder}/landed/{KINDS}", f"{folder}/table", FILES)
    told = [("rows", "", load.rows), ("stored", "", load.stored)]
    told += [("bad", c, n) for c, n in load.bad_cells.items()]
    told += [("files without", c, len(files)) for c, files in load.missing_columns.items()]
    return spark.createDataFrame(told, "kind string, name string, n long")


# --- telemetry feed --------------------------------------------------------------------------------


def write_telemetry_files(spark: SparkSession, sf: str, folder: str) -> str:
    """Telemetry as landed text: preamble lines, no header; every file covers a stretch of time."""
    rows = sv.telemetry(spark, sf)
    text = rows.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Zeitstempel"),
        *[F.col(name).cast("string").alias(feed) for feed, name in schemas.TELEMETRY_FEED.items() if name != "ts"],
    )
    none = [F.lit(None).cast("string").alias(c) for c in text.columns[1:]]
    lines = F.array(*[F.lit(f"Preamble {i}") for i in range(1, 6)])
    preamble = spark.range(1).select(F.explode(lines).alias("Zeitstempel"), *none)
    text.unionByName(preamble).repartitionByRange(8, "Zeitstempel").write.csv(folder)
    return folder


_TELEMETRY_ROWS = (
    "select strftime(ts, '%Y-%m-%d %H:%M:%S') ts, cast(run_flag as double) run_flag, "
    + ", ".join(f"cast({c} as double) {c}" for c in ("feed", "coal", "dust_set", "dust_out", "slag"))
    + " from v_telemetry"
)
# Humidity has no source in the test tables and is null throughout.
_TELEMETRY_COLUMNS = ("ts", "run_flag", "feed", "coal", "dust_set", "dust_out", "slag")


@query("telemetry_file_rows", q.with_(q.TELEMETRY) + _TELEMETRY_ROWS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    folder = write_telemetry_files(spark, sf, scratch_path(spark, "telemetry"))
    return telemetry.parse(telemetry.read_telemetry_files(spark, folder)).select(*_TELEMETRY_COLUMNS)


@query("loaded_telemetry_files", q.with_(q.TELEMETRY) + _TELEMETRY_ROWS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded twice: the ledger keeps the second load from adding anything."""
    base = scratch_path(spark, "telemetry")
    folder = write_telemetry_files(spark, sf, f"{base}/landed")
    for _ in range(2):
        feed_loads.load_telemetry(spark, folder, f"{base}/table", f"{base}/ledger")
    return spark.read.parquet(f"{base}/table").select(*_TELEMETRY_COLUMNS)


@query("telemetry_batch_and_stream", q.with_(q.TELEMETRY) + _TELEMETRY_ROWS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One table: some files by batch, all by stream, and once more by a stream that lost its checkpoint."""
    base = scratch_path(spark, "telemetry-both")
    folder = write_telemetry_files(spark, sf, f"{base}/landed")
    feed_loads.load_telemetry(spark, folder, f"{base}/table", f"{base}/ledger", glob="part-0000[0-3]*.csv")
    for run in ("first", "lost"):
        ingest.ingest_telemetry(spark, folder, f"{base}/table", f"{base}/checkpoint-{run}").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(*_TELEMETRY_COLUMNS)


@query(
    "pending_files",
    q.with_(q.TELEMETRY)
    + """select 'day-' || strftime(cast(ts as date), '%Y-%m-%d') || '.csv' source_file, count(*) as rows
from v_telemetry where cast(ts as date) >= date '1998-01-16' group by 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of files not named by a ledger kept as one JSON array of names."""
    named = F.concat(F.lit("day-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    rows = sv.telemetry(spark, sf).withColumn("source_file", named)
    done = rows.where(F.col("ts") < F.lit("1998-01-16").cast("timestamp_ntz")).select("source_file").distinct()
    path = scratch_path(spark, "ledger")
    done.agg(F.to_json(F.collect_list("source_file")).alias("value")).write.text(path)
    pending = ledger.pending_rows(rows, ledger.read_json_ledger(spark, path))
    return pending.groupBy("source_file").agg(F.count("*").alias("rows"))


@query(
    "appended_telemetry",
    q.with_(q.TELEMETRY)
    + "select strftime(ts, '%Y-%m') as month, count(*) as rows, cast(sum(feed) as double) feed from v_telemetry group by 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Appended to a table partitioned by month, read back by partition."""
    path = scratch_path(spark, "telemetry")
    sink.append_telemetry(sv.telemetry(spark, sf), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.date_format(sink.MONTH, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("rows"), F.sum("feed").alias("feed")
    )


# --- dirty cells -----------------------------------------------------------------------------------------


@query(
    "cleaned_cells",
    """select l_orderkey, l_linenumber, case when l_linenumber = 2 then -1 else l_linenumber end as whole,
case l_linenumber when 2 then 0.0 when 3 then 0.0 when 5 then 1234567890.123457::double else cast(cast(l_extendedprice as decimal(20,2)) as double) end as number,
case when l_linenumber = 4 then 0.0 else cast(cast(l_tax as decimal(20,2)) as double) end as hours,
case when l_returnflag = 'N' then ' ' else l_returnflag end txt from lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    raw = sv.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 2, "?").otherwise(F.concat(F.lit(" "), line.cast("string"), F.lit(".7"))).alias("w"),
        F.when(line == 2, F.lit(None)).when(line == 3, "abc").when(line == 5, "1234567890,1234567").otherwise(
            _comma(F.col("l_extendedprice"), 2)
        ).alias("n"),
        F.when(line == 4, "NaN").otherwise(F.col("l_tax").cast("decimal(20,2)").cast("string")).alias("h"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("t"),
    )
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        cleaning.int_or_default(F.col("w")).alias("whole"),
        cleaning.float_or_default(F.col("n")).alias("number"),
        cleaning.hours_or_zero(F.col("h")).alias("hours"),
        cleaning.text_or_default(F.col("t")).alias("txt"),
    )


@query(
    "years_kept",
    f"select cast(year(o_orderdate) as bigint) as year, count(*) as rows from orders "
    f"where year(o_orderdate) in ({_YEARS_SQL}) group by 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = sv.table(spark, sf, "orders").where(dates.in_years(F.to_date("o_orderdate"), YEARS))
    return rows.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("rows"))
