"""Every operator run over the given tables, with the same result in ANSI SQL.

Facts are made from ``lineitem`` (ship day, part, quantity) and ``events`` (day, user, value).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.functions.storage import delete, scratch_folder
from viewmart.operators import quality as q

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str):
    """Day text of a timestamp without time zone; the session's zone plays no part."""
    return F.col(column).cast("date").cast("string")


# --- facts ---------------------------------------------------------------------------------


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fact per order line; every fact of a page has its own title."""
    return table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("date"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("entity"),
        F.col("l_partkey").cast("string").alias("page_id"),
        F.col("l_quantity").cast("bigint").alias("views"),
    )


LINE_FACTS = """(select strftime(l_shipdate, '%Y-%m-%d') as date,
    l_orderkey || '-' || l_linenumber as entity, l_partkey::varchar as page_id,
    l_quantity::bigint as views from lineitem)"""


def flag_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fact per order line; a page has up to three titles."""
    return table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("entity"),
        F.col("l_partkey").cast("string").alias("page_id"),
        F.col("l_quantity").cast("bigint").alias("views"),
    )


FLAG_FACTS = """(select strftime(l_shipdate, '%Y-%m-%d') as date, l_returnflag as entity,
    l_partkey::varchar as page_id, l_quantity::bigint as views from lineitem)"""


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fact per event, so a page has many facts on a day."""
    return table(spark, sf_dir, "events").select(
        day("ts").alias("date"),
        F.col("event_type").alias("entity"),
        F.col("user_id").cast("string").alias("page_id"),
        F.floor("value").cast("bigint").alias("views"),
    )


EVENT_FACTS = """(select strftime(ts, '%Y-%m-%d') as date, event_type as entity,
    user_id::varchar as page_id, floor(value)::bigint as views from events)"""

LAST_DAY, WINDOW = "2024-01-30", 7
RECENT = f"(select * from {EVENT_FACTS} where date between '2024-01-24' and '{LAST_DAY}')"


def ranked(facts: str, n: int) -> str:
    return f"""(select page_id, arg_max(entity, (date, entity)) as entity,
        sum(views)::bigint as total_views from {facts} group by page_id
        order by total_views desc, page_id limit {n})"""


def monthly_sql(facts: str, n: int) -> str:
    return f"""select substr(p.date, 1, 7) as month, t.page_id, t.entity,
        sum(p.views)::bigint as views from {facts} p join {ranked(facts, n)} t
        on p.page_id = t.page_id group by 1, 2, 3"""


# --- ranking and reports -------------------------------------------------------------------


@query(f"""select page_id, arg_max(entity, (date, entity)) as entity,
    sum(views)::bigint as total_views from {FLAG_FACTS} group by page_id""")
def page_totals(spark, sf_dir):
    return vm.page_totals(flag_facts(spark, sf_dir))


@query(f"select * from {ranked(LINE_FACTS, 100)}")
def top_pages(spark, sf_dir):
    return vm.top_pages(line_facts(spark, sf_dir), 100)


@query(f"select * from {ranked(LINE_FACTS, 1500)}")
def top_pages_wide(spark, sf_dir):
    return vm.top_pages(line_facts(spark, sf_dir), 1500)


@query(f"""select p.date, t.page_id, t.entity, p.views from {LINE_FACTS} p
    join {ranked(LINE_FACTS, 100)} t on p.page_id = t.page_id""")
def restrict_to_top(spark, sf_dir):
    facts = line_facts(spark, sf_dir)
    return vm.restrict_to_top(facts, vm.top_pages(facts, 100))


@query(f"""select p.date, t.page_id, t.entity, p.views from {LINE_FACTS} p
    join {ranked(LINE_FACTS, 700)} t on p.page_id = t.page_id""")
def restrict_to_top_wide(spark, sf_dir):
    """A Bloom filter of the ranked ids thins the facts before they are shuffled to a stored ranking."""
    root = scratch_folder(spark, "ranking")
    facts = line_facts(spark, sf_dir)
    vm.overwrite(vm.top_pages(facts, 700), root, "ranking")
    return vm.restrict_to_top(facts, vm.read_table(spark, root, "ranking").hint("merge"), pages_rows=700)


@query(f"""select substr(date, 1, 7) as month, page_id, entity, sum(views)::bigint as views
    from {FLAG_FACTS} group by 1, 2, 3""")
def monthly_views(spark, sf_dir):
    return vm.monthly_views(flag_facts(spark, sf_dir))


@query(monthly_sql(LINE_FACTS, 100))
def top_pages_monthly(spark, sf_dir):
    return vm.top_pages_monthly(line_facts(spark, sf_dir), 100)


@query(monthly_sql(LINE_FACTS, 100_000))
def top_pages_monthly_default(spark, sf_dir):
    return vm.top_pages_monthly(line_facts(spark, sf_dir))


@query(monthly_sql(LINE_FACTS, 250_000))
def top_pages_monthly_by_shuffle(spark, sf_dir):
    """More pages than may be broadcast: the ranking is joined by shuffle."""
    return vm.top_pages_monthly(line_facts(spark, sf_dir), 250_000)


@query(f"select * from {RECENT}")
def read_recent(spark, sf_dir):
    return vm.read_recent(event_facts(spark, sf_dir), LAST_DAY, WINDOW)


@query(f"""select p.date, t.page_id, t.entity, p.views from {RECENT} p
    join {ranked(RECENT, 20)} t on p.page_id = t.page_id""")
def top_pages_daily(spark, sf_dir):
    return vm.top_pages_daily(event_facts(spark, sf_dir), LAST_DAY, WINDOW, 20)


@query(f"""select p.date, t.page_id, t.entity, sum(p.views)::bigint as views from {RECENT} p
    join {ranked(RECENT, 20)} t on p.page_id = t.page_id group by 1, 2, 3""")
def top_pages_daily_agg(spark, sf_dir):
    return vm.top_pages_daily(event_facts(spark, sf_dir), LAST_DAY, WINDOW, 20, aggregate=True)


BUILT = "(select * from {0} where date between '2024-01-01' and '2024-01-30')".format(EVENT_FACTS)


@query(f"""select 'monthly' as report, month as period, page_id, entity, views
    from ({monthly_sql(EVENT_FACTS, 100)})
    union all select 'daily', p.date, t.page_id, t.entity, p.views from {BUILT} p
    join {ranked(BUILT, 50)} t on p.page_id = t.page_id""")
def build_all(spark, sf_dir):
    """Both reports built, checked, stored and read back; a window of 30 days without gaps."""
    root = scratch_folder(spark, "build")
    vm.build_all(
        event_facts(spark, sf_dir), root, today="2024-01-31", top_monthly=100, top_daily=50, window_days=30, min_rows=1
    )
    return built_reports(spark, root)


BUILT_90 = "(select * from {0} where date between '2023-11-02' and '2024-01-30')".format(EVENT_FACTS)
GAPS_90 = """(select strftime(d, '%Y-%m-%d') as date
    from range(timestamp '2023-11-02', timestamp '2024-01-31', interval 1 day) r(d)
    where strftime(d, '%Y-%m-%d') not in (select strftime(ts, '%Y-%m-%d') from events))"""


@query(f"""select 'monthly' as report, month as period, page_id, entity, views
    from ({monthly_sql(EVENT_FACTS, 100)})
    union all select 'daily', p.date, t.page_id, t.entity, p.views from {BUILT_90} p
    join {ranked(BUILT_90, 50)} t on p.page_id = t.page_id
    union all select 'missing', date, null, null, null from {GAPS_90}""")
def build_all_gaps(spark, sf_dir):
    """The default window of 90 days, of which many have no facts; those days are reported."""
    root = scratch_folder(spark, "build")
    done = vm.build_all(
        event_facts(spark, sf_dir), root, today="2024-01-31", top_monthly=100, top_daily=50, min_rows=1, allow_gaps=True
    )
    missing = spark.createDataFrame([(d,) for d in done.missing], "period string")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in
               (("page_id", "string"), ("entity", "string"), ("views", "bigint"))]
    return built_reports(spark, root).union(missing.select(F.lit("missing").alias("report"), "period", *nothing))


@query(f"""select 'monthly' as report, month as period, page_id, entity, views
    from ({monthly_sql(EVENT_FACTS, 100)})
    union all select 'daily', p.date, t.page_id, t.entity, p.views from {BUILT} p
    join {ranked(BUILT, 50)} t on p.page_id = t.page_id""")
def build_all_kept(spark, sf_dir):
    """Both reports from sums and window totals that are kept up to date."""
    root = scratch_folder(spark, "build")
    path = f"{root}/facts"
    vm.write_facts(event_facts(spark, sf_dir), path)
    vm.refresh_sums(spark, path, root)
    vm.update_window(spark, root, LAST_DAY, 30)
    vm.build_all(
        vm.read_facts(spark, path), root, today="2024-01-31", top_monthly=100, top_daily=50, window_days=30, min_rows=1,
        days=vm.read_days(spark, path), sums=vm.read_month_sums(spark, root), totals=vm.read_window(spark, root),
    )
    return built_reports(spark, root)


def built_reports(spark: SparkSession, root: str) -> DataFrame:
    monthly = vm.read_table(spark, root, "top_pages_monthly").withColumnRenamed("month", "period")
    daily = vm.read_table(spark, root, "top_pages_daily_recent").withColumnRenamed("date", "period")
    columns = ["period", "page_id", "entity", "views"]
    return monthly.select(F.lit("monthly").alias("report"), *columns).union(
        daily.select(F.lit("daily").alias("report"), *columns)
    )


FRACTIONS = """(select l_partkey || '-' || l_suppkey as k, sum(round(l_discount * 100)::bigint) / (count(*) * 100)
    - sum(round(l_tax * 100)::bigint) / (count(*) * 100) as v from lineitem group by l_partkey, l_suppkey)"""


@query(f"""select k, v from {FRACTIONS} order by v desc, k limit 1200""")
def top_rows_fraction(spark, sf_dir):
    """More than a thousand rows of metrics between -1 and 1, negative ones among them."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        # whole hundredths make the averages the same in any order of addition
        (F.sum(F.round(F.col("l_discount") * 100).cast("bigint")) / (F.count("*") * 100)).alias("d"),
        (F.sum(F.round(F.col("l_tax") * 100).cast("bigint")) / (F.count("*") * 100)).alias("t"),
    )
    rows = lines.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("k"), (F.col("d") - F.col("t")).alias("v"))
    return vm.top_rows(rows, 1200, "v", "k")


@query("""select doc_id, (length(text) % 7) / 8.0::double as v from documents
    order by v desc, doc_id limit 600""")
def top_rows_ties(spark, sf_dir):
    """Seven different fractions: most rows tie, and the cut lies inside one value."""
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.length("text") % 7 / F.lit(8.0)).alias("v"))
    return vm.top_rows(rows, 600, "v", "doc_id")


# --- sums kept up to date ------------------------------------------------------------------

FIRST_DAYS = 27


def spread_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all events, those of different users up to three months later."""
    return event_facts(spark, sf_dir).withColumn(
        "date", F.date_add(F.col("date").cast("date"), (F.col("page_id").cast("int") % 4) * 31).cast("string")
    )


SPREAD_FACTS = """(select strftime(ts::date + (user_id % 4 * 31)::int, '%Y-%m-%d') as date, event_type as entity,
    user_id::varchar as page_id, floor(value)::bigint as views from events)"""


def loaded_days(facts: DataFrame, path: str, root: str, late: Column) -> None:
    """Facts stored in two loads, with a refresh of the sums after each; the second one has the ``late`` facts."""
    for part in (~late, late):
        vm.write_facts(facts.where(part), path)
        vm.refresh_sums(facts.sparkSession, path, root)


@query(monthly_sql(SPREAD_FACTS, 100))
def top_pages_monthly_kept(spark, sf_dir):
    """From month sums that were built, then refreshed with three more days."""
    folder = scratch_folder(spark, "sums")
    late = F.col("date").isin("2024-01-28", "2024-02-29", "2024-04-15")
    loaded_days(spread_facts(spark, sf_dir), f"{folder}/facts", folder, late)
    return vm.monthly_from_sums(vm.read_month_sums(spark, folder), 100)


REISSUED = f"""(select date, entity, page_id, views from {SPREAD_FACTS} where date not in ('2024-01-20', '2024-02-10')
    union all select date, entity || '-again', page_id, views + 1 from {SPREAD_FACTS}
    where date = '2024-01-20' and views % 2 = 0)"""


@query(f"""select page_id, arg_max(entity, (date, entity)) as entity, sum(views)::bigint as total_views
    from {REISSUED} group by page_id""")
def page_totals_reissued(spark, sf_dir):
    """Totals and titles from sums, after one day was issued anew and another one deleted."""
    folder = scratch_folder(spark, "sums")
    facts = spread_facts(spark, sf_dir)
    vm.write_facts(facts, f"{folder}/facts")
    vm.refresh_sums(spark, f"{folder}/facts", folder)
    again = facts.where((F.col("date") == "2024-01-20") & (F.col("views") % 2 == 0))
    again = again.select("date", F.concat("entity", F.lit("-again")).alias("entity"), "page_id", F.col("views") + 1)
    vm.write_facts(again.toDF("date", "entity", "page_id", "views"), f"{folder}/facts")
    delete(spark, f"{folder}/facts/date=2024-02-10")
    vm.refresh_sums(spark, f"{folder}/facts", folder)
    return vm.totals_from_sums(vm.read_month_sums(spark, folder))


def window_sql(last: str, first: str) -> str:
    facts = f"(select * from {EVENT_FACTS} where date between '{first}' and '{last}')"
    return f"select '{last}' as last, * from {ranked(facts, 50)}"


@query(f"{window_sql('2024-01-29', '2024-01-23')} union all {window_sql('2024-01-30', '2024-01-24')}")
def top_pages_sliding(spark, sf_dir):
    """Pages of two windows; the second one is the first, moved by a day."""
    folder = scratch_folder(spark, "sums")
    vm.write_facts(event_facts(spark, sf_dir), f"{folder}/facts")
    vm.refresh_sums(spark, f"{folder}/facts", folder)
    out = None
    for last in ("2024-01-29", "2024-01-30"):
        vm.update_window(spark, folder, last, 7)
        top = vm.top_rows(vm.read_window(spark, folder), 50, "total_views", "page_id")
        top = top.select(F.lit(last).alias("last"), "page_id", "entity", "total_views")
        out = top if out is None else out.union(top)
    return out


# --- calendars -----------------------------------------------------------------------------


@query(f"select max(date) as last_ingested from {LINE_FACTS}")
def last_ingested(spark, sf_dir):
    return vm.last_ingested(line_facts(spark, sf_dir))


@query(f"select max(date) as last_ingested from {EVENT_FACTS}")
def last_ingested_stored(spark, sf_dir):
    """From the folders of a stored fact table."""
    path = f"{scratch_folder(spark, 'facts')}/facts"
    vm.write_facts(event_facts(spark, sf_dir), path)
    return vm.last_ingested(vm.read_days(spark, path))


@query("""select strftime(d, '%Y-%m-%d') as date
    from range(timestamp '2023-12-20', timestamp '2024-02-11', interval 1 day) r(d)
    where strftime(d, '%Y-%m-%d') not in (select strftime(ts, '%Y-%m-%d') from events)""")
def missing_dates_stored(spark, sf_dir):
    """From the folders of a stored fact table."""
    path = f"{scratch_folder(spark, 'facts')}/facts"
    vm.write_facts(event_facts(spark, sf_dir), path)
    return vm.missing_dates(vm.read_days(spark, path), "2023-12-20", "2024-02-10")


@query("""select strftime(d, '%Y-%m-%d') as date
    from range(timestamp '2023-12-20', timestamp '2024-02-11', interval 1 day) r(d)
    where strftime(d, '%Y-%m-%d') not in (select strftime(ts, '%Y-%m-%d') from events)""")
def missing_dates(spark, sf_dir):
    return vm.missing_dates(event_facts(spark, sf_dir), "2023-12-20", "2024-02-10")


@query("""select strftime(d, '%Y-%m-%d') as date
    from (select unnest(range(min(l_shipdate), timestamp '2003-01-01', interval 1 day)) as d from lineitem)
    where d not in (select l_shipdate from lineitem)""")
def missing_dates_open_start(spark, sf_dir):
    return vm.missing_dates(line_facts(spark, sf_dir), end="2002-12-31")


@query("""select strftime(d, '%Y-%m-%d') as date
    from range(timestamp '1990-01-01', timestamp '2005-01-01', interval 1 day) r(d)
    where d not in (select o_orderdate from orders)""")
def pending_dates(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("date"))
    return vm.pending_dates(spark, "1990-01-01", "2004-12-31", done)


GATE = f"""select last as last_ingested,
    greatest(date_diff('day', last::date, date '{{today}}' - 1), 0)::int as days_behind,
    last::date >= date '{{today}}' - 1 and last <> '{{built}}' as build,
    case when last::date < date '{{today}}' - 1 then 'behind'
         when last = '{{built}}' then 'up to date' else 'new data' end as reason
    from (select max(date) as last from {EVENT_FACTS})"""


@query(GATE.format(today="2024-01-31", built="2024-01-29"))
def needs_build(spark, sf_dir):
    return vm.needs_build(event_facts(spark, sf_dir), "2024-01-31", "2024-01-29")


@query(GATE.format(today="2024-02-03", built="2024-01-29"))
def needs_build_behind(spark, sf_dir):
    return vm.needs_build(event_facts(spark, sf_dir), "2024-02-03", "2024-01-29")


# --- dumps ---------------------------------------------------------------------------------

PROJECT = "aa.site"


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump lines from all of ``lineitem``: two projects, blanks around and between, pages
    without id, lines of seven fields, counts that are no integers, broken UTF-8."""
    entity = (
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("Item "), F.col("l_orderkey")))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("Item\x1c"), F.col("l_orderkey")))
        .otherwise(F.concat(F.lit("Item_"), F.col("l_orderkey")))
    )
    quantity = F.col("l_quantity").cast("int").cast("string")
    count = (
        F.when(quantity == "50", "x50")
        .when(quantity == "49", "+49")
        .when(quantity == "48", "4_8")
        .otherwise(quantity)
    )
    line = F.concat(
        F.lit("\t "),
        F.when(F.col("l_linestatus") == "O", PROJECT).otherwise("bb.site"),
        F.lit(" "),
        entity,
        F.lit("  "),
        F.when(F.col("l_returnflag") == "R", "null").otherwise(F.col("l_partkey").cast("string")),
        F.lit(" - "),
        count,
        F.lit(" x  "),
    )
    broken = F.concat(F.encode(line, "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    value = F.when(F.col("l_tax") == 0.08, broken).otherwise(line)
    # Exploded, so that the line is put together once and not again in every use of it.
    return table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("date"),
        F.lit("lineitem").alias("source"),
        F.explode(F.array(value)).alias("value"),
    )


# What the lines above hold, told from the columns they are made of.
LINES = """(select strftime(l_shipdate, '%Y-%m-%d') as date, 'lineitem' as source,
    case when l_linestatus = 'O' then 'aa.site' else 'bb.site' end as project,
    'Item_' || l_orderkey as entity,
    case when l_returnflag = 'R' then 'null' else l_partkey::varchar end as page_id,
    case l_quantity when 50 then 'x50' when 49 then '+49' when 48 then '4_8'
         else l_quantity::int::varchar end as view_count,
    l_linenumber >= 6 as seven, l_tax = 0.08 as broken, l_quantity from lineitem)"""


@query(f"""select date, source, project, entity, page_id, view_count from {LINES}
    where not seven and not broken""")
def parse_lines(spark, sf_dir):
    lines = dump_lines(spark, sf_dir)
    return vm.parse_lines(lines.where(F.is_valid_utf8("value")))


@query(f"""select date, source, project, entity, page_id, view_count from {LINES}
    where not seven and not broken and project = '{PROJECT}' and page_id <> 'null'""")
def filter_project(spark, sf_dir):
    lines = dump_lines(spark, sf_dir).where(F.is_valid_utf8("value"))
    return vm.filter_project(vm.parse_lines(lines), PROJECT)


@query(f"""select date, source, entity, page_id, l_quantity::bigint as views from {LINES}
    where not seven and not broken and project = '{PROJECT}' and page_id <> 'null'
    and l_quantity <> 50""")
def dump_facts(spark, sf_dir):
    return vm.dump_facts(dump_lines(spark, sf_dir), PROJECT, strict=False)


@query(f"""select date, case when broken then 'encoding' when seven then 'fields' else 'count' end
    as reason, count(*) as lines from {LINES}
    where broken or seven or (project = '{PROJECT}' and page_id <> 'null' and l_quantity = 50)
    group by 1, 2""")
def parse_rejects(spark, sf_dir):
    rejects = vm.parse_rejects(dump_lines(spark, sf_dir), PROJECT)
    return rejects.groupBy("date", "reason").agg(F.count("*").alias("lines"))


DAY_FOLDER = r"day=(\d{4})(\d{2})(\d{2})"


def event_dump(spark: SparkSession, sf_dir: str) -> str:
    """All events as bzip2 dump files, one folder per day; returns where they are."""
    path = f"{scratch_folder(spark, 'dump')}/files"
    error = F.col("event_type") == "error"
    lines = table(spark, sf_dir, "events").select(
        F.concat_ws(
            " ",
            F.when(error, "bb.site").otherwise(PROJECT),
            "event_type",
            "user_id",
            F.lit("-"),
            F.floor("value").cast("bigint"),
            F.lit("x"),
        ).alias("value"),
        F.translate(day("ts"), "-", "").alias("day"),
    )
    writer = lines.hint("rebalance", "day").write.option("compression", "bzip2")
    writer.partitionBy("day").text(path)
    return path


EVENT_DUMP = f"select date, entity, page_id, views from {EVENT_FACTS} where entity <> 'error'"


@query(EVENT_DUMP)
def ingest(spark, sf_dir):
    """bzip2 files to the partitioned fact table and back."""
    dump = event_dump(spark, sf_dir)
    facts = f"{dump}-facts"
    vm.ingest(spark, dump, facts, PROJECT, glob="*.bz2", day_pattern=DAY_FOLDER)
    return vm.read_facts(spark, facts)


@query(EVENT_DUMP)
def ingest_stream(spark, sf_dir):
    """The same as a stream of files, run twice; the second run finds nothing new."""
    dump = event_dump(spark, sf_dir)
    facts, checkpoint = f"{dump}-facts", f"{dump}-checkpoint"
    for _ in range(2):
        vm.ingest_stream(
            spark, dump, facts, checkpoint, PROJECT, glob="*.bz2", day_pattern=DAY_FOLDER
        )
    return vm.read_facts(spark, facts)


def year_dump(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All line items as bzip2 dump files with bad lines, one folder per year."""
    count = F.when(F.col("l_quantity") == 50, "x50").otherwise(F.col("l_quantity").cast("int").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            " ",
            F.when(F.col("l_linestatus") == "O", PROJECT).otherwise("bb.site"),
            F.concat(F.lit("P"), F.col("l_partkey")),
            "l_partkey",
            F.lit("-"),
            F.when(F.col("l_linestatus") == "O", count).otherwise("1"),
            F.when(F.col("l_linenumber") < 6, "x"),
        ).alias("value"),
        F.concat(F.year("l_shipdate"), F.lit("0101")).alias("day"),
    )
    # files of even size: without the shuffle, each task would write a small file for every year
    lines.hint("rebalance", "day").write.partitionBy("day").option("compression", "bzip2").text(path)


@query("""select 'fact' as kind, strftime(l_shipdate, '%Y') as year, count(*) as lines,
        sum(l_quantity)::bigint as views from lineitem
        where l_linestatus = 'O' and l_quantity <> 50 and l_linenumber < 6 group by 2
    union all select case when l_linenumber >= 6 then 'fields' else 'count' end,
        strftime(l_shipdate, '%Y'), count(*), null from lineitem
        where l_linenumber >= 6 or (l_linestatus = 'O' and l_quantity = 50) group by 1, 2""")
def ingest_rejects(spark, sf_dir):
    """Batch ingest of files with bad lines, which are kept; one file of the same name per year."""
    folder = scratch_folder(spark, "rejects")
    year_dump(spark, sf_dir, f"{folder}/dump")
    vm.ingest(
        spark, f"{folder}/dump", f"{folder}/facts", PROJECT,
        glob="*.bz2", day_pattern=DAY_FOLDER, rejects_path=f"{folder}/rejects",
    )
    year = F.substring("date", 1, 4).alias("year")
    facts = vm.read_facts(spark, f"{folder}/facts").groupBy(year).agg(
        F.count("*").alias("lines"), F.sum("views").alias("views")
    )
    bad = spark.read.schema("value string, reason string, date string, source string").parquet(f"{folder}/rejects")
    rejects = bad.groupBy(F.col("reason").alias("kind"), year).agg(F.count("*").alias("lines"))
    return facts.select(F.lit("fact").alias("kind"), "year", "lines", "views").unionByName(
        rejects, allowMissingColumns=True
    )


@query("""with l as (select strftime(l_shipdate, '%Y') || '-01-01' as date, l_linenumber >= 6 as seven,
        l_linestatus = 'O' as kept, l_quantity = 50 as bad from lineitem)
    select date, 'day=' || replace(date, '-', '') as source, count(*) as lines,
        count(*) filter (not seven and kept and not bad) as kept,
        count(*) filter (seven or (kept and bad)) as rejected from l group by date""")
def ingest_outcomes(spark, sf_dir):
    """Lines, facts and rejects of each year's dump folder, counted file by file while streams of three files are parsed."""
    folder = scratch_folder(spark, "outcomes")
    year_dump(spark, sf_dir, f"{folder}/dump")
    vm.ingest_stream(
        spark, f"{folder}/dump", f"{folder}/facts", f"{folder}/checkpoint", PROJECT, glob="*.bz2", day_pattern=DAY_FOLDER,
        files_per_batch=3, allow_empty=True, rejects_path=f"{folder}/rejects", outcomes_path=f"{folder}/outcomes",
    )
    files = vm.read_outcomes(spark, f"{folder}/outcomes")
    sums = [F.sum(n).alias(n) for n in ("lines", "kept", "rejected")]
    return files.groupBy("date", F.substring_index("source", "/", 1).alias("source")).agg(*sums)


@query(EVENT_DUMP)
def ingest_stream_equal_names(spark, sf_dir):
    """Files of one name in several folders, forty files a batch."""
    folder = scratch_folder(spark, "names")
    lines = spark.read.text(event_dump(spark, sf_dir))  # with the day of its folder
    lines = lines.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    for part in range(3):
        rows = lines.where(F.col("part") == part)
        target = f"{folder}/dump/part={part}"
        rows.drop("part").hint("rebalance", "day").write.partitionBy("day").option("compression", "bzip2").text(target)
    vm.ingest_stream(
        spark, f"{folder}/dump", f"{folder}/facts", f"{folder}/checkpoint", PROJECT,
        glob="*.bz2", day_pattern=DAY_FOLDER, files_per_batch=40,
    )
    return vm.read_facts(spark, f"{folder}/facts")


# --- quality -------------------------------------------------------------------------------

QUARTER = "strftime(o_orderdate, '%Y') || '-Q' || month(o_orderdate)"
WEEK = "strftime(o_orderdate, '%Y') || '-W' || lpad((2 * day(o_orderdate))::varchar, 2, '0')"
SWAPPED = "strftime(o_orderdate, '%Y-%d-%m')"


def bad(check: str, column: str, condition: str, source: str) -> str:
    return f"""select '{check}' as "check", '{column}' as "column",
        count(*) filter (where {condition}) as bad_rows from {source}"""


DATED = f"""(select case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y')
    else o_orderpriority end as y, {QUARTER} as qu, {SWAPPED} as d, substr({SWAPPED}, 1, 7) as m,
    {WEEK} as w, case o_orderstatus when 'F' then {QUARTER} when 'O' then {WEEK} else {SWAPPED} end
    as a from orders)"""


def between(text: str, first: int, length: int, low: int, high: int) -> str:
    """SQL: so many digits at a place, as a number in a range."""
    part = f"substr({text}, {first}, {length})"
    return f"(length({part}) = {length} and {part} = lpad(coalesce(try_cast({part} as int), -1)::varchar, {length}, '0') and try_cast({part} as int) between {low} and {high})"


# The shapes told by the parts of the text, not by patterns.
SHAPES = {
    "valid_year": lambda c: f"length({c}) = 4 and {between(c, 1, 4, 0, 9999)}",
    "valid_quarter": lambda c: f"length({c}) = 7 and {between(c, 1, 4, 0, 9999)} and substr({c}, 5, 2) = '-Q' and {between(c, 7, 1, 1, 4)}",
    "valid_month": lambda c: f"length({c}) = 7 and {between(c, 1, 4, 0, 9999)} and substr({c}, 5, 1) = '-' and {between(c, 6, 2, 1, 12)}",
    "valid_week": lambda c: f"length({c}) = 8 and {between(c, 1, 4, 0, 9999)} and substr({c}, 5, 2) = '-W' and {between(c, 7, 2, 1, 53)}",
    "valid_date": lambda c: f"length({c}) = 10 and {between(c, 1, 4, 0, 9999)} and substr({c}, 5, 1) = '-' and {between(c, 6, 2, 1, 12)} and substr({c}, 8, 1) = '-' and {between(c, 9, 2, 1, 31)}",
}
SHAPES["valid_date_any"] = lambda c: " or ".join(f"({shape(c)})" for name, shape in SHAPES.items() if name != "valid_date_any")


@query(
    " union all ".join(
        bad(name, column, f"not ({SHAPES[name](column)})", DATED)
        for name, column in [
            ("valid_year", "y"),
            ("valid_quarter", "qu"),
            ("valid_month", "m"),
            ("valid_week", "w"),
            ("valid_date", "d"),
            ("valid_date_any", "a"),
        ]
    )
)
def violations_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("on", F.col("o_orderdate").cast("date"))
    year = F.year("on").cast("string")
    two = [F.lpad(n.cast("string"), 2, "0") for n in (F.dayofmonth("on"), F.month("on"))]
    quarter = F.concat(year, F.lit("-Q"), F.month("on"))
    week = F.concat(year, F.lit("-W"), F.lpad((F.dayofmonth("on") * 2).cast("string"), 2, "0"))
    swapped = F.concat_ws("-", year, *two)
    dated = orders.select(
        F.when(F.col("o_orderstatus") == "F", year).otherwise(F.col("o_orderpriority")).alias("y"),
        quarter.alias("qu"),
        swapped.alias("d"),
        F.substring(swapped, 1, 7).alias("m"),
        week.alias("w"),
        F.when(F.col("o_orderstatus") == "F", quarter)
        .when(F.col("o_orderstatus") == "O", week)
        .otherwise(swapped)
        .alias("a"),
    )
    checks = [
        q.valid_year("y"),
        q.valid_quarter("qu"),
        q.valid_month("m"),
        q.valid_week("w"),
        q.valid_date("d"),
        q.valid_date_any("a"),
    ]
    return vm.violations(dated, checks).drop("sample")


@query(
    " union all ".join(
        [
            bad("max_length", "text", "length(text) > 2000", "documents"),
            bad("min_length", "text", "length(text) < 100", "documents"),
            bad("exact_length", "source", "length(source) <> 3", "documents"),
            bad("starts with a letter", "text", "not regexp_matches(text, '^[A-Za-z]')", "documents"),
            bad("in_set", "lang", "lang not in ('en', 'de')", "documents"),
        ]
    )
)
def violations_strings(spark, sf_dir):
    checks = [
        q.max_length("text", 2000),
        q.min_length("text", 100),
        q.exact_length("source", 3),
        q.matches_pattern("text", "[A-Za-z]", "starts with a letter"),
        q.in_set("lang", ["en", None, "de"]),
    ]
    return vm.violations(table(spark, sf_dir, "documents"), checks).drop("sample")


@query(
    " union all ".join(
        [
            bad("positive", "acctbal", "acctbal < 0", "(select c_acctbal as acctbal from customer)"),
            bad("positive", "nation", "nation <= 0", "(select c_nationkey as nation from customer)"),
            bad(
                "in_range",
                "acctbal",
                "acctbal < 100 or acctbal > 5000.5",
                "(select c_acctbal as acctbal from customer)",
            ),
            bad("in_range", "nation", "nation > 20", "(select c_nationkey as nation from customer)"),
            bad(
                "percentage",
                "acctbal",
                "acctbal < 0 or acctbal > 100",
                "(select c_acctbal as acctbal from customer)",
            ),
        ]
    )
)
def violations_numbers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nation")
    )
    checks = [
        q.positive("acctbal"),
        q.positive("nation", allow_zero=False),
        q.in_range("acctbal", 100, 5000.5),
        q.in_range("nation", high=20),
        q.percentage("acctbal"),
    ]
    return vm.violations(customer, checks).drop("sample")


@query(
    " union all ".join(
        [
            bad("https", "url", "not regexp_matches(url, '^https://')", "pages"),
            bad("max_length", "html", "length(html) > 3000", "pages"),
        ]
    )
)
def violations_pages(spark, sf_dir):
    checks = [q.matches_pattern("url", "https://", "https"), q.max_length("html", 3000)]
    return vm.violations(table(spark, sf_dir, "pages"), checks).drop("sample")


@query("""select 'in_set' as "check", 'doc_id' as "column", count(*) as bad_rows
    from documents where doc_id not in (select doc_id from labels)""")
def not_in_table(spark, sf_dir):
    return q.not_in_table(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels")
    )


NULLED = """(select l_orderkey, nullif(l_linenumber, 7) as l_linenumber,
    nullif(l_returnflag, 'R') as l_returnflag from lineitem)"""


def nulled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
    )


@query(f"""select 'min_rows' as "check", '1000' as subject, count(*)::varchar as actual,
        count(*) >= 1000 as ok from {NULLED}
    union all select 'max_rows', '5000', count(*)::varchar, count(*) <= 5000 from {NULLED}
    union all select 'column', 'l_orderkey', 'int64', true
    union all select 'column', 'l_returnflag', 'string', false
    union all select 'column', 'l_comment', 'missing', false
    union all select 'not_null', 'l_orderkey', count(*) filter (where l_orderkey is null)::varchar,
        count(*) = count(l_orderkey) from {NULLED}
    union all select 'not_null', 'l_returnflag',
        count(*) filter (where l_returnflag is null)::varchar,
        count(*) = count(l_returnflag) from {NULLED}
    union all select 'unique', 'l_orderkey, l_linenumber', (sum(n) - count(*))::bigint::varchar,
        sum(n) = count(*)
        from (select count(*) as n from {NULLED} group by l_orderkey, l_linenumber)""")
def validation(spark, sf_dir):
    spec = {
        "columns": {"l_orderkey": "int", "l_returnflag": "double", "l_comment": "string"},
        "not_null": ["l_orderkey", "l_returnflag"],
        "unique": ["l_orderkey", "l_linenumber"],
        "min_rows": 1000,
        "max_rows": 5000,
    }
    return vm.validation(nulled_lines(spark, sf_dir), spec)


@query(f"""select sum(n)::bigint as row_count, 'l_comment' as missing,
        '{{"l_linenumber":' || (select count(*) from {NULLED} where l_linenumber is null) || '}}'
        as key_nulls, (sum(n) - count(*))::bigint as key_duplicates, true as needs_cleanup
    from (select count(*) as n from {NULLED} group by l_orderkey, l_linenumber)""")
def key_report(spark, sf_dir):
    report = vm.key_report(
        nulled_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_comment"]
    )
    return report.withColumn("key_nulls", F.to_json("key_nulls"))


@query("""select count(*) as row_count, null::varchar as missing, '{}' as key_nulls,
    count(*) - count(distinct (conv_id, turn)) as key_duplicates,
    count(*) > count(distinct (conv_id, turn)) as needs_cleanup from conversations""")
def key_report_conversations(spark, sf_dir):
    report = vm.key_report(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    return report.withColumn("key_nulls", F.to_json("key_nulls"))


@query(f"""select 'null' as problem, 'l_linenumber' as key, count(*) as rows
        from {NULLED} where l_linenumber is null
    union all select 'duplicate', 'l_orderkey, l_linenumber', (sum(n) - count(*))::bigint
        from (select count(*) as n from {NULLED} group by l_orderkey, l_linenumber)""")
def key_problems(spark, sf_dir):
    return vm.key_problems(nulled_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


# --- profiles ------------------------------------------------------------------------------


@query("select count(*) as rows from conversations")
def row_count(spark, sf_dir):
    return vm.row_count(table(spark, sf_dir, "conversations"))


@query(f"""select 'l_orderkey' as "column", count(*) - count(l_orderkey) as nulls from {NULLED}
    union all select 'l_linenumber', count(*) - count(l_linenumber) from {NULLED}
    union all select 'l_returnflag', count(*) - count(l_returnflag) from {NULLED}""")
def null_counts(spark, sf_dir):
    return vm.null_counts(nulled_lines(spark, sf_dir))


@query(f"""select sum(n)::bigint as rows, count(*) as distinct_keys,
    (sum(n) - count(*))::bigint as duplicates
    from (select count(*) as n from {NULLED} group by l_orderkey, l_linenumber)""")
def duplicate_keys(spark, sf_dir):
    return vm.duplicate_keys(nulled_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def column_profile(source: str, column: str, kind: str, size: str) -> str:
    return f"""select '{column}' as "column", '{kind}' as type, count(*) as rows,
        count(*) - count({column}) as nulls, coalesce(sum({size}), 0)::bigint as bytes from {source}"""


@query(
    " union all ".join(
        [
            column_profile("events", "event_id", "bigint", "8"),
            column_profile("events", "ts", "timestamp_ntz", "8"),
            column_profile("events", "user_id", "bigint", "8"),
            column_profile("events", "event_type", "string", "strlen(event_type)"),
            column_profile("events", "value", "double", "8"),
            column_profile("events", "props", "string", "strlen(props)"),
        ]
    )
)
def profile(spark, sf_dir):
    return vm.profile(table(spark, sf_dir, "events"))


@query(
    " union all ".join(
        [
            column_profile("embeddings", "vec_id", "bigint", "8"),
            column_profile("embeddings", "embedding", "array<float>", "4 * len(embedding)"),
            column_profile("embeddings", "label", "int", "4"),
        ]
    )
)
def profile_nested(spark, sf_dir):
    return vm.profile(table(spark, sf_dir, "embeddings"))


@query(
    " union all ".join(
        [
            column_profile("benchmark", "item_id", "bigint", "8"),
            column_profile("benchmark", "text", "string", "strlen(text)"),
        ]
    )
)
def profile_text(spark, sf_dir):
    return vm.profile(table(spark, sf_dir, "benchmark"))


@query("""select substr(md5(count(*) ||
    'struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>'), 1, 16) as tag
    from documents""")
def fingerprint(spark, sf_dir):
    return vm.fingerprint(table(spark, sf_dir, "documents"))


def framed(column: str) -> str:
    text = f"{column}::varchar"
    return f"coalesce(length({text}) || ':' || {text}, '-')"


@query(f"""select substr(md5(count(*) ||
    'struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>'), 1, 16) as tag,
    coalesce(sum(('0x' || substr(md5({" || ".join(map(framed, ["doc_id", "text", "lang", "source", "n_chars"]))}), 1, 15))::bigint), 0)::varchar
    as content_hash from documents""")
def content_fingerprint(spark, sf_dir):
    return vm.fingerprint(table(spark, sf_dir, "documents"), content=True)


# --- tables --------------------------------------------------------------------------------


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order of ``lineitem`` under twice its key: half of them update an order
    (some fields with NULL), the others are new."""
    flag, status = F.max("l_returnflag"), F.max("l_linestatus")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_orderkey") * 2).alias("o_orderkey"))
        .agg(
            F.count("*").alias("o_custkey"),
            F.when(status == "F", None).otherwise(flag).alias("o_orderstatus"),
            F.max("l_shipdate").alias("o_orderdate"),
        )
    )


CHANGES = """(select l_orderkey * 2 as o_orderkey, count(*) as o_custkey,
    case when max(l_linestatus) = 'F' then null else max(l_returnflag) end as o_orderstatus,
    max(l_shipdate) as o_orderdate from lineitem group by l_orderkey)"""

MERGED = f"""select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
    case when s.o_orderkey is null then t.o_custkey else s.o_custkey end as o_custkey,
    case when s.o_orderkey is null then t.o_orderstatus else s.o_orderstatus end as o_orderstatus,
    t.o_totalprice,
    case when s.o_orderkey is null then t.o_orderdate else s.o_orderdate end as o_orderdate,
    t.o_orderpriority
    from orders t full join {CHANGES} s on t.o_orderkey = s.o_orderkey"""


@query(MERGED)
def merge_rows(spark, sf_dir):
    return vm.merge_rows(
        table(spark, sf_dir, "orders"), order_changes(spark, sf_dir), "o_orderkey"
    )


@query(MERGED)
def merge_table(spark, sf_dir):
    """Overwrite, then merge, then read the stored table."""
    root = scratch_folder(spark, "merge")
    vm.overwrite(table(spark, sf_dir, "orders"), root, "orders")
    vm.merge(order_changes(spark, sf_dir), root, "orders", key="o_orderkey")
    return vm.read_table(spark, root, "orders")


KEPT = f"""(select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from ({MERGED})
    union all select -o_orderkey, o_custkey, 'again', o_orderpriority from orders where o_custkey % 3 = 0)"""


@query(f"""select count(*) as rows, coalesce(sum(('0x' || substr(md5({" || ".join(
    map(framed, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]))}), 1, 15))::bigint), 0)::varchar
    as content_hash from {KEPT}""")
def content_kept(spark, sf_dir):
    """The content hash that a table carries through a merge and an append, from its note."""
    root = scratch_folder(spark, "content")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    again = orders.where("o_custkey % 3 = 0").withColumns(
        {"o_orderkey": -F.col("o_orderkey"), "o_orderstatus": F.lit("again")}
    )
    vm.overwrite(orders, root, "orders", content_hash=True)
    # before the append: an order of key 0 is -0 there too, and a merge would update both
    vm.merge(order_changes(spark, sf_dir).drop("o_orderdate"), root, "orders", key="o_orderkey")
    vm.append(again, root, "orders")
    row = (vm.table_rows(spark, root, "orders"), vm.table_content(spark, root, "orders"))
    return spark.createDataFrame([row], "rows bigint, content_hash string")


APPENDED = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority, null::bigint as lines from orders
    union all select l_orderkey, null, max(l_returnflag), null, null, null, count(*)
        from lineitem group by l_orderkey"""


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_returnflag").alias("o_orderstatus"), F.count("*").alias("lines"))
    )


@query(APPENDED)
def append_rows(spark, sf_dir):
    return vm.append_rows(table(spark, sf_dir, "orders"), order_lines(spark, sf_dir))


@query(APPENDED)
def append_table(spark, sf_dir):
    """Append with a new column to a partitioned table, and read it back."""
    root = scratch_folder(spark, "append")
    vm.overwrite(table(spark, sf_dir, "orders"), root, "orders", partition_by=["o_orderstatus"])
    vm.append(order_lines(spark, sf_dir), root, "orders", partition_by=["o_orderstatus"])
    return vm.read_table(spark, root, "orders")


@query(MERGED.replace("t.o_totalprice,", "t.o_totalprice, 'kept' as note,"))
def merge_typed(spark, sf_dir):
    """A composite key in other types than the table's: text and a wider number."""
    root = scratch_folder(spark, "merge")
    orders = table(spark, sf_dir, "orders").withColumn("note", F.lit("kept"))
    vm.overwrite(orders.withColumn("half", F.col("o_orderkey") % 2), root, "orders")
    changes = order_changes(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("decimal(20,0)").alias("o_custkey"),
        "o_orderstatus",
        "o_orderdate",
        (F.col("o_orderkey") % 2).cast("double").alias("half"),
        F.lit("kept").alias("note"),
    )
    vm.merge(changes, root, "orders", key=["o_orderkey", "half"])
    return vm.read_table(spark, root, "orders").drop("half")


@query(APPENDED)
def append_typed(spark, sf_dir):
    """Values of other types that the table's types hold exactly."""
    root = scratch_folder(spark, "append")
    vm.overwrite(table(spark, sf_dir, "orders"), root, "orders")
    lines = order_lines(spark, sf_dir).withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    vm.append(lines, root, "orders")
    return vm.read_table(spark, root, "orders")


HASH = "substr(md5({0} || 'struct<{1}>'), 1, 16)"
REGION = "r_regionkey:{0},r_name:string"


@query(f"""with n as (select count(*) as c, count(*) filter (where r_regionkey >= 3) as late from region),
    m as (select count(distinct o_orderkey) as new from orders)
    select 1 as step, 1 as version, c as rows, {HASH.format("c", "r_regionkey:bigint,r_name:string")} as hash from n
    union all select 2, 2, c + late, {HASH.format("late", "r_regionkey:bigint,r_name:string")} from n
    union all select 3, 3, c + late + new, {HASH.format("new", "r_regionkey:bigint,r_name:string")} from n, m""")
def write_result(spark, sf_dir):
    """What overwrite, append and merge report."""
    root = scratch_folder(spark, "results")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name")
    new = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1000).cast("bigint").alias("r_regionkey"), F.lit("new").alias("r_name")
    )
    done = [
        vm.overwrite(region, root, "regions"),
        vm.append(region.where("r_regionkey >= 3"), root, "regions"),
        vm.merge(new, root, "regions", key="r_regionkey"),
    ]
    rows = [(k + 1, r.version, r.rows, r.hash) for k, r in enumerate(done)]
    return spark.createDataFrame(rows, "step int, version int, rows bigint, hash string")


@query(f"""select 'absent' as kind, 'l_comment' as columns, null::bigint as bad_rows, (select count(*) from {NULLED}) as row_count
    union all select 'null', 'l_linenumber', count(*), (select count(*) from {NULLED}) from {NULLED} where l_linenumber is null
    union all select 'repeated', 'l_orderkey,l_linenumber', (sum(n) - count(*))::bigint, sum(n)::bigint
        from (select count(*) as n from {NULLED} group by l_orderkey, l_linenumber)""")
def validate_asset(spark, sf_dir):
    """The report on a stored table."""
    root = scratch_folder(spark, "report")
    vm.overwrite(nulled_lines(spark, sf_dir), root, "lines")
    report = vm.validate_asset(
        spark, root, "lines", key=["l_orderkey", "l_linenumber"], expected_columns=["l_returnflag", "l_comment"]
    )
    rows = [(f.kind, ",".join(f.columns), f.rows, report.row_count) for f in report.findings]
    return spark.createDataFrame(rows, "kind string, columns string, bad_rows bigint, row_count bigint")


@query("select * from customer")
def overwrite_table(spark, sf_dir):
    """A second overwrite replaces rows, schema and partitioning."""
    root = scratch_folder(spark, "overwrite")
    vm.overwrite(table(spark, sf_dir, "orders"), root, "accounts")
    vm.overwrite(
        table(spark, sf_dir, "customer"), root, "accounts", partition_by=["c_mktsegment"]
    )
    return vm.read_table(spark, root, "accounts")


@query(f"select date, entity, page_id, views from {LINE_FACTS}")
def write_clustered(spark, sf_dir):
    path = f"{scratch_folder(spark, 'clustered')}/facts"
    vm.write_clustered(line_facts(spark, sf_dir), path, ["page_id", "date"])
    return spark.read.parquet(path)


@query(f"select date, entity, page_id, views from {LINE_FACTS}")
def write_interleaved(spark, sf_dir):
    """Laid out for lookups by page and by day alike, and read back."""
    path = f"{scratch_folder(spark, 'interleaved')}/facts"
    vm.write_interleaved(line_facts(spark, sf_dir), path, ["page_id", "date"], bloom=["page_id"])
    return spark.read.parquet(path)


@query(f"select date, entity, page_id, views from {EVENT_FACTS}")
def write_facts(spark, sf_dir):
    """Written twice by day: the second write replaces the first."""
    path = f"{scratch_folder(spark, 'facts')}/facts"
    facts = event_facts(spark, sf_dir)
    vm.write_facts(facts.withColumn("views", F.col("views") + 1), path)
    vm.write_facts(facts, path)
    return vm.read_facts(spark, path)


# --- raw assets ----------------------------------------------------------------------------


@query("select * from events")
def asset_json(spark, sf_dir):
    """gzip JSON lines out and in, timestamps without zone among them."""
    base = scratch_folder(spark, "assets")
    events = table(spark, sf_dir, "events")
    vm.write_asset(events, base, "events", "json", compression="gzip")
    return vm.read_asset(spark, base, "events", "json", schema=events.schema)


@query("select props as value, count(*) as lines from events group by props")
def asset_text(spark, sf_dir):
    """bzip2 text out and in."""
    base = scratch_folder(spark, "assets")
    props = table(spark, sf_dir, "events").select("props")
    vm.write_asset(props, base, "props", "text", compression="bzip2")
    lines = vm.read_asset(spark, base, "props", "text", extension="txt.bz2")
    return lines.groupBy("value").agg(F.count("*").alias("lines"))


@query("select * from part")
def asset_csv(spark, sf_dir):
    base = scratch_folder(spark, "assets")
    part = table(spark, sf_dir, "part")
    vm.write_asset(part, base, "part", "csv", header=True)
    return vm.read_asset(spark, base, "part", "csv", schema=part.schema, header=True)


@query("""select n_name, r_name, count(*) as accounts, min(balance) as low, max(balance) as high
    from (select c_nationkey as nation, c_acctbal as balance from customer
          union all select s_nationkey, s_acctbal from supplier)
    join nation on nation = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2""")
def sql_over_assets(spark, sf_dir):
    """SQL over views of parquet assets, one of them two files of the same columns."""
    base = scratch_folder(spark, "assets")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    for name, accounts, letter in [("customers", customer, "c"), ("suppliers", supplier, "s")]:
        columns = [F.col(f"{letter}_nationkey").alias("nation"), F.col(f"{letter}_acctbal").alias("balance")]
        vm.write_asset(accounts.select(*columns), base, name)
    for name in ("nation", "region"):
        vm.write_asset(table(spark, sf_dir, name), base, name)
    vm.register_assets(
        spark,
        base,
        {"accounts": ["customers", "suppliers"], "nations": "nation", "regions": "region"},
    )
    return spark.sql("""select n_name, r_name, count(*) as accounts, min(balance) as low,
        max(balance) as high from accounts join nations on nation = n_nationkey
        join regions on n_regionkey = r_regionkey group by n_name, r_name""")


@query("""select strftime(ts, '%Y-%m-%d') as day, 1::bigint as files, true as fresh,
    (sum(strlen(event_id || '')) + count(*))::bigint as length from events group by 1""")
def list_assets(spark, sf_dir):
    """Name, age and length of the files of an asset kept by day, from the listing alone."""
    base = scratch_folder(spark, "assets")
    events = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), day("ts").alias("day"))
    # a day is in one task, so it becomes one file; a task sorts the rows of its own days only
    events.repartition("day").write.partitionBy("day").text(f"{base}/events")
    files = vm.fresh_assets(spark, base, "events/day=*/*.txt", max_age_days=1)
    now = F.current_timestamp()
    by_day = files.groupBy(F.regexp_extract("name", "^events/day=([^/]+)/part-.*[.]txt$", 1).alias("day"))
    return by_day.agg(
        F.count("*").alias("files"),
        F.min(F.col("modified").between(now - F.expr("interval 1 day"), now)).alias("fresh"),
        F.sum("length").alias("length"),
    )


@query("""select n_name, rich and n_nationkey % 3 <> 0 as found, rich as written, rich and n_nationkey % 3 = 0 as deleted
    from (select n_name, n_nationkey, exists (select 1 from customer where c_nationkey = n_nationkey
        and c_acctbal > 9000) as rich from nation)""")
def asset_exists(spark, sf_dir):
    """One asset for each nation that has rich customers, some of them deleted again."""
    base = scratch_folder(spark, "assets")
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    folder = F.concat(F.col("c_nationkey").cast("string"), F.lit(".parquet")).alias("nation")
    rich = customers.where("c_acctbal > 9000").select(folder, "c_custkey", "c_name")
    # all of them in one job: a folder of parquet files each
    rich.hint("rebalance", "nation").write.partitionBy("nation").parquet(f"{base}/rich")
    rows = []
    for n in nations.select("n_name", "n_nationkey").collect():  # 25 nations
        asset = f"rich/nation={n.n_nationkey}"
        written = vm.asset_exists(spark, base, asset, max_age_days=1)
        if written and n.n_nationkey % 3 == 0:
            vm.delete_asset(spark, base, asset)
        found = vm.asset_exists(spark, base, asset)
        rows.append((n.n_name, found, written, written and not found))
    return spark.createDataFrame(rows, "n_name string, found boolean, written boolean, deleted boolean")


@query("""select item_id, md5(text) as content, strlen(text)::bigint as length from benchmark
    where strlen(text) > 0""")
def asset_binary(spark, sf_dir):
    """Bytes out and in, one file per item."""
    base = scratch_folder(spark, "assets")
    name = F.concat(F.lit("item-"), F.col("item_id").cast("string"))
    items = table(spark, sf_dir, "benchmark").select(name.alias("name"), F.col("text").cast("binary").alias("content"))
    vm.write_files(items, base, "texts")
    number = F.regexp_extract("path", "item-(-?[0-9]+)$", 1).cast("bigint")
    return vm.read_asset(spark, base, "texts", "binary").select(
        number.alias("item_id"), F.md5("content").alias("content"), "length"
    )


@query("select p_partkey, p_name from part")
def asset_document(spark, sf_dir):
    """JSON documents of at most a thousand rows, each an array of the rows of a range of keys."""
    base = scratch_folder(spark, "assets")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    bucket = F.floor(F.col("p_partkey") / 1000)
    documents = part.groupBy(bucket.alias("bucket")).agg(
        F.to_json(F.collect_list(F.struct("p_partkey", "p_name"))).alias("content")
    )
    name = F.concat(F.lit("part-"), F.col("bucket").cast("string"))
    vm.write_files(documents.select(name.alias("name"), "content"), base, "parts", extension="json")
    return vm.read_asset(spark, base, "parts", "json", schema=part.schema, multiLine=True)


# --- dimension sync ------------------------------------------------------------------------


def catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A curated dimension from ``supplier`` (every 20th id) and its upstream from ``customer``."""
    current = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 20).cast("string").alias("id"),
        F.col("s_name").alias("title"),
        F.create_map(F.lit("nation"), F.col("s_nationkey").cast("string")).alias("metadata"),
        F.when(F.col("s_acctbal") > 5000, "active")
        .when(F.col("s_acctbal") > 1000, "disabled")
        .alias("status"),
        F.when(F.col("s_acctbal") <= 5000, "low balance").alias("reason"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("node"),
    )
    upstream = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("title"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("metadata"),
    )
    return current, upstream


CURRENT = """(select (s_suppkey * 20)::varchar as id, s_name as title,
    s_nationkey::varchar as nation,
    case when s_acctbal > 5000 then 'active' when s_acctbal > 1000 then 'disabled' end as status,
    case when s_acctbal <= 5000 then 'low balance' end as reason,
    case when s_acctbal > 5000 then s_name end as node from supplier)"""
UPSTREAM = """(select c_custkey::varchar as id, c_name as title, c_nationkey::varchar as nation
    from customer)"""


@query(f"""select coalesce(c.id, u.id) as id,
    case when u.id is null then c.title else u.title end as title,
    case when u.id is null then c.nation else u.nation end as nation,
    case when c.id is null then 'disabled' when u.id is null then c.status
         else coalesce(c.status, 'disabled') end as status,
    case when c.id is null then 'awaiting curation' else c.reason end as reason, c.node
    from {CURRENT} c full join {UPSTREAM} u on c.id = u.id""")
def sync_dimension(spark, sf_dir):
    synced = vm.sync_dimension(*catalog(spark, sf_dir))
    nation = F.col("metadata")["nation"].alias("nation")
    return synced.select("id", "title", nation, "status", "reason", "node")


@query(f"""select coalesce(c.id, u.id) as id,
    case when c.id is null then 'new' when u.id is null then 'removed' else 'common' end as change
    from {CURRENT} c full join {UPSTREAM} u on c.id = u.id""")
def dimension_changes(spark, sf_dir):
    return vm.dimension_changes(*catalog(spark, sf_dir))


@query(f"""select count(u.id) as total, count(*) filter (where c.id is null) as new,
    count(*) filter (where u.id is null) as removed
    from {CURRENT} c full join {UPSTREAM} u on c.id = u.id""")
def change_counts(spark, sf_dir):
    return vm.change_counts(*catalog(spark, sf_dir))
