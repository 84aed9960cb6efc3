"""Grids, sheets, pages and templates made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.operators.winners import pick_winners
from hustings.plans.history import labelled_results
from hustings.plans.web import candidates_from_pages
from hustings.functions.text import missing_to_null, plain_text
from hustings.session import dealt, fresh_path, materialise
from hustings.sources.grids import (
    GRID,
    RESULT_COLUMNS,
    exact_places,
    exact_position,
    find_headers,
    promote,
    read_delimited,
    rejected,
    result_records,
    select_sheets,
    source_state,
    split_cells,
    union_sources,
)
from hustings.sources.pages import elements
from hustings.sources.sinks import OUTCOME_TITLE, check_target, fill_template, write_by_state, write_submission

TITLES = ["STATE/UT NAME", "AC NO.", "AC NAME", "CANDIDATE NAME", "PARTY", "TOTAL"]


def texts(*values: str | None):
    return F.array(*[F.lit(v).cast("string") for v in values])


def order_cells() -> dict[str, F.col]:
    """Result columns read off an order; some votes are missing or not numeric, some candidates are no candidate."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return {
        "state": F.concat(F.lit(" "), F.when(F.col("o_orderstatus") == "F", "WEST bengal").otherwise("TAMIL-nadu"), F.lit(" ")),
        "constituency_no": (F.col("o_custkey") % 50).cast("string"),
        "constituency": F.concat(F.lit("AC "), (F.col("o_custkey") % 50).cast("string")),
        "candidate": F.when(price.between(440000, 450000), "NOTA")
        .when(price.between(470000, 480000), "None of the Above")
        .when(~price.between(430000, 435000), F.concat(F.lit("cand "), key.cast("string"))),
        "party": F.when(key % 3 == 0, "AIADMK").when(key % 3 == 1, "bjp west").otherwise("IND"),
        "total_votes_raw": F.when(price < 10000, "1,234")
        .when(price < 20000, "abc")
        .when(~price.between(20000, 30000), (F.floor(price / 1000) * 1000).cast("bigint").cast("string")),
    }


def order_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sources, one per order priority.  Their headers differ: row 1, row 3, row 2 without the marker, a missing
    constituency name, another column order."""
    read = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    kinds = F.substring("o_orderpriority", 1, 1)
    orders = dealt(read).withColumn("kind", kinds)
    c = order_cells()
    usual = F.array(*[c[n] for n in RESULT_COLUMNS])
    turned = F.array(*[c[n] for n in ("state", "candidate", "party", "total_votes_raw", "constituency_no", "constituency")])
    body = orders.select(
        F.concat(F.lit("source "), "kind").alias("source"),
        F.lit("results").alias("sheet"),
        (F.col("o_orderkey") + 10).alias("row_idx"),
        F.when(F.col("kind") == "5", turned).otherwise(usual).alias("cells"),
    )
    kind = F.substring("source", 8, 1)
    top = F.when(kind == "2", F.lit(3)).when(kind == "3", F.lit(2)).otherwise(F.lit(1)).cast("bigint")
    titles = (
        F.when(kind == "3", texts("State", *TITLES[1:]))
        .when(kind == "4", texts(*TITLES[:2], "AREA", *TITLES[3:]))
        .when(kind == "5", texts(*[TITLES[i] for i in (0, 3, 4, 5, 1, 2)]))
        .otherwise(texts(*TITLES))
    )
    sources = read.select(F.concat(F.lit("source "), kinds).alias("source"), F.lit("results").alias("sheet")).distinct()
    heads = sources.select("source", "sheet", top.alias("row_idx"), titles.alias("cells"))
    first = sources.select("source", "sheet", F.lit(0).cast("bigint").alias("row_idx"), texts("Results").alias("cells"))
    return union_sources([body, heads, first])


# The same orders as SQL rows; `kind` is the source, `row_idx` the grid row.
ORDER_ROWS = """
  select 'source ' || substr(o_orderpriority, 1, 1) as source, o_orderkey + 10 as row_idx,
    ' ' || case when o_orderstatus = 'F' then 'WEST bengal' else 'TAMIL-nadu' end || ' ' as state,
    case when o_orderstatus = 'F' then 'West Bengal' else 'Tamil-Nadu' end as tidy_state,
    cast(o_custkey % 50 as varchar) as constituency_no,
    'AC ' || cast(o_custkey % 50 as varchar) as constituency,
    case when o_totalprice between 440000 and 450000 then 'NOTA'
         when o_totalprice between 470000 and 480000 then 'None of the Above'
         when o_totalprice not between 430000 and 435000 then 'cand ' || cast(o_orderkey as varchar) end as candidate,
    case o_orderkey % 3 when 0 then 'AIADMK' when 1 then 'bjp west' else 'IND' end as party,
    case when o_totalprice < 10000 then '1,234' when o_totalprice < 20000 then 'abc'
         when o_totalprice not between 20000 and 30000
         then cast(cast(floor(o_totalprice / 1000) * 1000 as bigint) as varchar)
    end as total_votes_raw
  from orders
"""


@query(
    "s3_promote_header",
    f"""with r as ({ORDER_ROWS})
    select source, row_idx, case when source <> 'source 3' then state end as state, constituency_no, constituency,
      candidate, party, total_votes_raw from r where source <> 'source 4'""",
)
def promote_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_records(order_grid(spark, sf_dir), fallback=2).drop("sheet")


@query(
    "s9_rejected_sources",
    f"""with r as ({ORDER_ROWS})
    select distinct source, case source when 'source 3' then 'no header row' else 'no column constituency' end as reason
    from r where source in ('source 3', 'source 4')""",
)
def rejected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = find_headers(order_grid(spark, sf_dir))
    return rejected(headers, exact_places(RESULT_COLUMNS), ["constituency"]).drop("sheet")


def _labelled_sql(names: str) -> str:
    return f"""with r as ({ORDER_ROWS}), kept as (
      select source, row_idx, tidy_state as state, constituency_no, constituency, candidate, party,
        cast(coalesce(try_cast(case when total_votes_raw <> '1,234' then total_votes_raw end as double), 0) as double)
          as total_votes
      from r where source not in ('source 3', 'source 4') and candidate is not null and total_votes_raw is not null
        and {names})
    select *, cast(total_votes = max(total_votes) over (partition by source, constituency_no) as int) as win from kept"""


@query(
    "s2_delimited_grid",
    """select o_orderkey, case when o_orderkey % 3 > 0 then cast(o_orderkey as varchar) end as a,
      case when o_custkey % 4 > 0 then cast(o_custkey as varchar) end as b, o_orderpriority || ', "x"' as c,
      case when o_orderkey % 2 = 0 then 'end' end as d, 4 as n from orders""",
)
def delimited_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with empty cells at every place and quoted ones, cut into cells."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    line = F.concat_ws(
        ",",
        F.when(key % 3 > 0, key.cast("string")).otherwise(""),
        F.when(customer % 4 > 0, customer.cast("string")).otherwise(""),
        F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x"""')),
        F.when(key % 2 == 0, "end").otherwise(""),
    )
    cells = table(spark, sf_dir, "orders").select("o_orderkey", F.transform(split_cells(line), missing_to_null).alias("cells"))
    named = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate("abcd")]
    return cells.select("o_orderkey", *named, F.size("cells").alias("n"))


@query("e1_labelled_results", _labelled_sql("upper(candidate) not in ('NOTA', 'NONE OF THE ABOVE')"))
def labelled_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_results(order_grid(spark, sf_dir)).drop("sheet")


@query("e1_labelled_results_exact", _labelled_sql("candidate <> 'NOTA'"))
def labelled_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_results(order_grid(spark, sf_dir), broad=False).drop("sheet")


def _tagged(
    df: DataFrame, source: str, sheet: str, name: str, nation: str, amount: str, key: str, with_key: bool
) -> list[DataFrame]:
    """One source with its sheets; the header is row 0."""
    titles = ["Candidate", "Constituency", "Amount"] if with_key else ["Candidate", "Amount"]
    values = [F.col(name), F.col(nation).cast("string"), F.floor(F.abs(amount)).cast("bigint").cast("string")]
    body = df.select(
        F.lit(source).alias("source"),
        F.expr(sheet).alias("sheet"),
        (F.col(key) + 1).cast("bigint").alias("row_idx"),
        F.array(*(values if with_key else [values[0], values[2]])).alias("cells"),
    )
    heads = body.select("source", "sheet").distinct()
    return [body, heads.select("*", F.lit(0).cast("bigint").alias("row_idx"), texts(*titles).alias("cells")).select(GRID)]


@query(
    "s2_multiline_records",
    """with o as (select o_orderkey % 4 as part, o_orderkey, o_orderpriority as p, o_orderstatus as s, o_custkey as c from orders)
    select part || '' as part, row_number() over (partition by part order by o_orderkey) - 1 as row_idx, cast(o_orderkey as varchar) as key,
      case c % 3 when 0 then p || chr(10) || '"' || s || '", two' || chr(10) || chr(10) || 'end' when 1 then p || ', 5" ' || s else p || '"' end as note,
      cast(c as varchar) as customer
    from o""",
)
def multiline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written with quoted line breaks, quotes and separators, read in splits of 64 kB."""
    c = F.col("o_custkey")
    cells = (
        F.when(c % 3 == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('\n""'), "o_orderstatus", F.lit('"", two\n\nend"')))
        .when(c % 3 == 1, F.concat(F.lit('"'), "o_orderpriority", F.lit(', 5"" '), "o_orderstatus", F.lit('"')))
        .otherwise(F.concat("o_orderpriority", F.lit('"')))
    )
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), cells, c.cast("string"))
    path = fresh_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 4).alias("part"), "o_orderkey", line.alias("value"))
    placed = orders.repartition(4, "part").sortWithinPartitions("part", "o_orderkey")
    placed.select("part", "value").write.partitionBy("part").option("compression", "none").text(path)
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        grid = read_delimited(spark, path, glob="*.txt")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
    return grid.select(
        F.regexp_extract("source", "part=([0-9]+)", 1).alias("part"),
        "row_idx",
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("key", "note", "customer"))],
    )


@query(
    "s1_multi_source_union",
    """with r as (
      select 'customer' as state, c_mktsegment as sheet, c_name as candidate,
        cast(c_nationkey as varchar) as constituency, cast(cast(floor(abs(c_acctbal)) as bigint) as varchar) as amount
      from customer
      union all
      select 'Supplier', 'suppliers', s_name, cast(s_nationkey as varchar),
        cast(cast(floor(abs(s_acctbal)) as bigint) as varchar) from supplier)
    select * from r where sheet in ('BUILDING', 'MACHINERY', 'suppliers')""",
)
def multi_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources, one lacking the constituency column; one of the requested sheets does not exist."""
    customer, supplier, part = (table(spark, sf_dir, t) for t in ("customer", "supplier", "part"))
    grid = union_sources(
        _tagged(customer, "customer2021", "c_mktsegment", "c_name", "c_nationkey", "c_acctbal", "c_custkey", True)
        + _tagged(supplier, "Supplier2021", "'suppliers'", "s_name", "s_nationkey", "s_acctbal", "s_suppkey", True)
        + _tagged(part, "part2021", "'BUILDING'", "p_name", "p_size", "p_retailprice", "p_partkey", False)
    )
    wanted = select_sheets(grid, ["BUILDING", "MACHINERY", "suppliers", "Z9"])
    headers = find_headers(wanted, "Candidate")
    places = {
        "candidate": exact_position(["Candidate"]),
        "constituency": exact_position(["Constituency", "Constituency_Name"]),
        "amount": exact_position(["Amount"]),
    }
    records = promote(wanted, headers, places, required=["constituency"])
    return records.select(source_state(F.col("source")).alias("state"), "sheet", "candidate", "constituency", "amount")


_PLAIN = r"""regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(m, '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&'),
  '^[\s\x1c-\x1f\x{85}\p{Z}]+', ''), '[\s\x1c-\x1f\x{85}\p{Z}]+$', '')"""


@query(
    "s7_html_items",
    rf"""with found as (
      select page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1) as items from pages),
    flat as (select page_id, unnest(items) as m, unnest(range(len(items))) as i from found)
    select page_id, cast(i as int) as item_idx, {_PLAIN} as item from flat""",
)
def html_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    items = pages.select("page_id", F.posexplode(elements(F.col("html"), "li")).alias("item_idx", "m"))
    return items.select("page_id", "item_idx", plain_text(F.col("m")).alias("item"))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with two candidate rows and one row without cells; some pages lack the table."""
    name, nation = F.col("c_name"), F.col("c_nationkey").cast("string")
    amount = F.floor(F.abs("c_acctbal")).cast("bigint").cast("string")
    table_id = F.when(F.col("c_mktsegment") == "MACHINERY", "table9").otherwise("table1")
    titles = ["Sno", "Candidate", "Constituency Name", "Party", "Criminal Case", "Education", "Total Assets"]
    header = "<tr>" + "".join(f"<th>{t}</th>" for t in titles) + "</tr>"
    html = F.concat(
        F.lit('<html><table id="table0"><tr><td>menu</td></tr></table><TABLE class="w3" id="'),
        table_id,
        F.lit(f'">{header}<tr><td>1</td><td><b>\n '), name, F.lit(" &amp; Sons</b><!-- x --></td><td>AC "), nation,
        F.lit("</td><td>"), F.col("c_mktsegment"), F.lit("</td><td>"), F.lit("2"), F.lit("</td><td>Graduate</td><td>Rs&nbsp;"),
        amount, F.lit(" ~ 1 Lacs+</td></tr><tr></tr><tr><td>2<td title='a>b'>"), F.lit("D&#39;Souza &#x41;</td><td>AC "), nation,
        F.lit("</td><td>IND<table><tr><td> west</td></tr></table></td><td></td><td>n/a</td><td>Nil</td></tr></table></html>"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return dealt(customers).select(
        F.concat(F.lit("s"), F.col("c_custkey").cast("string"), F.lit("2021")).alias("source"), html.alias("html")
    )


@query(
    "s7_html_table",
    """with c as (select replace('s' || cast(c_custkey as varchar) || '2021', '2021', '') as state, c_name,
        'AC ' || cast(c_nationkey as varchar) as constituency, c_mktsegment as party,
        cast(cast(floor(abs(c_acctbal)) as bigint) as varchar) as amount
      from customer where c_mktsegment <> 'MACHINERY')
    select state, 1 as row_idx, c_name || ' & Sons' as candidate, constituency, party, '2' as criminal_cases,
      'Graduate' as education, 'Rs' || chr(160) || amount || ' ~ 1 Lacs+' as total_assets from c
    union all
    select state, 3, 'D''Souza A', constituency, 'IND   west', '', 'n/a', 'Nil' from c""",
)
def html_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = candidates_from_pages(customer_pages(spark, sf_dir))
    return found.drop("source", "page").withColumn("row_idx", F.col("row_idx").cast("int"))


@query(
    "s13_template_fill",
    f"""with p as (
      select l_returnflag as sheet, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
        row_number() over (partition by l_returnflag, l_orderkey order by l_tax desc, l_partkey, l_suppkey,
          l_linenumber, l_shipdate, l_extendedprice) as rn from lineitem)
    select sheet, cast(l_orderkey as varchar) || '|' || cast(l_partkey as varchar) || '|'
      || case when sheet = 'R' then '' else cast(l_suppkey as varchar) || '|' end
      || case when rn = 1 then 'W' else 'L' end as line from p
    union all
    select distinct sheet, case when sheet = 'R' then 'Constituency|Part|{OUTCOME_TITLE}'
      else 'Constituency|Part|Supplier|{OUTCOME_TITLE}' end from p""",
)
def template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item is a template row; sheets name the outcome in different columns."""
    lines = table(spark, sf_dir, "lineitem")
    row_id = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    places = {
        "source": F.concat(F.lit("book "), "l_returnflag"),
        "sheet": F.col("l_returnflag"),
        "row_idx": F.abs(F.xxhash64("l_orderkey", *row_id) % F.lit(2**61)) + 1,
    }
    cells = {"a": F.col("l_orderkey"), "b": F.col("l_partkey"), "c": F.col("l_suppkey")}
    outcomes = (
        pick_winners(lines.select("l_returnflag", "l_orderkey", "l_tax", *row_id), ["l_returnflag", "l_orderkey"], "l_tax", row_id)
        .withColumns(places)
        .select("source", "sheet", "row_idx", "outcome")
    )
    rows = lines.select(*[v.alias(k) for k, v in places.items()], *[v.cast("string").alias(k) for k, v in cells.items()])
    short = F.col("sheet") == "R"
    # The sheets with a supplier keep a stale outcome, the others end before the outcome column.
    body = rows.select(
        "source", "sheet", "row_idx", F.when(short, F.array("a", "b")).otherwise(F.array("a", "b", "c", F.lit("?"))).alias("cells")
    )
    sheets = lines.select(
        F.concat(F.lit("book "), "l_returnflag").alias("source"), F.col("l_returnflag").alias("sheet")
    ).distinct()
    heads = sheets.select(
        "source",
        "sheet",
        F.lit(0).cast("bigint").alias("row_idx"),
        F.when(short, texts("Constituency", "Part", OUTCOME_TITLE))
        .otherwise(texts("Constituency", "Part", "Supplier", OUTCOME_TITLE))
        .alias("cells"),
    )
    filled = fill_template(materialise(union_sources([body, heads])), outcomes)
    return filled.select("sheet", F.array_join("cells", "|").alias("line"))


def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("state "), F.col("c_nationkey").cast("string")).alias("state"),
        F.col("c_mktsegment").alias("constituency"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("candidate"),
        F.when(F.col("c_acctbal") > 5000, "WIN").otherwise("LOSS").alias("outcome"),
        "c_custkey",
    )


@query(
    "s11_submission",
    """select 'state ' || c_nationkey as state, c_mktsegment as constituency, c_name || ', "' || c_mktsegment || '"' as candidate,
      case when c_acctbal > 5000 then 'WIN' else 'LOSS' end as outcome from customer where c_nationkey > 3""",
)
def flat_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat submission written, replaced by a second run and read back; columns that do not belong to it are not written."""
    rows, path = submission(spark, sf_dir), fresh_path(spark, "submission")
    write_submission(rows, path, "csv", check_target(spark, path))
    again = rows.where(F.substring_index("state", " ", -1).cast("int") > 3)
    write_submission(again, path, "csv", check_target(spark, path, True))
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(
    "s12_states_replaced",
    """select 'state ' || c_nationkey as state, c_custkey, case when c_nationkey % 3 = 0 then 'LOSS'
      when c_acctbal > 5000 then 'WIN' else 'LOSS' end as outcome, c_nationkey % 3 = 0 as replaced from customer
    where c_nationkey % 3 <> 0 or c_mktsegment <> 'BUILDING'""",
)
def states_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder per state; the second run holds every third state, with other outcomes and fewer rows, and replaces only these."""
    rows, path = submission(spark, sf_dir).withColumn("replaced", F.lit(False)), fresh_path(spark, "states")
    write_by_state(rows, path, ["c_custkey"], fmt="parquet", mode=check_target(spark, path))
    again = rows.where((F.substring_index("state", " ", -1).cast("int") % 3 == 0) & (F.col("constituency") != "BUILDING"))
    again = again.withColumns({"outcome": F.lit("LOSS"), "replaced": F.lit(True)})
    write_by_state(again, path, ["c_custkey"], fmt="parquet", mode=check_target(spark, path, True))
    return spark.read.parquet(path).select("state", "c_custkey", "outcome", "replaced")
