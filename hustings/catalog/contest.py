"""Registrations, submissions, scoring and ranking.

Entries are line number and status of the line items, seats are parts, states are part types.  An entry predicts ``A``
for a seat when its largest quantity there is at least 13; entries 1 and 2 always do, and entry 2 says everything twice.
Entry 5 names both candidates for every tenth seat, ``twin`` repeats entry 2O, and ``idle`` predicts no seat that counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.operators import copies, rules, scoring


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "entry_id", F.concat(F.col("l_linenumber").cast("string"), "l_linestatus")
    )
    per_seat = lines.groupBy("entry_id", "l_partkey").agg(F.max("l_quantity").alias("q"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("state"))
    always = F.col("entry_id").substr(1, 1).isin("1", "2")
    picks = per_seat.join(parts, "l_partkey").select(
        "entry_id",
        "state",
        F.col("l_partkey").alias("constituency"),
        F.when(always | (F.col("q") >= 13), "A").otherwise("B").alias("candidate"),
    )
    first = F.col("entry_id").substr(1, 1)
    other = F.when(F.col("candidate") == "A", "B").otherwise("A")
    both = picks.where((first == "5") & (F.col("constituency") % 10 == 0)).withColumn("candidate", other)
    twin = picks.where(F.col("entry_id") == "2O").withColumn("entry_id", F.lit("twin"))
    uncounted = table(spark, sf_dir, "part").where(F.col("p_brand") == "Brand#1")
    idle = uncounted.select(F.lit("idle").alias("entry_id"), F.col("p_type").alias("state"), F.col("p_partkey").alias("constituency"), F.lit("A").alias("candidate"))
    for more in (picks.where(first == "2"), both, twin, idle):
        picks = picks.unionByName(more)
    return picks


def official(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("p_brand")
    status = (
        F.when(brand == "Brand#1", "withheld").when(brand == "Brand#2", "disputed").when(brand == "Brand#3", "repoll")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("state"),
        F.col("p_partkey").alias("constituency"),
        F.when(F.col("p_size") <= 45, "A").otherwise("B").alias("winner"),
        F.coalesce(status, F.lit("declared")).alias("status"),
    )


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    seats = scoring.counted_seats(official(spark, sf_dir))
    scores = scoring.entry_scores(scoring.state_accuracy(predictions(spark, sf_dir), seats), seats)
    times = (
        table(spark, sf_dir, "lineitem")
        .withColumn("entry_id", F.concat(F.col("l_linenumber").cast("string"), "l_linestatus"))
        .groupBy("entry_id")
        .agg(F.min("l_shipdate").alias("submitted_at"))
    )
    twin = times.where(F.col("entry_id") == "2O").withColumn("entry_id", F.lit("twin"))
    idle = times.groupBy(F.lit("idle").alias("entry_id")).agg(F.min("submitted_at").alias("submitted_at"))
    entries = times.unionByName(twin).unionByName(idle)
    ranked_out = times.where(F.col("entry_id") == "1F")
    return scoring.leaderboard(scoring.without_entries(scoring.with_absent(scores, entries), ranked_out))


_STATES = """
  seats as (select p_type as state, p_partkey as constituency, case when p_size <= 45 then 'A' else 'B' end as winner
    from part where p_brand not in ('Brand#1', 'Brand#2', 'Brand#3')),
  totals as (select state, count(*) as n_seats from seats group by 1),
  own as (select cast(l_linenumber as varchar) || l_linestatus as entry_id, l_partkey as constituency,
    case when max(l_quantity) >= 13 or l_linenumber <= 2 then 'A' else 'B' end as candidate,
    l_linenumber = 5 and l_partkey % 10 = 0 as twice from lineitem group by l_linenumber, l_linestatus, l_partkey),
  picks as (select * from own union all select 'twin', constituency, candidate, twice from own where entry_id = '2O'),
  per_state as (select entry_id, state, any_value(n_seats) as n_seats, count(*) as n_predicted,
      count(*) filter (candidate = winner and not twice) as n_correct,
      count(*) filter (candidate = winner and not twice)::double / any_value(n_seats) as accuracy
    from picks join seats using (constituency) join totals using (state) group by entry_id, state)"""
_BOARD = f"""with {_STATES},
  big as (select *, row_number() over (partition by entry_id order by n_seats desc, state desc) as rn from per_state),
  scored as (select entry_id, round(sum(accuracy) / (select count(*) from totals), 9) as aggregate,
      count(*) filter (accuracy >= 0.75) as breadth, round(max(case when rn = 1 then accuracy end), 9) as largest_accuracy
    from big group by 1),
  lines as (select cast(l_linenumber as varchar) || l_linestatus as entry_id, min(l_shipdate) as submitted_at
    from lineitem group by 1),
  times as (select * from lines union all select 'twin', submitted_at from lines where entry_id = '2O'
    union all select 'idle', min(submitted_at) from lines),
  scores as (select entry_id, submitted_at, coalesce(aggregate, 0) as aggregate, coalesce(breadth, 0) as breadth,
      coalesce(largest_accuracy, 0) as largest_accuracy from times left join scored using (entry_id)),
  board as (select *, rank() over w as rank, cast(count(*) over (
      partition by aggregate, submitted_at, breadth, largest_accuracy) > 1 as int) as tied
    from scores where entry_id <> '1F'
    window w as (order by aggregate desc, submitted_at, breadth desc, largest_accuracy desc))"""


@query("r8_accuracy", f"with {_STATES} select * from per_state")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    seats = scoring.counted_seats(official(spark, sf_dir))
    return scoring.state_accuracy(predictions(spark, sf_dir), seats)


@query("r10_leaderboard", f"{_BOARD} select entry_id, aggregate, breadth, largest_accuracy, rank, tied from board")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board(spark, sf_dir).select("entry_id", "aggregate", "breadth", "largest_accuracy", "rank", "tied")


@query(
    "r10_wide_leaderboard",
    """with s as (select o_orderkey as entry_id, round(o_totalprice / 500000, 2) as aggregate, o_orderdate as submitted_at,
        cast(o_custkey % 5 as bigint) as breadth, 0.5::double as largest_accuracy from orders)
    select entry_id, rank() over (order by aggregate desc, submitted_at, breadth desc, largest_accuracy desc) as rank,
      cast(count(*) over (partition by aggregate, submitted_at, breadth) > 1 as int) as tied from s""",
)
def wide_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking with as many entries as orders and many ties."""
    scores = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("entry_id"),
        F.round(F.col("o_totalprice") / 500000, 2).alias("aggregate"),
        F.col("o_orderdate").alias("submitted_at"),
        (F.col("o_custkey") % 5).alias("breadth"),
        F.lit(0.5).alias("largest_accuracy"),
    )
    return scoring.leaderboard(scores).select("entry_id", "rank", "tied")


@query(
    "r9_prizes",
    f"""{_BOARD} select entry_id, rank, case rank when 1 then 100000 when 2 then 10000 when 3 then 5000 end as prize
    from board where aggregate >= 0.75 and rank <= 3""",
)
def prize_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.prizes(board(spark, sf_dir)).select("entry_id", "rank", "prize")


@query(
    "r11_tier",
    f"""{_BOARD} select entry_id, case when aggregate >= 0.75 then 'Tier 2' when aggregate >= 0.6 then 'Tier 1'
      else 'none' end as tier from board""",
)
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board(spark, sf_dir).select("entry_id", scoring.tier(F.col("aggregate")).alias("tier"))


@query(
    "r13_publish",
    f"""{_BOARD}, shy as (select distinct cast(l_linenumber as varchar) || l_linestatus as entry_id from lineitem
      where l_linenumber = 3) select entry_id, rank from board where entry_id not in (select entry_id from shy)""",
)
def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") == 3)
    shy = lines.select(F.concat(F.col("l_linenumber").cast("string"), "l_linestatus").alias("entry_id"))
    return scoring.without_entries(board(spark, sf_dir), shy).select("entry_id", "rank")


@query(
    "r14_certificates",
    f"""{_BOARD}, members as (select cast(1 + c_nationkey % 7 as varchar) || case when c_acctbal > 3000 then 'F' else 'O' end
        as entry_id, c_mktsegment as team_name, c_custkey as person_id, c_name as full_name from customer)
    select entry_id, team_name, person_id, full_name, aggregate, case when aggregate >= 0.75 then 'Tier 2'
      when aggregate >= 0.6 then 'Tier 1' else 'none' end as tier from board join members using (entry_id)""",
)
def certificate_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = F.when(F.col("c_acctbal") > 3000, "F").otherwise("O")
    members = table(spark, sf_dir, "customer").select(
        F.concat((F.col("c_nationkey") % 7 + 1).cast("string"), letter).alias("entry_id"),
        F.col("c_mktsegment").alias("team_name"),
        F.col("c_custkey").alias("person_id"),
        F.col("c_name").alias("full_name"),
    )
    return scoring.certificates(board(spark, sf_dir), members)


@query(
    "r7_results_as_of",
    """with r as (select l_partkey as constituency, cast(l_suppkey as varchar) as winner, l_shipdate as reported_at,
        case l_returnflag when 'A' then 'declared' when 'N' then 'repoll' else 'withheld' end as status from lineitem),
    latest as (select *, row_number() over (partition by constituency order by reported_at desc, status, winner) as rn
      from r where reported_at <= timestamp '2000-05-04 00:00:00')
    select 'all' as state, constituency, winner from latest where rn = 1 and status = 'declared'""",
)
def results_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    reports = table(spark, sf_dir, "lineitem").select(
        F.lit("all").alias("state"),
        F.col("l_partkey").alias("constituency"),
        F.col("l_suppkey").cast("string").alias("winner"),
        F.col("l_shipdate").alias("reported_at"),
        F.when(flag == "A", "declared").when(flag == "N", "repoll").otherwise("withheld").alias("status"),
    )
    return scoring.counted_seats(reports, rules.moment("2000-05-04 00:00:00"))


@query(
    "j8_excluded_seats",
    """select p_type as state, p_partkey as constituency from part
    where not exists (select 1 from lineitem where l_partkey = p_partkey and l_quantity > 48)""",
)
def excluded_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_type").alias("state"), F.col("p_partkey").alias("constituency"))
    disputed = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") > 48)
        .select(F.col("l_partkey").alias("constituency"))
        .distinct()
        .join(parts, "constituency")
    )
    return scoring.without_seats(parts, disputed)


@query(
    "r6_last_valid",
    """with e as (select *, row_number() over (partition by user_id order by ts, event_id) as nth from events
      where ts + interval '330 minutes' between timestamp '2024-01-03 00:00:00' and timestamp '2024-01-10 23:59:59.999999'),
    v as (select *, row_number() over (partition by user_id order by nth desc) as back from e
      where nth <= 5 and event_type <> 'error')
    select event_id as submission_id, user_id as entry_id from v where back = 1""",
)
def last_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as submissions; an error is an invalid one.  The period is in local time."""
    submissions = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("submission_id"),
        F.col("user_id").alias("entry_id"),
        F.col("ts").alias("submitted_at"),
        (F.col("event_type") != "error").alias("ok"),
    )
    final = rules.last_valid_submissions(
        submissions, F.col("ok"), "2024-01-03 00:00:00", "2024-01-10 23:59:59.999999"
    )
    return final.select("submission_id", "entry_id")


@query(
    "r5_note",
    r"""select doc_id, cast(len(regexp_extract_all(text, '\S+')) as int) as n_words,
      source <> 'src1' and len(regexp_extract_all(text, '\S+')) >= 150 as valid from documents""",
)
def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    has_predictions = F.col("source") != "src1"
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        rules.word_count(F.col("text")).alias("n_words"),
        rules.complete_submission(has_predictions, F.col("text")).alias("valid"),
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("entry_id"),
        F.col("o_custkey").alias("person_id"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("age"),
        (F.col("o_orderstatus") == "P").alias("is_staff"),
        F.nullif(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).alias("is_contesting"),
    )


@query(
    "r1_eligible",
    """select o_orderkey as entry_id, o_custkey as person_id from orders
    where floor(o_totalprice / 10000) >= 18 and o_orderstatus <> 'P' and o_orderpriority <> '1-URGENT'""",
)
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.eligible(registrations(spark, sf_dir)).select("entry_id", "person_id")


@query(
    "r2_repeated",
    """select o_custkey as person_id, count(*) as n_registrations from orders group by 1 having count(*) > 1""",
)
def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.repeated_registrations(registrations(spark, sf_dir))


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams are customers with their orders as members; clicking events are individual entries."""
    teams = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("entry_id"), F.col("o_orderkey").alias("person_id")
    )
    singles = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "click")
        .select(F.concat(F.lit("I"), F.col("event_id").cast("string")).alias("entry_id"), F.col("event_id").alias("person_id"))
    )
    return teams.unionByName(singles)


_MEMBERS = """with m as (
      select 'T' || cast(o_custkey as varchar) as entry_id, o_orderkey as person_id from orders
      union all select 'I' || cast(event_id as varchar), event_id from events where event_type = 'click'),
    clash as (select person_id, count(distinct entry_id) as n_entries from m group by 1 having count(distinct entry_id) > 1)"""


@query("j10_roster_conflict", f"{_MEMBERS} select person_id, n_entries from clash")
def roster_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.roster_conflicts(memberships(spark, sf_dir))


@query(
    "r3_valid_teams",
    f"""{_MEMBERS} select entry_id, count(distinct person_id) as n_members from m
    where entry_id not in (select entry_id from m join clash using (person_id))
    group by 1 having count(distinct person_id) between 1 and 5""",
)
def valid_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.valid_entries(memberships(spark, sf_dir))


@query(
    "r4_late_changes",
    """select distinct o_custkey as entry_id from orders
    where o_orderdate + interval '330 minutes' > timestamp '1998-04-10 23:59:59.999999' and o_orderstatus <> 'F'""",
)
def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entry_id"),
        F.col("o_orderdate").alias("changed_at"),
        F.nullif(F.col("o_orderstatus") == "F", F.lit(False)).alias("notified"),
    )
    return rules.late_changes(members, "1998-04-10 23:59:59.999999")


@query(
    "j11_agreement",
    r"""with d as (select doc_id, string_split(text, chr(10)) as lines from documents),
    p as (select doc_id as entry_id, cast(i as int) as constituency, cast(floor(i / 4) as int) as block, lines[i + 1] as candidate
      from (select doc_id, lines, unnest(range(len(lines))) as i from d)),
    prints as (select entry_id, block, string_agg(candidate, chr(10) order by constituency) as print, count(*) as n
      from p group by 1, 2),
    first as (select block, print, n, min(entry_id) as source_entry from prints group by 1, 2, 3),
    pairs as (select entry_id, source_entry, count(*) as shared_blocks from prints join first using (block, print, n)
      where entry_id <> source_entry group by 1, 2)
    select a.entry_id, source_entry, shared_blocks, count(*) as n_common,
      count(*) filter (a.candidate = b.candidate)::double / count(*) as agreement
    from pairs join p a on a.entry_id = pairs.entry_id
      join p b on b.entry_id = source_entry and b.constituency = a.constituency group by 1, 2, 3""",
)
def agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entries, their lines as predictions, blocks of four lines."""
    lines = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("entry_id"),
        F.col("doc_id").alias("submitted_at"),
        F.posexplode(F.split("text", "\n")).alias("constituency", "candidate"),
    )
    placed = lines.withColumns({"state": F.lit("all"), "block": F.floor(F.col("constituency") / 4).cast("int")})
    return rules.copied_submissions(placed, ["block"])


# Entries are documents and their lines predictions; every tenth document with ten lines or more is submitted again later
# with one line changed in each block of ten, and every fifteenth as it is.
_COPIES = r"""lines as (select doc_id, string_split(text, chr(10)) as l from documents),
  own as (select doc_id as entry_id, cast(i as int) as constituency, l[i + 1] as candidate, len(l) as n
    from (select doc_id, l, unnest(range(len(l))) as i from lines)),
  p as (select entry_id, constituency, candidate from own
    union all select entry_id + 100000000, constituency, case when constituency % 10 = entry_id % 7
      then '-' else candidate end
    from own where entry_id % 10 = 0 and n >= 10
    union all select entry_id + 200000000, constituency, candidate from own where entry_id % 15 = 0),
  prints as (select entry_id, count(*) as size, string_agg(candidate, chr(10) order by constituency) as print from p group by 1),
  equal as (select entry_id, size, min(entry_id) over same as copy_of, count(*) over same as n_equal from prints
    window same as (partition by size, print))"""


def resubmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    own = lines.select(F.col("doc_id").alias("entry_id"), F.size("l").alias("n"), F.posexplode("l").alias("constituency", "candidate"))
    hit = F.col("constituency") % 10 == F.col("entry_id") % 7
    changed = own.where((F.col("entry_id") % 10 == 0) & (F.col("n") >= 10)).withColumns(
        {"candidate": F.when(hit, "-").otherwise(F.col("candidate")), "entry_id": F.col("entry_id") + 100_000_000}
    )
    again = own.where(F.col("entry_id") % 15 == 0).withColumn("entry_id", F.col("entry_id") + 200_000_000)
    every = own.unionByName(changed).unionByName(again)
    return every.select("entry_id", F.col("entry_id").alias("submitted_at"), F.lit("all").alias("state"), "constituency", "candidate")


@query("j11_equal_submissions", f"with {_COPIES} select * from equal")
def equal_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.equal_submissions(resubmitted(spark, sf_dir))


@query(
    "j11_changed_seats",
    f"""with {_COPIES}, first as (select entry_id, size from equal where entry_id = copy_of),
    kept as (select * from p join first using (entry_id)),
    pairs as (select b.entry_id, a.entry_id as source_entry, any_value(b.size) as size, any_value(a.size) as source_size,
        count(*) as n_shared
      from kept a join kept b on a.constituency = b.constituency and a.candidate = b.candidate and a.entry_id < b.entry_id
      group by 1, 2)
    select *, n_shared::double / greatest(size, source_size) as agreement from pairs
    where 100 * n_shared >= 80 * greatest(size, source_size)""",
)
def changed_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.near_copies(resubmitted(spark, sf_dir), 80)
