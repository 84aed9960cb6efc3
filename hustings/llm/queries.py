"""The operators over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from random import Random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm import (
    decontaminate,
    exact,
    extract,
    language,
    licenses,
    mixing,
    near,
    personal,
    prefixes,
    quality,
    repair,
    secret_scan,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_exact_dedup",
    """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op10_mix_sources",
    f"""
    with recursive sized as (
        select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
        from documents
    ), sources as (
        select source, cast(sum(size) as bigint) as source_size,
               [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
        from sized group by source
    ), total as (select sum(source_size) as t, sum(weight) as w from sources),
    levels as (
        select 0 as round, 1.5::double * t / w as level, 0::bigint as n_cut from total
        union all
        select round + 1,
               (select (1.5::double * (select t from total)
                        - 2.0::double * sum(case when weight * level > 2.0::double * source_size then source_size else 0 end))
                       / sum(case when weight * level > 2.0::double * source_size then 0 else weight end) from sources),
               (select count(*) filter (where weight * level > 2.0::double * source_size) from sources)
        from levels where n_cut < (select count(*) filter (where weight * level > 2.0::double * source_size) from sources)
    ), targets as (
        select source, source_size,
               case when weight * level > 2.0::double * source_size then 2.0::double * source_size
                    else weight * level end as target
        from sources, (select level from levels order by round desc limit 1)
    ), placed as (
        select doc_id, size, source_size, target,
               case when source_size > 0 then target / source_size else 0.0::double end as rate,
               row_number() over (partition by s.source order by size, doc_id) as turn
        from sized s join targets t on s.source is not distinct from t.source
    )
    select doc_id, size, source_size, target,
           cast(floor(turn::double * rate + {Random(mixing.SEED).random()!r}::double)
                - floor((turn - 1)::double * rate + {Random(mixing.SEED).random()!r}::double) as bigint) * size as taken
    from placed
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_license_notices")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))
    found = licenses.license_notices(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.array_join(F.transform("spans", span), ","))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents")).drop("rejected")


@query("op2_quality_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op6_warc_round_trip",
    """
    with p as (
        select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages
    ), g as (
        select *, min(page_id) over (partition by html) as first from p
    )
    select page_id, payload_bytes, sha256(html) as payload_digest,
           case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 100 and page_id <> first then first end as refers_to
    from g
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("problem")


@query("op7_benchmark_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query("op3_page_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages")).drop("n_shared")


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal_data(table(spark, sf_dir, "documents"))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295::bigint, list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda c: ord(c)::bigint)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda v, step: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)))"""


def best_sql(state: int) -> str:
    """The cheapest way on from ``state`` without an insertion before the row: (cost, audit, lines)."""
    go = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    role = {2: "user", 3: "assistant"}[go]
    kept = {0: "case first when 's' then 1 when 'u' then 2 end", 1: "case first when 'u' then 2 end",
            2: "case first when 'a' then 3 end", 3: "case first when 'u' then 2 end"}[state]
    return f"""list_sort(list_filter([
        {{'c': ways[{state + 1}].c + 2, 'a': 'D' || ways[{state + 1}].a, 't': ways[{state + 1}].t}},
        case when not gone and {kept} is not null then
            {{'c': ways[{kept} + 1].c + 5 * cut, 'a': 'K' || ways[{kept} + 1].a, 't': list_prepend(role || ':' || text, ways[{kept} + 1].t)}} end,
        case when not gone then
            {{'c': ways[{go + 1}].c + 1 + 5 * cut, 'a': 'R' || ways[{go + 1}].a, 't': list_prepend('{role}:' || text, ways[{go + 1}].t)}} end
    ], lambda way: way is not null))[1]"""


def insert_sql(own: str, after: str, role: str) -> str:
    return f"""list_sort([{own}, {{'c': ({after}).c + 5, 'a': 'I' || ({after}).a, 't': list_prepend('{role}:', ({after}).t)}}])[1]"""


@query(
    "op11_repair_conversations",
    f"""
    with recursive hit as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as m
        from conversations
    ), standing as (
        select conv_id, turn, case when m = 4 then 'user' else role end as role,
               case m when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
               unnest(case m when 0 then []::int[] when 3 then [1, 2] else [1] end) as copy
        from hit
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as place,
               count(*) over (partition by conv_id) as n
        from standing
    ), faulty as (
        select conv_id, turn, role, text, place, n, role[1] as first,
               not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
               row_number() over (partition by conv_id, role, text order by place) > 1 as again,
               not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open_end,
               lag(role[1]) over (partition by conv_id order by place) as before
        from placed
    ), judged as (
        select *, blank or again as gone, cast(open_end and not blank and not again as int) as cut from faulty
    ), counted as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (where blank) as blank, count(*) filter (where again and not blank) as duplicate,
               cast(sum(cut) as bigint) as truncated,
               count(*) filter (where place > 1 and before || first not in ('su', 'ua', 'au')) as illegal
        from judged group by conv_id
    ), ending as (
        select distinct conv_id, n + 1 as place,
               [{{'c': 0, 'a': '', 't': []::varchar[]}}, {{'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}},
                {{'c': 5, 'a': 'I', 't': ['assistant:']}}, {{'c': 0, 'a': '', 't': []::varchar[]}}] as ways
        from placed
    ), solved as (
        select conv_id, place, ways from ending
        union all
        select conv_id, place, [{insert_sql("b0", "i2", "user")}, {insert_sql("b1", "i2", "user")}, i2, i3]
        from (
            select *, {insert_sql("b2", "b3", "assistant")} as i2, {insert_sql("b3", "b2", "user")} as i3
            from (
                select j.conv_id, j.place, {best_sql(0)} as b0, {best_sql(1)} as b1, {best_sql(2)} as b2, {best_sql(3)} as b3
                from solved s join judged j on j.conv_id is not distinct from s.conv_id and j.place = s.place - 1
            )
        )
    ), every as (select distinct conv_id from conversations)
    select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
           cast(coalesce(ways[1].c, 0) as bigint) as cost, coalesce(ways[1].a, '') as audit,
           sha256(coalesce(array_to_string(ways[1].t, chr(10)), '')) as repaired_sha256
    from every e
    left join counted c on c.conv_id is not distinct from e.conv_id
    left join solved s on s.conv_id is not distinct from e.conv_id and s.place = 1
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), "times")


@query(
    "op13_prefix_trie",
    f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
    ), named as (
        select conv_id, turn, role, octet_length(encode(text)) as size,
               left(sha256(octet_length(encode(role)) || ':' || role || text), 32) as id
        from turns
    ), own as (
        select conv_id, list(id order by turn nulls first, role, id) as ids, list(size order by turn nulls first, role, id) as sizes,
               cast({crc32_sql("conv_id::varchar")} % 9 as int) as h
        from named group by conv_id
    ), rebuilt as (
        select c.conv_id, list_concat(coalesce(b.ids, [])[1:c.h], c.ids[c.h + 1:]) as ids,
               list_concat(coalesce(b.sizes, [])[1:c.h], c.sizes[c.h + 1:]) as sizes
        from own c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
    ), path as (
        select conv_id, depth, array_to_string(ids[1:depth], ',') as node, array_to_string(ids[1:depth - 1], ',') as above,
               case when depth = 0 then 0 else sizes[depth] end as size, depth = len(ids) as ended
        from (select *, unnest(range(0, len(ids) + 1)) as depth from rebuilt)
    ), node as (
        select depth, node, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ended), '')) as ends_sha256
        from path group by depth, node
    ), children as (select depth - 1 as depth, above as node, count(*) as n_children from node where depth > 0 group by all),
    counted as (select node.*, coalesce(n_children, 0) as n_children from node left join children using (depth, node)),
    below as (
        select p.depth, p.node, count(*) filter (where c.n_children = 0) as n_leaves, cast(sum((c.n_convs - 1) * c.size) as bigint) as saved_tokens
        from counted c join path p on p.conv_id = c.conv_id and p.depth <= c.depth group by all
    )
    select c.conv_id, cast(c.depth as bigint) as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
    from counted c join below using (depth, node)
    left join counted p on p.depth = c.depth - 1 and p.node = c.above
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(prefixes.sequences(table(spark, sf_dir, "conversations"))))
