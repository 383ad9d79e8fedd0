"""Histories and snapshots derived from the given tables.

Each scenario takes a whole table as the new snapshot and derives the history before it:
late arrivals are not there yet, some values were different, some rows have been withdrawn
since (they live under negative keys) and some keys have an older, closed version. The SQL
runs in Spark and in DuckDB; ``{table}`` stands for the table, braces in text are doubled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = "2024-06-01"
SECOND_DATE = "2024-07-01"
BASE_DATE = "2024-01-01"

OPEN = (
    "true as is_active, date '2024-01-01' as valid_from, cast(null as date) as valid_to, "
    "cast(null as varchar(10000)) as changes"
)


@dataclass(frozen=True)
class Scenario:
    table: str
    key: tuple[str, ...]
    values: tuple[str, ...]
    history: str
    second: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return self.key + self.values

    @property
    def recent(self) -> str:
        return f"select {', '.join(self.columns)} from {{table}}"


ORDERS = Scenario(
    table="orders",
    key=("o_orderkey",),
    values=("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    history=f"""
select o_orderkey, o_custkey,
       case when o_orderstatus = 'F' and o_totalprice > 400000 then 'O'
            else o_orderstatus end as o_orderstatus,
       case when o_totalprice < 50000 then round(o_totalprice + 25.5, 2)
            else o_totalprice end as o_totalprice,
       o_orderdate,
       case when o_orderpriority = '4-NOT SPECIFIED' and o_totalprice > 300000 then null
            else o_orderpriority end as o_orderpriority,
       {OPEN}
from {{table}} where o_orderdate < date '2001-04-01'
union all
select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {OPEN}
from {{table}} where o_orderstatus = 'P' and o_orderpriority = '5-LOW'
union all
select o_orderkey, o_custkey, 'O', o_totalprice, o_orderdate, o_orderpriority,
       false, date '2023-01-01', date '2024-01-01',
       '{{{{"o_orderstatus":["' || o_orderstatus || '","O"]}}}}'
from {{table}} where o_orderstatus <> 'O' and o_orderpriority = '1-URGENT'
""",
    second="""
select o_orderkey, o_custkey,
       case when o_orderstatus = 'O' and o_orderpriority = '2-HIGH' then 'F'
            else o_orderstatus end as o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
from {table} where o_orderdate >= date '1995-04-01'
""",
)

CUSTOMER = Scenario(
    table="customer",
    key=("c_custkey",),
    values=("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    history=f"""
select c_custkey, c_name, case when c_acctbal > 9000 then null else c_nationkey end as c_nationkey,
       case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal,
       case when c_mktsegment = 'FURNITURE' then 'HOUSEHOLD' else c_mktsegment end as c_mktsegment,
       {OPEN}
from {{table}} where c_nationkey <> 7
union all
select -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment, {OPEN}
from {{table}} where c_nationkey = 3
""",
)

PART = Scenario(
    table="part",
    key=("p_partkey",),
    values=("p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    history=f"""
select p_partkey, case when p_size = 50 then 'old ' || p_name else p_name end as p_name,
       case when p_type = 'PROMO' then null else p_brand end as p_brand, p_type,
       case when p_size < 5 then p_size + 1 else p_size end as p_size, p_retailprice,
       {OPEN}
from {{table}} where p_type <> 'SMALL'
union all
select -p_partkey - 1, p_name, p_brand, p_type, p_size, p_retailprice, {OPEN}
from {{table}} where p_type = 'LARGE'
""",
)

DOCUMENTS = Scenario(
    table="documents",
    key=("doc_id",),
    values=("text", "lang", "source", "n_chars"),
    history=f"""
select doc_id, case when lang = 'de' or source = 'src3' then text || ' "draft"' else text end as text,
       lang, case when source = 'src5' then 'src05' else source end as source,
       case when lang = 'de' then n_chars + 8 else n_chars end as n_chars,
       {OPEN}
from {{table}} where source <> 'src1'
union all
select -doc_id - 1, text, lang, source, n_chars, {OPEN}
from {{table}} where source = 'src2'
""",
)

PAGES = Scenario(
    table="pages",
    key=("page_id",),
    values=("url", "html"),
    history=f"""
select page_id, url, case when url like '%/fr/%' then html || '<!-- "old" -->' else html end as html,
       {OPEN}
from {{table}} where url not like '%/en/%'
union all
select -page_id - 1, url, html, {OPEN}
from {{table}} where url like '%page=2%'
""",
)

CONVERSATIONS = Scenario(
    table="conversations",
    key=("conv_id", "turn"),
    values=("role", "text"),
    history=f"""
select conv_id, turn, case when role = 'assistant' and turn > 1 then 'bot' else role end as role, text,
       {OPEN}
from {{table}} where turn < 3
union all
select -conv_id - 1, turn, role, text, {OPEN}
from {{table}} where role = 'system'
""",
)

EMBEDDINGS = Scenario(
    table="embeddings",
    key=("vec_id",),
    values=("embedding", "label"),
    history=f"""
select vec_id, case when label = 3 then null when label = 5 then embedding || embedding
                    else embedding end as embedding,
       case when label = 4 then 0 else label end as label,
       {OPEN}
from {{table}} where label <> 9
union all
select -vec_id - 1, embedding, label, {OPEN}
from {{table}} where label = 1
""",
)

EVENTS = Scenario(
    table="events",
    key=("event_id",),
    values=("ts", "user_id", "event_type", "value", "props"),
    history=f"""
select event_id, ts, user_id, case when event_type = 'error' then 'failure' else event_type end
       as event_type, case when value < 5 then null else value end as value,
       case when event_type = 'signup' then '{{{{"k": null}}}}' else props end as props,
       {OPEN}
from {{table}} where ts < date '2024-01-25'
union all
select -event_id - 1, ts, user_id, event_type, value, props, {OPEN}
from {{table}} where event_type = 'click'
""",
)

# (l_orderkey, l_linenumber) is not unique in the table: for the duplicate policy only.
LINEITEM = Scenario(
    table="lineitem",
    key=("l_orderkey", "l_linenumber"),
    values=(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    history=f"""
select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey,
       min(l_quantity) as l_quantity, min(l_extendedprice) as l_extendedprice,
       min(l_discount) as l_discount, min(l_tax) as l_tax,
       min(l_returnflag) as l_returnflag, min(l_linestatus) as l_linestatus,
       min(l_shipdate) as l_shipdate, {OPEN}
from {{table}} where l_shipdate < date '2001-01-01' group by l_orderkey, l_linenumber
""",
)

# A history of three runs in the month of the events: customers as of the days they acted on.
CUSTOMER_JANUARY = Scenario(
    table="customer",
    key=CUSTOMER.key,
    values=CUSTOMER.values,
    history=CUSTOMER.history,
    second="""
select c_custkey, upper(c_name) as c_name, c_nationkey,
       case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal,
       c_mktsegment
from {table} where c_nationkey <> 11
""",
)
# Customers of one nation were renumbered; without names and balances many are alike.
CUSTOMER_RENUMBERED = Scenario(
    table="customer",
    key=CUSTOMER.key,
    values=("c_nationkey", "c_mktsegment"),
    history=f"""
select case when c_nationkey < 8 then -c_custkey - 1 else c_custkey end as c_custkey, c_nationkey,
       case when c_acctbal < 0 then null else c_mktsegment end as c_mktsegment, {OPEN}
from {{table}} where c_mktsegment <> 'MACHINERY'
""",
)
JANUARY_RUNS = ("2024-01-11", "2024-01-21")

# Periods of users as events state them: with overlaps, gaps, reversed dates and wrong flags.
PERIODS = """
select user_id, event_type, event_type in ('view', 'error') as is_active,
       case when event_type = 'click' and value > 200 then null
            else cast(ts as date) end as valid_from,
       case when event_type in ('view', 'error') and value < 400 then null
            when event_type = 'signup' and value > 100 then null
            when value > 50 then date '2024-01-15'
            when event_type = 'purchase' then date '2024-01-20' else date '2024-02-01' end as valid_to,
       cast(null as varchar(10)) as changes
from {table}
"""

SCENARIOS = {
    scenario.table: scenario
    for scenario in (
        ORDERS, CUSTOMER, PART, DOCUMENTS, PAGES, CONVERSATIONS, EMBEDDINGS, EVENTS,
    )
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, scenario: Scenario) -> tuple[DataFrame, DataFrame]:
    """The snapshot and the history before it."""
    rows = table(spark, sf_dir, scenario.table)
    return spark.sql(scenario.recent, table=rows), spark.sql(scenario.history, table=rows)


def second_frame(spark: SparkSession, sf_dir: str, scenario: Scenario) -> DataFrame:
    return spark.sql(scenario.second, table=table(spark, sf_dir, scenario.table))
