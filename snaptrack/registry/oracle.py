"""SQL that states the expected rows of each registered query."""

from __future__ import annotations

from snaptrack.registry.scenarios import (
    CONVERSATIONS,
    CUSTOMER,
    CUSTOMER_JANUARY,
    CUSTOMER_RENUMBERED,
    DOCUMENTS,
    EMBEDDINGS,
    EVENTS,
    JANUARY_RUNS,
    LINEITEM,
    ORDERS,
    PAGES,
    PART,
    PERIODS,
    RUN_DATE,
    SCENARIOS,
    SECOND_DATE,
    Scenario,
)

META = "is_active, valid_from, valid_to, changes"


def source(template: str, scenario: Scenario) -> str:
    return template.format(table=scenario.table)


def pairs(
    scenario: Scenario, recent: str | None = None, history: str | None = None
) -> str:
    """CTEs ``snap``, ``hist``, ``act`` and ``pairs`` (new values n_, old values o_, event)."""
    recent = recent or source(scenario.recent, scenario)
    history = history or source(scenario.history, scenario)
    on = " and ".join(f"n.{k} = o.{k}" for k in scenario.key)
    keys = ", ".join(f"coalesce(n.{k}, o.{k}) as {k}" for k in scenario.key)
    news = ", ".join(f"n.{v} as n_{v}" for v in scenario.values)
    olds = ", ".join(f"o.{v} as o_{v}" for v in scenario.values)
    differs = " or ".join(f"n.{v} is distinct from o.{v}" for v in scenario.values)
    first = scenario.key[0]
    return f"""
with snap as ({recent}),
hist as ({history}),
act as (select * from hist where is_active),
pairs as (
  select {keys}, {news}, {olds},
         o.valid_from as o_valid_from, o.valid_to as o_valid_to, o.changes as o_changes,
         case when o.{first} is null then 'insert'
              when n.{first} is null then 'missing'
              when {differs} then 'update'
              else 'unchanged' end as event
  from snap n full outer join act o on {on}
)"""


def log(scenario: Scenario) -> str:
    """Change log text of a pair."""
    parts = []
    for v in scenario.values:
        new = f"coalesce(to_json(cast(n_{v} as varchar))::varchar, 'null')"
        old = f"coalesce(to_json(cast(o_{v} as varchar))::varchar, 'null')"
        parts.append(
            f"case when n_{v} is distinct from o_{v} "
            f"then '\"{v}\":[' || {new} || ',' || {old} || ']' end"
        )
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def built(
    scenario: Scenario,
    mode: str = "full",
    missing: str = "keep",
    run_date: str = RUN_DATE,
    recent: str | None = None,
    history: str | None = None,
) -> str:
    """The history after a run."""
    key = ", ".join(scenario.key)
    day = f"date '{run_date}'"
    news = ", ".join(f"n_{v} as {v}" for v in scenario.values)
    olds = ", ".join(f"o_{v} as {v}" for v in scenario.values)
    columns = ", ".join(scenario.columns)
    kept = []
    if mode == "full":
        kept.append("'unchanged'")
        if missing == "keep":
            kept.append("'missing'")
    parts = [
        f"select {columns}, {META} from hist where not is_active",
        f"select {key}, {news}, true as is_active, {day} as valid_from, "
        "cast(null as date) as valid_to, cast(null as varchar) as changes "
        "from pairs where event in ('insert', 'update')",
        f"select {key}, {olds}, false, o_valid_from, {day}, {log(scenario)} "
        "from pairs where event = 'update'",
    ]
    if kept:
        parts.append(
            f"select {key}, {olds}, true, o_valid_from, o_valid_to, o_changes "
            f"from pairs where event in ({', '.join(kept)})"
        )
    if missing == "close":
        parts.append(
            f"select {key}, {olds}, false, o_valid_from, {day}, o_changes "
            "from pairs where event = 'missing'"
        )
    return pairs(scenario, recent, history) + "\n" + "\nunion all\n".join(parts)


def replayed(missing: str) -> str:
    """Two runs in a row."""
    return built(
        ORDERS,
        missing=missing,
        run_date=SECOND_DATE,
        recent=source(ORDERS.second, ORDERS),
        history=built(ORDERS, missing=missing),
    )


def cells(scenario: Scenario) -> str:
    """Changed cells, read from the pairs and not from the log."""
    key = ", ".join(scenario.key)
    parts = [
        f"select {key}, date '{RUN_DATE}' as valid_to, '{v}' as column_name, "
        f"cast(n_{v} as varchar) as new_value, cast(o_{v} as varchar) as old_value "
        f"from pairs where event = 'update' and n_{v} is distinct from o_{v}"
        for v in scenario.values
    ]
    return "\nunion all\n".join(parts)


def timeline(history: str, scenario: Scenario) -> str:
    key = ", ".join(scenario.key)
    window = f"over (partition by {key} order by valid_from, valid_to nulls last)"
    columns = ", ".join(scenario.columns)
    return f"""
select {columns}, {META}, cast(row_number() {window} as integer) as version_number,
       lag(valid_from) {window} as previous_from, lead(valid_from) {window} as next_from,
       cast(datediff('day', valid_from, valid_to) as integer) as days_valid
from ({history}) as h"""


def joined_as_of() -> str:
    """The events beside the version whose interval holds their day."""
    scenario = CUSTOMER_JANUARY
    first = built(
        scenario, missing="close", run_date=JANUARY_RUNS[0], recent=source(scenario.second, scenario)
    )
    history = built(scenario, missing="close", run_date=JANUARY_RUNS[1], history=first)
    values = ", ".join(f"h.{v}" for v in (*scenario.values, "valid_from", "valid_to"))
    return f"""
select e.event_id, e.ts, e.user_id as c_custkey, e.event_type, e.value, e.props, {values}
from events e left join ({history}) as h
  on h.c_custkey = e.user_id and h.valid_from <= cast(e.ts as date)
 and (h.valid_to is null or h.valid_to > cast(e.ts as date))"""


def violations(key: str) -> str:
    """Every pair of periods of a key is not compared: the latest end so far decides."""
    return f"""
with p as (
  select {key}, valid_from, valid_to, is_active, count(*) as row_count
  from ({PERIODS.format(table="events")}) as e where user_id is not null group by all),
flags as (
  select {key}, valid_from, valid_to, unnest([
           case when valid_from is null then 'no_start' end,
           case when valid_to < valid_from then 'reversed' end,
           case when is_active and valid_to is not null then 'active_with_end' end,
           case when not is_active and valid_to is null then 'closed_without_end' end]) as violation,
         cast(null as date) as until, row_count
  from p),
spans as (
  select {key}, valid_from, valid_to, coalesce(valid_to, date '9999-12-31') as stop,
         sum(row_count)::bigint as row_count
  from p where valid_from is not null and (valid_to is null or valid_to >= valid_from) group by all),
seen as (
  select *, greatest(max(stop) over (
    partition by {key} order by valid_from, valid_to nulls last
    rows between unbounded preceding and 1 preceding),
    case when row_count > 1 then stop end) as until
  from spans)
select * from flags where violation is not null
union all
select {key}, valid_from, valid_to, case when valid_from < until then 'overlap' else 'gap' end,
       nullif(until, date '9999-12-31'), row_count
from seen where valid_from <> until"""


def coalesced() -> str:
    """Islands of versions that follow each other and differ in no column but the one left out."""
    kept = [v for v in ORDERS.values if v != "o_orderpriority"]
    same = " and ".join(f"{v} is not distinct from lag({v}) over w" for v in kept)
    firsts = ", ".join(f"arg_min(coalesce({{'x': {v}}}), place).x as {v}" for v in kept)
    return f"""
with h as (
  select * replace (case when changes is not null then
           nullif(json_merge_patch(changes::json, '{{"o_orderpriority":null}}')::varchar, '{{}}') end as changes),
         (valid_from, coalesce(valid_to, date '9999-12-31')) as place
  from ({replayed("close")}) as r),
marked as (
  select *, case when lag(valid_to) over w = valid_from and {same} then 0 else 1 end as starts
  from h window w as (partition by o_orderkey order by valid_from, valid_to nulls last)),
islands as (
  select *, sum(starts) over (partition by o_orderkey order by valid_from, valid_to nulls last) as island
  from marked)
select o_orderkey, {firsts}, arg_max({{'x': is_active}}, place).x as is_active,
       min(valid_from) as valid_from, arg_max({{'x': valid_to}}, place).x as valid_to,
       arg_max({{'x': changes}}, place).x as changes
from islands group by o_orderkey, island"""


def moves() -> str:
    """CTEs that end with ``moved``: rows of equal values, numbered by key on either side."""
    scenario = CUSTOMER_RENUMBERED
    values = scenario.values
    sides = [
        f"{name} as (select c_custkey, {', '.join(f'{mark}_{v} as {v}' for v in values)}, "
        f"row_number() over (partition by {', '.join(f'{mark}_{v}' for v in values)} order by c_custkey) as place "
        f"from pairs where event = '{event}')"
        for name, mark, event in (("came", "n", "insert"), ("went", "o", "missing"))
    ]
    same = " and ".join(f"came.{v} is not distinct from went.{v}" for v in values)
    return f"""{pairs(scenario)},
{', '.join(sides)},
moved as (select came.c_custkey, went.c_custkey as previous_c_custkey
          from came join went on came.place = went.place and {same})"""


def built_from_active(scenario: Scenario) -> str:
    """The history after a run on the active rows alone: every edit of it is in its log."""
    history = f"select * from ({source(scenario.history, scenario)}) as h where is_active"
    return built(scenario, missing="close", history=history)


def oracle_sql() -> dict[str, str]:
    columns = ", ".join(ORDERS.columns)
    news = ", ".join(f"n_{v} as {v}" for v in ORDERS.values)
    olds = ", ".join(f"o_{v} as {v}" for v in ORDERS.values)
    base = pairs(ORDERS)
    history = source(ORDERS.history, ORDERS)
    day = f"date '{RUN_DATE}'"
    opened = f"true as is_active, {day} as valid_from, cast(null as date) as valid_to"
    closed = f"false as is_active, o_valid_from as valid_from, {day} as valid_to"
    everything = built(ORDERS)

    result = {
        # sources and sinks: the table comes back as it went out
        "read_parquet": "select * from orders",
        "read_csv": "select * from customer",
        "read_json": "select * from events",
        "read_csv_documents": "select * from documents",
        "read_csv_pages": "select * from pages",
        "read_csv_inferred": "select * from part",
        "read_json_inferred": "select * from customer",
        "ingest_roundtrip": "select * from part",
        "write_parquet_partitioned": "select * from supplier",
        # row operators
        "active_rows": f"select * from ({history}) as h where is_active",
        "closed_rows": f"select * from ({history}) as h where not is_active",
        "open_rows": f"select orders.*, {opened} from orders",
        "close_rows": f"select * replace (false as is_active, {day} as valid_to) "
        f"from ({history}) as h where is_active",
        "ensure_history": f"select orders.*, {opened}, cast(null as varchar) as changes from orders",
        "value_columns": f"select {', '.join(ORDERS.values)} from ({history}) as h",
        "rows_with_keys": f"""
select * from ({history}) as h
where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""",
        "fingerprint": base + " select count(*) as differing_rows from pairs where event = 'update'",
        "union_all": base
        + f" select {columns}, {META} from hist where not is_active union all "
        f"select o_orderkey, {news}, {opened}, null from pairs where event = 'insert'",
        "union_all_sorted": base
        + f" select {columns}, {META} from hist where not is_active union all "
        f"select o_orderkey, {news}, {opened}, null from pairs where event = 'insert' "
        "order by o_orderkey",
        # diff operators
        "new_keys": base + " select o_orderkey from pairs where event = 'insert'",
        "new_rows": base
        + f" select o_orderkey, {news}, {opened} from pairs where event = 'insert'",
        "edited_keys": base + " select o_orderkey from pairs where event = 'update'",
        "edited_rows": base
        + f" select o_orderkey, {news}, {opened} from pairs where event = 'update'",
        "closed_edited_rows": base
        + f" select o_orderkey, {olds}, {closed} from pairs where event = 'update'",
        "closed_edited_rows_log": base
        + f" select o_orderkey, {olds}, {closed}, {log(ORDERS)} as changes "
        "from pairs where event = 'update'",
        "change_log": base
        + f" select o_orderkey, {log(ORDERS)} as changes from pairs where event = 'update'",
        "change_summary": base
        + " select event, count(*) as key_count from pairs group by event",
        # the history build
        "build_history_full": everything,
        "run_rows": f"""
select * from ({everything}) as h
where is_active or valid_to = date '{RUN_DATE}'""",
        "build_history_delta": built(ORDERS, mode="delta"),
        "build_history_missing_close": built(ORDERS, missing="close"),
        "build_history_missing_drop": built(ORDERS, missing="drop"),
        "build_history_bucketed": everything,
        "build_history_keep_first": built(
            LINEITEM,
            recent=f"""
select {', '.join(LINEITEM.columns)} from (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber order by l_shipdate, {', '.join(LINEITEM.values)}
  ) as place from lineitem) as ranked
where place = 1""",
        ),
        "replay": replayed("close"),
        "replaced_parquet": "select * from supplier",
        "rejected_rows": """
select c_custkey, cast(null as integer) as c_nationkey, c_name,
       c_custkey || ',' || c_mktsegment || ',' || c_name as rejected
from customer where c_acctbal < 0""",
        "versions_without_priority": coalesced(),
        "rebuild_versions": built_from_active(ORDERS),
        "rebuild_versions_events": built_from_active(EVENTS),
        "rebuild_versions_embeddings": f"""
select * exclude (changes) from ({built_from_active(EMBEDDINGS)}) as h""",
        "moved_keys": moves() + " select * from moved",
        "classify_with_moves": moves()
        + """
select p.c_custkey, case when m.c_custkey is not null then 'moved' else event end as event,
       m.previous_c_custkey
from pairs p left join moved m on m.c_custkey = p.c_custkey
where event <> 'missing' or p.c_custkey not in (select previous_c_custkey from moved)""",
        "merged_summaries": f"""
select column_name, count(*) as edit_count, true as keys_near,
       case when column_name in ('o_custkey', 'o_totalprice') then true end as median_near
from (select unnest(json_keys(changes)) as column_name from ({replayed("close")}) as h
      where valid_to >= date '{RUN_DATE}' and changes is not null) as c
group by column_name""",
        "overlapping_runs": replayed("close"),
        "replay_changes": replayed("close"),
        "replay_late": replayed("close"),
        "replay_corrected": replayed("close"),
        "join_as_of": joined_as_of(),
        "history_violations": violations("user_id, event_type"),
        "history_violations_user": violations("user_id"),
        "stream_history": replayed("close"),
        "replay_events": built(EVENTS),
        "replay_bucketed": replayed("close"),
        "pieces_equal_delta": built(ORDERS, mode="delta"),
        "pieces_equal_delta_customer": built(CUSTOMER, mode="delta"),
        "fingerprint_embeddings": pairs(EMBEDDINGS)
        + " select count(*) as differing_rows from pairs where event = 'update'",
        "history_table_after_first_run": built(ORDERS, missing="close"),
        # reads
        "as_of": f"""
select {columns} from ({replayed("close")}) as h
where valid_from <= date '2024-06-15' and (valid_to is null or valid_to > date '2024-06-15')""",
        "as_of_history_table": f"""
select {columns} from ({replayed("close")}) as h
where valid_from <= date '2024-03-01' and (valid_to is null or valid_to > date '2024-03-01')""",
        "timeline": timeline(everything, ORDERS),
        "explode_changes": base
        + cells(ORDERS)
        + """
union all
select o_orderkey, valid_to, 'o_orderstatus', json_extract_string(changes, '$.o_orderstatus[0]'),
       json_extract_string(changes, '$.o_orderstatus[1]')
from hist where not is_active""",
        "column_change_counts": f"""
select column_name, count(*) as edit_count from (
  {base} {cells(ORDERS)}
  union all
  select o_orderkey, valid_to, 'o_orderstatus', '', '' from hist where not is_active
) as c group by column_name""",
        # key checks
        "key_violations": """
select l_orderkey, l_linenumber, 'duplicate_key' as violation, count(*) as row_count
from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
        "key_violations_null": """
select o_orderpriority, o_orderstatus, 'duplicate_key' as violation, count(*) as row_count
from orders where o_orderpriority <> '5-LOW'
group by o_orderpriority, o_orderstatus having count(*) > 1
union all
select null, o_orderstatus, 'null_key', count(*)
from orders where o_orderpriority = '5-LOW' group by o_orderstatus""",
    }
    for name, scenario in SCENARIOS.items():
        suffix = "" if name == "orders" else f"_{name}"
        key = ", ".join(scenario.key)
        result[f"classify{suffix}"] = pairs(scenario) + f" select {key}, event from pairs"
    for scenario in (CUSTOMER, PART, DOCUMENTS, PAGES, CONVERSATIONS, EVENTS):
        result[f"build_history_{scenario.table}"] = built(scenario)
    key = ", ".join(EMBEDDINGS.key)
    result["edited_rows_embeddings"] = pairs(EMBEDDINGS) + (
        f" select {key}, n_embedding as embedding, n_label as label, {opened} "
        "from pairs where event = 'update'"
    )
    return result
