"""DuckDB SQL for every registered query, written independently of the Spark
operators (window ``row_number`` for CDC, plain joins/filters elsewhere).

All money is summed as ``decimal(18,2)`` and cast to double at the end, as the
Spark side does; integer sums are cast back to bigint.
"""

from __future__ import annotations

from ..model import BUSINESS_UNITS


def bu(k: str) -> str:
    return f"concat('bu_0', cast({k} % 6 + 1 as varchar(2)))"


def bg(k: str) -> str:
    return (f"case cast(floor({k} / 6) as bigint) % 3 when 0 then 'bg_direct' "
            f"when 1 then 'bg_partner' else 'bg_online' end")


UNITS = ", ".join(f"'{u}'" for u in BUSINESS_UNITS)
UNIT_ROWS = " union all ".join(f"select '{u}' as unit" for u in BUSINESS_UNITS)
STATIC_TS = "timestamp '2024-01-01 00:00:00'"
SHARED_WITH = "'bu_02|bu_03|bu_06'"


def flag(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


FEEDS = {
    "deals": f"""
  select o_orderkey as deal_id, o_custkey as company_id, {bu('o_custkey')} as bu_id,
         {bg('o_custkey')} as business_group,
         case when o_orderpriority <> '4-NOT SPECIFIED' then cast(o_totalprice as decimal(18,2)) end as amount,
         case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then 'Closed Won'
              when o_orderstatus = 'F' then 'WON' when o_orderstatus = 'P' then 'proposal' end as stage,
         o_orderdate as updated_at, {flag('o_orderkey % 33 = 0')} as is_deleted
  from orders""",
    "companies": f"""
  select c_custkey as company_id, c_name as name, c_mktsegment as industry,
         c_acctbal as annual_revenue, {bu('c_custkey')} as bu_id, {bg('c_custkey')} as business_group,
         {flag('c_custkey % 33 = 0')} as is_deleted, {STATIC_TS} as updated_at
  from customer""",
    "contacts": f"""
  select event_id as contact_id, user_id as company_id, {bu('user_id')} as bu_id,
         event_type as lifecycle_stage, ts as updated_at, {flag('event_id % 33 = 0')} as is_deleted
  from events""",
    "vendors": f"""
  select s_suppkey as vendor_key, s_name as name, {flag('s_suppkey % 10 = 0')} as is_shared,
         case when s_suppkey % 10 = 0 then {SHARED_WITH} end as shared_with,
         case when s_suppkey % 10 = 0 then 'SHARED' else {bu('s_suppkey')} end as bu_id,
         {flag('s_suppkey % 10 = 7')} as is_deleted, {STATIC_TS} as updated_at
  from supplier""",
    "cost_centers": f"""
  select p_partkey as cc_key, p_name as name, {bg('p_partkey')} as business_group,
         {flag('p_partkey % 20 = 0')} as is_shared,
         case when p_partkey % 20 = 0 then {SHARED_WITH} end as shared_with,
         case when p_partkey % 20 = 0 then 'SHARED' else {bu('p_partkey')} end as bu_id,
         {flag('p_partkey % 10 = 7')} as is_deleted, {STATIC_TS} as updated_at
  from part""",
    "gl_invoices": f"""
  select l_orderkey * 10 + l_linenumber as invoice_id, {bu('l_partkey')} as bu_id,
         l_suppkey as vendor_key, l_partkey as cc_key,
         cast(l_extendedprice as decimal(18,2)) as amount, l_shipdate as updated_at,
         {flag("l_returnflag = 'R' and l_linestatus = 'F'")} as is_deleted
  from lineitem""",
}

COLUMNS = {
    "deals": "deal_id, company_id, bu_id, business_group, amount, stage, updated_at, is_deleted",
    "companies": "company_id, name, industry, annual_revenue, bu_id, business_group, is_deleted, updated_at",
    "contacts": "contact_id, company_id, bu_id, lifecycle_stage, updated_at, is_deleted",
    "vendors": "vendor_key, name, is_shared, shared_with, bu_id, is_deleted, updated_at",
    "cost_centers": "cc_key, name, business_group, is_shared, shared_with, bu_id, is_deleted, updated_at",
    "gl_invoices": "invoice_id, bu_id, vendor_key, cc_key, amount, updated_at, is_deleted",
}

ORDER = {
    "deals": ("bu_id, deal_id", "updated_at desc, is_deleted desc"),
    "companies": ("bu_id, company_id", "updated_at desc, is_deleted desc"),
    "contacts": ("bu_id, contact_id", "updated_at desc, is_deleted desc"),
    "vendors": ("vendor_key, bu_id", "updated_at desc, is_deleted desc, own desc"),
    "cost_centers": ("cc_key, bu_id", "updated_at desc, is_deleted desc, own desc"),
    "gl_invoices": ("bu_id, invoice_id",
                    "updated_at desc, is_deleted desc, cc_key desc, vendor_key desc, amount desc"),
}


def scoped(obj: str) -> str:
    """Feed restricted to the units, shared rows copied to each entitled unit."""
    if obj in ("vendors", "cost_centers"):
        cols = COLUMNS[obj].replace("bu_id", "u.unit as bu_id")
        return f"""
  select {cols}, case when f.bu_id = 'SHARED' then 0 else 1 end as own
  from ({FEEDS[obj]}) f join ({UNIT_ROWS}) u
    on f.bu_id = u.unit
    or (f.bu_id = 'SHARED' and strpos('|' || f.shared_with || '|', '|' || u.unit || '|') > 0)"""
    return f"select {COLUMNS[obj]} from ({FEEDS[obj]}) f where bu_id in ({UNITS})"


def silver(obj: str, keep_deleted: bool = False) -> str:
    part, order = ORDER[obj]
    live = "" if keep_deleted else " and is_deleted = 0"
    return f"""
  select {COLUMNS[obj]} from (
    select *, row_number() over (partition by {part} order by {order}) as rn
    from ({scoped(obj)}) s
  ) r where rn = 1{live}"""


def with_silver(*objs: str) -> str:
    return "with " + ",\n".join(f"silver_{o} as ({silver(o)})" for o in objs)


SALES_MART = """
  select bu_id, business_group, count(deal_id) as deal_count,
         sum(amount) as pipeline_value_usd,
         sum(case when lower(stage) in ('closed won', 'won') then amount else 0 end) as won_revenue_usd,
         cast(sum(amount) as double) / count(amount) as avg_deal_value_usd
  from silver_deals group by bu_id, business_group"""

FINANCE_MART = """
  select i.bu_id, c.business_group, count(i.invoice_id) as invoice_count,
         count(distinct i.vendor_key) as vendor_count, sum(i.amount) as total_spend_usd
  from silver_gl_invoices i
  left join silver_cost_centers c on i.cc_key = c.cc_key and i.bu_id = c.bu_id
  group by i.bu_id, c.business_group"""

CUSTOMER_MART = """
  select co.bu_id, co.business_group, count(co.company_id) as company_count,
         sum(coalesce(ct.contact_count, 0)) as contact_count,
         sum(coalesce(d.deal_count, 0)) as deal_count,
         sum(coalesce(d.revenue, 0)) as customer_revenue_usd
  from silver_companies co
  left join (select company_id, bu_id, count(distinct contact_id) as contact_count
             from silver_contacts group by company_id, bu_id) ct
    on co.company_id = ct.company_id and co.bu_id = ct.bu_id
  left join (select company_id, bu_id, count(distinct deal_id) as deal_count, sum(amount) as revenue
             from silver_deals group by company_id, bu_id) d
    on co.company_id = d.company_id and co.bu_id = d.bu_id
  group by co.bu_id, co.business_group"""

SALES_PERF = f"""
  select bu_id, cast(sum(deal_count) as bigint) as deal_count,
         sum(pipeline_value_usd) as pipeline_value_usd, sum(won_revenue_usd) as won_revenue_usd
  from ({SALES_MART}) m group by bu_id"""

FINANCE_PERF = f"""
  select bu_id, cast(sum(invoice_count) as bigint) as invoice_count,
         sum(total_spend_usd) as total_spend_usd
  from ({FINANCE_MART}) m group by bu_id"""

CUSTOMER_PERF = f"""
  select bu_id, cast(sum(company_count) as bigint) as company_count,
         cast(sum(contact_count) as bigint) as contact_count,
         sum(customer_revenue_usd) as customer_revenue_usd
  from ({CUSTOMER_MART}) m group by bu_id"""


def money(*cols: str, rest: str = "") -> str:
    return ", ".join([f"cast({c} as double) as {c}" for c in cols] + ([rest] if rest else []))


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sales_mart"] = (
        with_silver("deals")
        + f"\nselect bu_id, business_group, deal_count, avg_deal_value_usd, "
        + money("pipeline_value_usd", "won_revenue_usd") + f" from ({SALES_MART}) m")
    q["scd1_events"] = """
select user_id, event_id, ts, event_type, value, props, is_deleted from (
  select *, case when event_type = 'error' then 1 else 0 end as is_deleted,
         row_number() over (partition by user_id order by ts desc,
                            case when event_type = 'error' then 1 else 0 end desc) as rn
  from events) e
where rn = 1 and event_type <> 'error'"""
    q["finance_mart"] = (
        with_silver("gl_invoices", "cost_centers")
        + "\nselect bu_id, business_group, invoice_count, vendor_count, "
        + money("total_spend_usd") + f" from ({FINANCE_MART}) m")
    q["customer_mart"] = (
        with_silver("companies", "contacts", "deals")
        + "\nselect bu_id, business_group, company_count, "
        + "cast(contact_count as bigint) as contact_count, cast(deal_count as bigint) as deal_count, "
        + money("customer_revenue_usd") + f" from ({CUSTOMER_MART}) m")
    q["bu_sales_performance"] = (
        with_silver("deals") + "\nselect bu_id, deal_count, "
        + money("pipeline_value_usd", "won_revenue_usd") + f" from ({SALES_PERF}) p")
    q["bu_finance_performance"] = (
        with_silver("gl_invoices", "cost_centers") + "\nselect bu_id, invoice_count, "
        + money("total_spend_usd") + f" from ({FINANCE_PERF}) p")
    q["bu_customer_performance"] = (
        with_silver("companies", "contacts", "deals") + "\nselect bu_id, company_count, contact_count, "
        + money("customer_revenue_usd") + f" from ({CUSTOMER_PERF}) p")
    q["bu_ranking"] = (
        with_silver("deals", "gl_invoices", "cost_centers", "companies", "contacts") + f""",
sp as ({SALES_PERF}), fp as ({FINANCE_PERF}), cp as ({CUSTOMER_PERF})
select coalesce(s.bu_id, f.bu_id, c.bu_id) as bu_id,
       cast(s.won_revenue_usd as double) as won_revenue_usd, s.sales_rank,
       cast(f.total_spend_usd as double) as total_spend_usd, f.spend_rank,
       c.company_count, c.customer_rank
from (select bu_id, won_revenue_usd, rank() over (order by won_revenue_usd desc nulls last) as sales_rank from sp) s
full join (select bu_id, total_spend_usd, rank() over (order by total_spend_usd desc nulls last) as spend_rank from fp) f
  on s.bu_id = f.bu_id
full join (select bu_id, company_count, rank() over (order by company_count desc nulls last) as customer_rank from cp) c
  on coalesce(s.bu_id, f.bu_id) = c.bu_id""")
    return q


ORACLE_SQL = _sql()


def _sql_wave2() -> dict[str, str]:
    q: dict[str, str] = {}
    q["shared_vendor_scope"] = f"select {COLUMNS['vendors']} from ({silver('vendors')}) s"
    q["shared_cost_center_scope"] = f"select {COLUMNS['cost_centers']} from ({silver('cost_centers')}) s"
    q["scd1_invoices"] = (f"select invoice_id, bu_id, vendor_key, cc_key, cast(amount as double) as amount, "
                          f"updated_at, is_deleted from ({silver('gl_invoices')}) s")
    q["dq_key_unique"] = f"""
select invoice_id, count(*) as n_versions from ({FEEDS['gl_invoices']}) f
group by invoice_id having count(*) > 1"""
    q["dq_fail_gate"] = f"select {COLUMNS['cost_centers']} from ({scoped('cost_centers')}) s"
    deal_cols = COLUMNS["deals"].replace("amount", "cast(amount as double) as amount")
    q["bu_slice"] = f"select {deal_cols} from ({silver('deals')}) s where bu_id = 'bu_06'"
    q["point_lookup"] = f"select {deal_cols} from ({FEEDS['deals']}) f where deal_id = 42"
    q["page_read"] = (f"select {deal_cols} from ({FEEDS['deals']}) f "
                      f"order by deal_id limit 100 offset 200")
    q["incremental_extract"] = (f"select {COLUMNS['contacts']} from ({FEEDS['contacts']}) f "
                                f"where updated_at > timestamp '2024-01-15 00:00:00'")
    q["entitled_sales"] = with_silver("deals") + f""",
mart as ({SALES_MART}),
policy as (select * from (values ('corporate_executive', null, null), ('bu_03_executive', 'bu_03', null),
             ('partner_group_executive', null, 'bg_partner'),
             ('bu_02_online_executive', 'bu_02', 'bg_online'), ('bu_02_and_online_executive', 'bu_02', null),
             ('bu_02_and_online_executive', null, 'bg_online')) r(persona, bu_id, business_group)),
personas as (select distinct persona from policy)
select m.bu_id, m.business_group, m.deal_count, m.avg_deal_value_usd,
       cast(m.pipeline_value_usd as double) as pipeline_value_usd,
       cast(m.won_revenue_usd as double) as won_revenue_usd, p.persona
from mart m cross join personas p
where exists (select 1 from policy r where r.persona = p.persona
              and (r.bu_id is null or r.bu_id = m.bu_id)
              and (r.business_group is null or r.business_group = m.business_group))"""
    q["divest_enterprise"] = with_silver("deals") + f"""
select bu_id, cast(sum(deal_count) as bigint) as deal_count,
       cast(sum(pipeline_value_usd) as double) as pipeline_value_usd,
       cast(sum(won_revenue_usd) as double) as won_revenue_usd
from ({SALES_MART}) m where bu_id <> 'bu_06' group by bu_id"""
    return q


ORACLE_SQL.update(_sql_wave2())


def _sql_wave3() -> dict[str, str]:
    q: dict[str, str] = {}
    deal_cols = COLUMNS["deals"].replace("amount", "cast(amount as double) as amount")
    q["landing_split"] = f"""
select bu_id, count(*) as record_count, max(updated_at) as max_updated_at
from ({FEEDS['gl_invoices']}) f group by bu_id"""
    q["ingest_audit"] = f"""
with f as ({FEEDS['contacts']}),
r1 as (select count(*) as n, max(updated_at) as wm from f
       where updated_at <= timestamp '2024-01-15 00:00:00')
select 'crm' as source_system, 'contacts' as source_object, n as records_extracted,
       cast(null as timestamp) as watermark_before, wm as watermark_after, 'SUCCESS' as status
from r1
union all
select 'crm', 'contacts', count(*), (select wm from r1), max(updated_at), 'SUCCESS'
from f where updated_at > (select wm from r1)"""
    q["batch_id_stable"] = f"""
select 'gl_invoices' as source_object, count(*) as records,
       cast(sum(amount) as double) as total_amount, true as id_stable
from ({FEEDS['gl_invoices']}) f"""
    q["replay_idempotent"] = (f"select {COLUMNS['contacts']} from ({FEEDS['contacts']}) f "
                              f"where updated_at > timestamp '2024-01-15 00:00:00'")
    q["landing_roundtrip"] = f"select {deal_cols} from ({FEEDS['deals']}) f"
    q["dq_drop"] = (f"select {COLUMNS['contacts']} from ({FEEDS['contacts']}) f "
                    f"where lifecycle_stage <> 'error'")
    q["scd1_out_of_order"] = ORACLE_SQL["scd1_events"]
    q["divest_manifest"] = with_silver("deals", "gl_invoices", "cost_centers", "vendors") + f"""
select 'deals' as table_name, count(*) as row_count, cast(sum(amount) as double) as amount_total,
       true as id_verified from silver_deals where bu_id = 'bu_06'
union all
select 'gl_invoices', count(*), cast(sum(amount) as double), true
from silver_gl_invoices where bu_id = 'bu_06'
union all
select 'cost_centers', count(*), cast(null as double), true from silver_cost_centers where bu_id = 'bu_06'
union all
select 'vendors', count(*), cast(null as double), true from silver_vendors where bu_id = 'bu_06'
union all
select 'sales_mart', count(*), cast(sum(pipeline_value_usd) as double), true
from ({SALES_MART}) m where bu_id = 'bu_06'"""
    return q


ORACLE_SQL.update(_sql_wave3())
ORACLE_SQL["mart_refresh"] = ORACLE_SQL["sales_mart"]
ORACLE_SQL["streamed_customer_mart"] = ORACLE_SQL["customer_mart"]
ORACLE_SQL["streamed_finance_mart"] = ORACLE_SQL["finance_mart"]


FLAWED_DEALS = f"""
  select deal_id, company_id,
         case when deal_id % 41 = 0 then null when deal_id % 43 = 0 then 'bu_09' else bu_id end as bu_id,
         business_group, amount, stage, case when deal_id % 37 <> 0 then updated_at end as updated_at, is_deleted
  from ({FEEDS['deals']}) f"""


def _sql_wave4() -> dict[str, str]:
    q: dict[str, str] = {}
    flawed = FLAWED_DEALS
    silver_flawed = f"""
with silver_deals as (select * from (
    select *, row_number() over (partition by bu_id, deal_id order by updated_at desc, is_deleted desc) as rn
    from ({flawed}) s where bu_id in ({UNITS}) and updated_at is not null) r
  where rn = 1 and is_deleted = 0)"""
    report = (f"\nselect bu_id, business_group, deal_count, avg_deal_value_usd, "
              + money("pipeline_value_usd", "won_revenue_usd") + f" from ({SALES_MART}) m")
    q["gated_sales_mart"] = q["streamed_gated_sales_mart"] = silver_flawed + report
    q["gate_counts"] = f"""
select count(*) as seen,
       cast(sum(case when bu_id is null or bu_id not in ({UNITS}) then 1 else 0 end) as bigint) as unconfigured_unit,
       cast(sum(case when bu_id in ({UNITS}) and updated_at is null then 1 else 0 end) as bigint)
         as dropped_valid_updated_at
from ({flawed}) s"""
    q["moved_null_batches"] = f"""
select bu_id, count(*) as with_stage, count(*) as with_note, cast(2 as bigint) as batches
from ({FEEDS['deals']}) f group by bu_id"""
    q["mart_refresh"] = with_silver("deals") + f"""
select bu_id, business_group, deal_count,
       case when bu_id = 'bu_02' then 2 * avg_deal_value_usd else avg_deal_value_usd end as avg_deal_value_usd,
       cast(case when bu_id = 'bu_02' then 2 * pipeline_value_usd else pipeline_value_usd end as double)
         as pipeline_value_usd,
       cast(case when bu_id = 'bu_02' then 2 * won_revenue_usd else won_revenue_usd end as double) as won_revenue_usd
from ({SALES_MART}) m"""
    q["refresh_forgets"] = ORACLE_SQL["sales_mart"] + " where bu_id not in ('bu_03', 'bu_05')"
    q["isolated_rollup"] = ORACLE_SQL["bu_sales_performance"]
    later = "timestamp '2024-06-01 00:00:00'"
    cols = COLUMNS["cost_centers"]
    q["streamed_lost_entitlement"] = f"""
with s as ({silver('cost_centers')}), gone as (
  select cc_key from ({FEEDS['cost_centers']}) f where bu_id = 'SHARED')
select {cols.replace('shared_with', "case when is_shared = 1 then 'bu_02|bu_06' end as shared_with")
        .replace('updated_at', f'case when is_shared = 1 then {later} else updated_at end as updated_at')}
from s where not (bu_id = 'bu_03' and cc_key in (select cc_key from gone))"""
    q["landed_invoice_documents"] = f"""
select 'INV-' || cast(l_orderkey * 10 + l_linenumber as varchar) as invoice_id, {bu('l_partkey')} as bu_id,
       'V-' || cast(l_suppkey as varchar) as vendor_key, 'CC-' || cast(l_partkey as varchar) as cc_key,
       cast(cast(l_extendedprice as decimal(18,2)) as double) as amount,
       case l_suppkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'GBP' end as currency,
       cast(cast(l_quantity as decimal(18,2)) as double) as tax_amount,
       l_shipdate as invoice_date, l_shipdate as due_date,
       case when l_linestatus = 'F' then 'PAID' else 'OPEN' end as status,
       case when l_returnflag <> 'N' then 'NET' || cast(l_linenumber as varchar) end as payment_terms,
       {flag("l_returnflag = 'A'")} as is_deleted, l_shipdate as updated_at
from lineitem"""
    q["divest_check"] = with_silver("deals") + f"""
select count(*) as rows, count(*) filter (where bu_id = 'bu_06') as slice_rows, true as consistent from ({SALES_MART}) m"""
    parts = []
    for obj, keys, null in (("vendors", "vendor_key, bu_id", "name is null"),
                            ("cost_centers", "cc_key, bu_id", "name is null"),
                            ("gl_invoices", "invoice_id", "vendor_key % 17 = 0 or amount is null")):
        parts.append(f"""
select '{obj}' as source_object, cast(sum(n) as bigint) as records, cast(sum(bad) as bigint) as not_null_violations,
       count(*) filter (where n > 1) as key_violations
from (select {keys}, count(*) as n, sum(case when {null} then 1 else 0 end) as bad
      from ({FEEDS[obj]}) f group by {keys}) k""")
    q["source_rule_violations"] = " union all ".join(parts)
    return q


ORACLE_SQL.update(_sql_wave4())


def _sql_wave5() -> dict[str, str]:
    q: dict[str, str] = {}
    q["two_systems_one_feed"] = f"""
select s.source_system, bu_id, count(*) as records, cast(1 as bigint) as batches, max(updated_at) as max_updated_at
from ({FEEDS['contacts']}) f, (values ('crm'), ('erp')) s(source_system) group by s.source_system, bu_id"""
    q["landing_recovery"] = f"""
with f as ({FEEDS['contacts']}),
r1 as (select count(*) as n, max(updated_at) as wm from f where updated_at <= timestamp '2024-01-15 00:00:00')
select n as records, n as records_extracted, cast(null as timestamp) as watermark_before from r1
union all
select count(*), count(*), (select wm from r1) from f where updated_at > (select wm from r1)"""
    factor = "case when bu_id in ('bu_02', 'bu_05') then 2 else 1 end"
    q["changed_units_refresh"] = with_silver("deals") + f"""
select bu_id, business_group, deal_count, {factor} * avg_deal_value_usd as avg_deal_value_usd,
       cast({factor} * pipeline_value_usd as double) as pipeline_value_usd,
       cast({factor} * won_revenue_usd as double) as won_revenue_usd, bu_id in ('bu_02', 'bu_05') as republished
from ({SALES_MART}) m"""
    q["distinct_vendor_rollup"] = with_silver("gl_invoices", "cost_centers") + f""",
j as (select i.bu_id, c.business_group, i.vendor_key from silver_gl_invoices i
      left join silver_cost_centers c on i.cc_key = c.cc_key and i.bu_id = c.bu_id)
select 'group' as level, bu_id, business_group, count(distinct vendor_key) as vendor_count from j group by bu_id, business_group
union all select 'unit', bu_id, null, count(distinct vendor_key) from j group by bu_id
union all select 'enterprise', null, null, count(distinct vendor_key) from j"""
    unit = f"(bu_id is not null and bu_id in ({UNITS}))"
    counts = {"seen": "true", "unconfigured_unit": f"not {unit}",
              "dropped_valid_updated_at": f"{unit} and updated_at is null", "path_payload_mismatch": "bu_id is null"}
    q["quality_log"] = " union all ".join(f"""
select 'silver_deals' as flow, deal_id % 2 as batch, '{rule}' as rule, count(*) filter (where {cond}) as rows
from ({FLAWED_DEALS}) s group by deal_id % 2""" for rule, cond in counts.items())
    drift = "deal_id % 11 = 0"
    q["drifted_deals"] = f"""
select deal_id, company_id, bu_id, business_group, case when not {drift} then cast(amount as double) end as amount,
       stage, updated_at, is_deleted, case when {drift} then 'USD ' || cast(amount as varchar) end as rescued_amount,
       case when {drift} then deal_id % 3 end as rescued_kind
from ({silver('deals')}) s"""
    q["rescued_fields"] = f"""
select 'amount' as field, count(amount) as records, 'STRING' as type from ({silver('deals')}) s where {drift}
union all
select 'channel', count(*), 'OBJECT<kind: BIGINT, name: STRING>' from ({silver('deals')}) s where {drift}"""
    q["archived_landing"] = f"""
select contact_id % 3 as part, count(*) as records, contact_id % 3 < 2 as archived
from ({FEEDS['contacts']}) f group by contact_id % 3"""
    invoices = COLUMNS["gl_invoices"].replace("amount", "cast(amount as double) as amount")
    q["deep_page"] = f"""
select {invoices} from (
  select *, row_number() over (order by invoice_id, updated_at, cc_key, vendor_key, amount, is_deleted) as rn,
         count(*) over () as n from ({FEEDS['gl_invoices']}) f) r
where rn > n - 150 and rn <= n - 50"""
    q["clustered_slice"] = f"""
select {invoices} from ({silver('gl_invoices')}) s where bu_id = 'bu_06' and updated_at > timestamp '1997-06-01 00:00:00'"""
    q["ordered_extract"] = f"""
select count(*) as records, min(updated_at) as first_at, max(updated_at) as last_at, true as in_order
from ({FEEDS['contacts']}) f where updated_at > timestamp '2024-01-15 00:00:00'"""
    q["persona_sales"] = f"""
select * from ({ORACLE_SQL['entitled_sales']}) e
where persona in ('corporate_executive', 'partner_group_executive', 'bu_02_and_online_executive')"""
    q["package_tree"] = f"""
with deals as (select * from ({silver('deals')}) s where bu_id = 'bu_06'),
vendors as (select * from ({silver('vendors')}) s where bu_id = 'bu_06')
select 'partition' as level, 'deals' as table_name, 'business_group=' || business_group as part, count(*) as rows,
       business_group <> 'bg_online' as verified from deals group by business_group
union all select 'partition', 'vendors', '', count(*), true from vendors
union all select 'table', 'deals', null, count(*), false from deals
union all select 'table', 'vendors', null, count(*), true from vendors
union all select 'package', null, null, (select count(*) from deals) + count(*), false from vendors"""
    q["empty_first_batch"] = f"select *, cast(0 as bigint) as rows_before from ({ORACLE_SQL['gated_sales_mart']}) m"
    return q


ORACLE_SQL.update(_sql_wave5())
