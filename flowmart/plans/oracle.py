"""DuckDB oracle SQL for the correctness gate.

Every query is ``WITH <prefix> <query>``. The prefix re-derives staging from ``events``
(FIXTURES.md section 3), applies the row rules, and states each fact with natural keys
only: lookups that can only drop or default rows become ``NOT NULL`` filters and
``COALESCE`` defaults. This is a second, independent formulation of the mart, not a
transcription of the Spark plan.
"""

from __future__ import annotations

EPOCH = "cast(floor(epoch(ts)) as bigint)"

RAW = f"""
raw AS (
select concat('59.166.0.', cast(user_id % 10 as varchar)) as srcip,
 cast(case when event_id % 97 = 0 then null else 1024 + (event_id*7919) % 64512 end as int) as sport,
 concat('149.171.126.', cast(event_id % 10 as varchar)) as dstip,
 cast(case when event_id % 89 = 0 then null when (event_id*31 + user_id) % 100 < 35 and event_id % 11 = 0 then 31337 + event_id % 5 when event_id % 3 = 0 then 53 when event_id % 3 = 1 then 20 + (event_id*13) % 1500 else (event_id*104729) % 30000 end as int) as dsport,
 case event_id % 5 when 0 then 'tcp' when 1 then 'udp' when 2 then 'tcp' when 3 then 'icmp' else 'arp' end as proto,
 case event_id % 7 when 0 then 'CON' when 1 then 'INT' when 2 then 'ACC' when 3 then 'CLO' when 4 then 'FIN' when 5 then null else 'REQ' end as state,
 value as dur,
 cast(40 + (event_id*37) % 15000 as bigint) as sbytes,
 cast((event_id*53) % 20000 as bigint) as dbytes,
 cast(31 + (event_id % 3) * 32 as int) as sttl, cast((event_id % 2) * 29 as int) as dttl,
 cast(event_id % 4 as int) as sloss, cast(event_id % 6 as int) as dloss,
 case when event_id % 23 = 0 then null when event_type='view' then 'http' when event_type='click' then 'dns' when event_type='purchase' then 'smtp' when event_type='signup' then 'ftp' when user_id % 2 = 0 then 'ssh' else '-' end as service,
 cast((event_id*11) % 900000 as double) as sload, cast((event_id*7) % 700000 as double) as dload,
 cast(1 + event_id % 40 as int) as spkts, cast(event_id % 60 as int) as dpkts,
 1704067200 + cast((({EPOCH} - 1704067200) - ({EPOCH} - 1704067200) % 10) / 10 as bigint) + (event_id % 4) * 2678400 as stime,
 1704067200 + cast((({EPOCH} - 1704067200) - ({EPOCH} - 1704067200) % 10) / 10 as bigint) + (event_id % 4) * 2678400 + case when event_id % 499 = 0 then -1 else event_id % 30 end as ltime,
 cast(event_id % 12 as int) as ct_srv_src, cast(event_id % 9 as int) as ct_srv_dst, cast(event_id % 3 as int) as ct_state_ttl,
 case when (event_id*31 + user_id) % 100 < 35 and event_id % 101 <> 0 then case (event_id*17 + user_id) % 9 when 0 then 'Fuzzers' when 1 then 'Analysis' when 2 then 'Backdoors' when 3 then 'DoS' when 4 then 'Exploits' when 5 then 'Generic' when 6 then 'Reconnaissance' when 7 then 'Shellcode' else 'Worms' end end as attack_cat,
 cast(case when event_id % 997 = 0 then 2 when (event_id*31 + user_id) % 100 < 35 then 1 else 0 end as int) as label
from events)"""

STG = """
stg AS (
select * from raw where coalesce(sport between 0 and 65535, true) and coalesce(dsport between 0 and 65535, true)
 and coalesce(dur >= 0, true) and coalesce(sbytes >= 0 and dbytes >= 0, true) and coalesce(spkts >= 0 and dpkts >= 0, true)
 and coalesce(stime >= 0 and ltime >= 0 and ltime >= stime, true))"""

# Simple generation: inner lookups of time, both locations, protocol (proto, state) and
# attack (label) keep exactly the rows whose keys are all present.
G1 = """
g1 AS (
select stime as time_key, make_timestamp(stime * 1000000) as ts,
 srcip as src_ip, sport as src_port, dstip as dst_ip, dsport as dst_port,
 service as service_name, proto as protocol_name, state as protocol_state,
 attack_cat as category_name, (label = 1) as is_attack,
 dur as duration, sbytes as src_bytes, dbytes as dst_bytes,
 cast(spkts as bigint) as src_packets, cast(dpkts as bigint) as dst_packets,
 sbytes + dbytes as total_bytes, cast(spkts as bigint) + cast(dpkts as bigint) as total_packets
from stg
where sport is not null and dsport is not null and stime is not null and srcip is not null and dstip is not null
 and proto is not null and state is not null and label is not null),
g1s AS (select * from g1 where service_name is not null)"""

# Mart generation: every clean row with a start time; misses take the default member.
G2 = """
f AS (
select stime - stime % 3600 as time_id,
 coalesce(service, 'UNKNOWN') as service_name,
 coalesce(sport, 0) as source_port, coalesce(dsport, 0) as dest_port,
 coalesce(state, 'UNKNOWN') as state_name, coalesce(proto, 'UNKNOWN') as protocol_name,
 case when attack_cat is null or attack_cat = '' then 'NORMAL' else attack_cat end as category,
 not (attack_cat is null or attack_cat = '' or attack_cat = 'NORMAL') as is_attack,
 cast(dur as decimal(10,3)) as duration, sbytes as source_bytes, dbytes as dest_bytes,
 spkts as source_packets, dpkts as dest_packets,
 try_cast(sload as decimal(10,3)) as source_load, try_cast(dload as decimal(10,3)) as dest_load,
 sttl as source_ttl, dttl as dest_ttl, sloss as source_loss, dloss as dest_loss,
 ct_srv_src, ct_srv_dst, ct_state_ttl
from stg where stime is not null),
ft AS (
select *, make_timestamp(time_id * 1000000) as datetime, cast(hour(make_timestamp(time_id * 1000000)) as int) as hour,
 cast(day(make_timestamp(time_id * 1000000)) as int) as day, cast(month(make_timestamp(time_id * 1000000)) as int) as month,
 cast(year(make_timestamp(time_id * 1000000)) as int) as year,
 case when dayofweek(make_timestamp(time_id * 1000000)) in (0, 6) then 'WEEKEND' else 'WEEKDAY' end as day_type,
 (cast(hour(make_timestamp(time_id * 1000000)) as int) between 9 and 17 and dayofweek(make_timestamp(time_id * 1000000)) not in (0, 6)) as is_business_hour
from f),
dim_time AS (select distinct time_id, datetime, hour, day, month, year, day_type, is_business_hour from ft),
last_24h AS (select time_id from dim_time where datetime >= (select max(datetime) from dim_time) - interval 24 hours),
svc AS (
select distinct service as name,
 case when service in ('http','ftp','smtp') then 'WEB' when service = 'dns' then 'NAME_SERVICE' when service = 'ssh' then 'REMOTE_ACCESS' else 'OTHER' end as category,
 case when service in ('ssh','ftp') then 'HIGH' when service in ('http','smtp') then 'MEDIUM' else 'LOW' end as risk_level,
 'NETWORK' as service_type
from stg where service is not null and service <> 'UNKNOWN'
union all select 'UNKNOWN', 'UNKNOWN', 'LOW', 'UNKNOWN'),
att AS (
select distinct attack_cat as category, true as is_attack,
 case when attack_cat in ('Backdoors','Shellcode','Worms') then 5 when attack_cat in ('DoS','Exploits') then 4
      when attack_cat in ('Fuzzers','Generic') then 3 when attack_cat in ('Analysis','Reconnaissance') then 2 else 1 end as severity
from stg where attack_cat is not null and attack_cat <> '' and attack_cat <> 'NORMAL'
union all select 'NORMAL', false, 1),
prt AS (
select port_number, case when port_number < 1024 then 'SYSTEM' when port_number < 49152 then 'USER' else 'DYNAMIC' end as range_type,
 coalesce(min(service), 'UNKNOWN') as default_service
from (select sport as port_number, service from stg where sport is not null union all select dsport, service from stg where dsport is not null)
where port_number <> 0 group by port_number
union all select 0, 'UNKNOWN', 'UNKNOWN')"""

PREFIX = "WITH " + ",".join([RAW, STG, G1, G2])


def _fixed_sum(expr: str, scale: int) -> str:
    return f"sum(cast(cast({expr} as decimal(28,{scale})) * {10**scale} as decimal(38,0)))"


def xavg(expr: str, scale: int = 6) -> str:
    """Exact average rounded half away from zero (same formula as ``numeric.avg_parts``)."""
    s, n = _fixed_sum(expr, scale), f"count({expr})"
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE CAST(sign({s}) * (cast(2 * abs({s}) + {n} as hugeint) // cast(2 * {n} as hugeint)) AS DOUBLE) "
            f"/ {10**scale} END)")


def xavg_raw(expr: str, scale: int = 6) -> str:
    return f"(cast({_fixed_sum(expr, scale)} as double) / nullif(cast(count({expr}) as double), 0))"


def q(body: str) -> str:
    return PREFIX + "\n" + body


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = q(body.replace("{XAVG_DUR}", xavg("duration")))


#: The window of the windowed rollups, strictly inside the data.
WINDOW = (1704171600, 1709535600)

# ---- simple generation (A1 - D4q, R5 - R7) --------------------------------------------

oracle("a1_service_ranking", "select service_name, count(*) as total_connections from g1s group by service_name")

oracle("a2_attack_categories", """
select service_name, count(*) as attack_connections, count(distinct category_name) as attack_categories
from g1s where is_attack group by service_name""")

oracle("a3_attack_share", """
select service_name, total_connections,
 round(100.0::double * attack_connections / total_connections, 2) as attack_percentage,
 round(100.0::double * (total_connections - attack_connections) / total_connections, 2) as normal_percentage
from (select service_name, count(*) as total_connections, cast(sum(case when is_attack then 1 else 0 end) as bigint) as attack_connections
      from g1s group by service_name having count(*) > 1000)""")


def _three_grains(measure: str, where: str) -> str:
    parts = []
    for grain in ("hour", "day", "month"):
        cols = {
            "hour": "cast(hour(ts) as int) as hour, cast(null as int) as day, cast(null as int) as month",
            "day": "cast(null as int) as hour, cast(day(ts) as int) as day, cast(null as int) as month",
            "month": "cast(null as int) as hour, cast(null as int) as day, cast(month(ts) as int) as month",
        }[grain]
        gexpr = {"hour": "hour(ts)", "day": "day(ts)", "month": "month(ts)"}[grain]
        parts.append(
            f"select service_name, {cols}, count(*) as {measure}, '{grain}' as grouping_type "
            f"from g1s where {where} group by service_name, {gexpr}"
        )
    return "\nunion all\n".join(parts)


oracle("a4_attacks_by_time", _three_grains("total_attacks", "is_attack"))

oracle("b1_normal_totals", """
select service_name, cast(sum(src_bytes) as bigint) as total_src_bytes, cast(sum(dst_bytes) as bigint) as total_dst_bytes,
 cast(sum(src_packets) as bigint) as total_src_packets, cast(sum(dst_packets) as bigint) as total_dst_packets
from g1s where not is_attack group by service_name""")

oracle("b2_normal_duration", """
select service_name, {XAVG_DUR} as avg_duration from g1s where not is_attack group by service_name""")

oracle("b3_top_normal_ports", """
select * from (
 select service_name, dst_port, count(*) as connection_count,
  cast(rank() over (partition by service_name order by count(*) desc) as int) as rank
 from g1s where not is_attack group by service_name, dst_port) where rank <= 5""")

oracle("b4_normal_by_time", _three_grains("normal_connections", "not is_attack"))

oracle("c1_attack_bytes", """
select service_name, 'Attack' as traffic_type, cast(sum(src_bytes + dst_bytes) as bigint) as total_bytes
from g1s where is_attack group by service_name""")

oracle("c2_attack_duration", """
select service_name, 'Attack' as traffic_type, round(min(duration), 6) as min_duration,
 {XAVG_DUR} as avg_duration, round(max(duration), 6) as max_duration
from g1s where is_attack group by service_name""")

oracle("c3_top_attack_ports", """
select * from (
 select dst_port, count(*) as usage_count, cast(rank() over (order by count(*) desc) as int) as rank
 from g1 where is_attack group by dst_port) where rank <= 10""")

oracle("c4_attacks_by_time", _three_grains("attack_count", "is_attack"))

oracle("d1q_compare_literal", """
select service_name, time_unit,
 round(max(case when is_attack then avg_bytes end), 6) as malicious_avg_bytes,
 round(max(case when not is_attack then avg_bytes end), 6) as normal_avg_bytes,
 round(max(case when is_attack then avg_packets end), 6) as malicious_avg_packets,
 round(max(case when not is_attack then avg_packets end), 6) as normal_avg_packets
from (
 select service_name, is_attack, cast(hour(ts) as int) as time_unit, avg(src_bytes + dst_bytes) as avg_bytes, avg(src_packets + dst_packets) as avg_packets
 from g1s group by service_name, is_attack, hour(ts)
 union all
 select service_name, is_attack, cast(day(ts) as int), avg(src_bytes + dst_bytes), avg(src_packets + dst_packets)
 from g1s group by service_name, is_attack, day(ts)
 union all
 select service_name, is_attack, cast(month(ts) as int), avg(src_bytes + dst_bytes), avg(src_packets + dst_packets)
 from g1s group by service_name, is_attack, month(ts))
group by service_name, time_unit""")

oracle("d2q_duration_ratio", f"""
select service_name,
 {xavg("case when is_attack then duration end")} as avg_attack_duration,
 {xavg("case when not is_attack then duration end")} as avg_normal_duration,
 round({xavg_raw("case when is_attack then duration end")} / nullif({xavg_raw("case when not is_attack then duration end")}, 0), 6) as duration_ratio
from g1s group by service_name""")

oracle("d3q_attack_only_ports", """
select dst_port as port from g1 group by dst_port having count(*) > 1 and bool_and(is_attack)""")

oracle("d4q_top_attacked_services", """
select *, round(cast(attack_count as double) / total_connections * 100, 6) as attack_percentage from (
 select service_name, count(*) as total_connections, cast(sum(case when is_attack then 1 else 0 end) as bigint) as attack_count,
  {XAVG_DUR} as avg_duration,
  array_to_string(list_sort(list(distinct dst_port)), ',') as common_ports,
  count(distinct hour(ts)) as active_hours, count(distinct day(ts)) as active_days, count(distinct month(ts)) as active_months
 from g1s group by service_name)
order by attack_count desc, service_name limit 5""")

oracle("r5_hourly_service_stats", """
select service_name, cast(hour(ts) as int) as hour, is_attack, count(*) as connection_count,
 cast(sum(src_bytes + dst_bytes) as bigint) as total_bytes, {XAVG_DUR} as avg_duration
from g1s group by service_name, hour(ts), is_attack""")

for _name, _key, _expr in (("r6_daily_traffic", "day_key", "day(ts)"), ("r7_weekly_traffic", "week_key", "weekofyear(ts)")):
    oracle(_name, f"""
select cast({_expr} as int) as {_key}, service_name, protocol_name, protocol_state, category_name, is_attack,
 count(*) as total_connections, cast(sum(total_bytes) as bigint) as total_bytes, cast(sum(total_packets) as bigint) as total_packets,
 {xavg("duration")} as avg_duration,
 round(cast(sum(case when is_attack then 1 else 0 end) as double) / count(*), 6) as attack_rate
from g1 group by {_expr}, service_name, protocol_name, protocol_state, category_name, is_attack""")


# ---- mart generation -------------------------------------------------------------------

def _cnt(cond: str) -> str:
    return f"count(case when {cond} then 1 end)"


def _pct(part: str, whole: str) -> str:
    return f"round(100.0::double * ({part}) / nullif(({whole}), 0), 2)"


BYTES = "(source_bytes + dest_bytes)"
PACKETS = "(cast(source_packets as bigint) + dest_packets)"

# Rollups as CTEs (only evaluated when a query references them).
ROLLUPS = f"""
r1 AS (
select time_id, service_name, protocol_name, category as attack_category, hour,
 count(*) as total_connections, {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
 coalesce({xavg('duration', 3)}, 0) as avg_duration,
 coalesce({xavg('case when not is_attack then duration end', 3)}, 0) as avg_duration_normal,
 coalesce({xavg('case when is_attack then duration end', 3)}, 0) as avg_duration_attack,
 coalesce(cast(sum(case when not is_attack then {BYTES} end) as bigint), 0) as total_bytes_normal,
 coalesce(cast(sum(case when is_attack then {BYTES} end) as bigint), 0) as total_bytes_attack,
 coalesce(cast(sum(case when not is_attack then {PACKETS} end) as bigint), 0) as total_packets_normal,
 coalesce(cast(sum(case when is_attack then {PACKETS} end) as bigint), 0) as total_packets_attack,
 coalesce({xavg(f'case when not is_attack then {BYTES} end', 3)}, 0) as avg_bytes_per_conn,
 coalesce({xavg(f'case when is_attack then {BYTES} end', 3)}, 0) as avg_bytes_per_attack,
 coalesce({xavg('case when not is_attack then source_load end', 3)}, 0) as avg_load_normal,
 coalesce({xavg('case when is_attack then source_load end', 3)}, 0) as avg_load_attack,
 count(distinct service_name) as distinct_services,
 count(distinct source_port) + count(distinct dest_port) as distinct_ports,
 max(count(*)) over (partition by service_name, hour) as peak_hour_connections
from ft group by time_id, service_name, protocol_name, category, hour),
ftp AS (select *, time_id - time_id % 86400 as day_start, cast(epoch(date_trunc('month', datetime)) as bigint) as month_start from ft),
day_first AS (select time_id - time_id % 86400 as day_start, min(time_id) as first_id from dim_time group by 1),
month_first AS (select cast(epoch(date_trunc('month', datetime)) as bigint) as month_start, min(time_id) as first_id from dim_time group by 1),
r2 AS (
select first_id as time_id, s.* exclude (day_start) from (
 select day_start, service_name, protocol_name, category as attack_category, hour as peak_hour,
  count(*) as total_connections, {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
  {xavg('duration', 3)} as avg_duration, cast(sum({BYTES}) as bigint) as total_bytes, cast(sum({PACKETS}) as bigint) as total_packets,
  count(distinct case when is_attack then category end) as distinct_attack_types,
  {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage,
  max(count(*)) over (partition by service_name, hour) as peak_hour_connections
 from ftp group by day_start, service_name, protocol_name, category, hour) s join day_first using (day_start)),
r3 AS (
select first_id as time_id, s.* exclude (month_start) from (
 select month_start, service_name, protocol_name, category as attack_category, day as peak_day,
  count(*) as total_connections, {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
  {xavg('duration', 3)} as avg_duration, cast(sum({BYTES}) as bigint) as total_bytes, cast(sum({PACKETS}) as bigint) as total_packets,
  count(distinct case when is_attack then category end) as distinct_attack_types,
  {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage,
  max(count(*)) over (partition by service_name, day) as peak_day_connections
 from ftp group by month_start, service_name, protocol_name, category, day) s join month_first using (month_start)),
ss_grain AS (
select service_name, time_id, protocol_name, category as attack_category,
 count(*) as total_connections, {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
 coalesce(cast(sum(case when not is_attack then {BYTES} end) as bigint), 0) as total_bytes_normal,
 coalesce(cast(sum(case when is_attack then {BYTES} end) as bigint), 0) as total_bytes_attack,
 coalesce(cast(sum(case when not is_attack then {PACKETS} end) as bigint), 0) as total_packets_normal,
 coalesce(cast(sum(case when is_attack then {PACKETS} end) as bigint), 0) as total_packets_attack,
 {xavg(BYTES, 3)} as avg_bytes_per_conn, {xavg(f'case when is_attack then {BYTES} end', 3)} as avg_bytes_per_attack,
 {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage
from ft group by service_name, time_id, protocol_name, category),
ss_service AS (
select service_name,
 {xavg('case when not is_attack then duration end', 3)} as avg_duration_normal,
 {xavg('case when is_attack then duration end', 3)} as avg_duration_attack,
 round({xavg_raw('case when is_attack then duration end', 3)} / nullif({xavg_raw('case when not is_attack then duration end', 3)}, 0), 3) as duration_ratio,
 round({xavg_raw(f'case when is_attack then {BYTES} end', 3)} / nullif({xavg_raw(f'case when not is_attack then {BYTES} end', 3)}, 0), 3) as bytes_ratio,
 round({xavg_raw(f'case when is_attack then {PACKETS} end', 3)} / nullif({xavg_raw(f'case when not is_attack then {PACKETS} end', 3)}, 0), 3) as packets_ratio,
 count(distinct case when is_attack then category end) as distinct_attack_types
from ft group by service_name),
ss_peak AS (
select service_name,
 max(case when not is_attack and rn = 1 then hour end) as peak_hour_normal,
 max(case when is_attack and rn = 1 then hour end) as peak_hour_attack
from (select service_name, is_attack, hour, row_number() over (partition by service_name, is_attack order by count(*) desc, hour) as rn
      from ft group by service_name, is_attack, hour) group by service_name),
ss_excl AS (
select service_name, count(case when only_attacks then 1 end) as exclusive_attack_ports
from (select service_name, dest_port, bool_and(is_attack) as only_attacks from ft group by service_name, dest_port) group by service_name),
ss AS (
select g.*, s.* exclude (service_name), p.* exclude (service_name), e.* exclude (service_name)
from ss_grain g left join ss_service s using (service_name) left join ss_peak p using (service_name) left join ss_excl e using (service_name)),
pu_port AS (
select dest_port, {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage, bool_and(is_attack) as exclusive_to_attacks,
 min(datetime) as first_seen, max(datetime) as last_seen, count(distinct service_name) as distinct_services
from ft group by dest_port),
pu_primary AS (
select dest_port, category as primary_attack_type from (
 select dest_port, category, row_number() over (partition by dest_port order by count(*) desc, category) as rn
 from ft where is_attack group by dest_port, category) where rn = 1),
pu AS (
select g.dest_port as port_number, g.service_name, g.protocol_name, g.attack_category, g.time_id,
 g.total_usage, g.normal_usage, g.attack_usage, {_pct('g.total_usage', 'h.hour_total')} as usage_percentage,
 p.attack_percentage, p.exclusive_to_attacks, p.first_seen, p.last_seen, p.distinct_services, pr.primary_attack_type
from (select dest_port, service_name, protocol_name, category as attack_category, time_id,
       count(*) as total_usage, {_cnt('not is_attack')} as normal_usage, {_cnt('is_attack')} as attack_usage
      from ft group by dest_port, service_name, protocol_name, category, time_id) g
join (select time_id, count(*) as hour_total from ft group by time_id) h using (time_id)
join pu_port p using (dest_port) left join pu_primary pr using (dest_port))"""

PREFIX = PREFIX + "," + ROLLUPS


def ts_fmt(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


oracle("r1_hourly_traffic", "select * exclude (hour) from r1")
oracle("r2_daily_traffic_literal", "select * from r2")
oracle("r3_monthly_traffic_literal", "select * from r3")

for _name, _period, _sub, _peak, _first in (
    ("r2i_daily_traffic", "day_start", "hour", "peak_hour", "day_first"),
    ("r3i_monthly_traffic", "month_start", "day", "peak_day", "month_first"),
):
    oracle(_name, f"""
select fi.first_id as time_id, t.service_name, t.protocol_name, t.attack_category,
 t.total_connections, t.normal_connections, t.attack_connections, t.avg_duration, t.total_bytes, t.total_packets,
 p.{_sub} as {_peak}, p.n as {_peak}_connections, t.distinct_attack_types, t.attack_percentage
from (select {_period}, service_name, protocol_name, category as attack_category,
       count(*) as total_connections, {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
       {xavg('duration', 3)} as avg_duration, cast(sum({BYTES}) as bigint) as total_bytes, cast(sum({PACKETS}) as bigint) as total_packets,
       count(distinct case when is_attack then category end) as distinct_attack_types,
       {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage
      from ftp group by {_period}, service_name, protocol_name, category) t
join (select * from (select {_period}, service_name, protocol_name, category as attack_category, {_sub}, count(*) as n,
        row_number() over (partition by {_period}, service_name, protocol_name, category order by count(*) desc, {_sub}) as rn
      from ftp group by {_period}, service_name, protocol_name, category, {_sub}) where rn = 1) p
 using ({_period}, service_name, protocol_name, attack_category)
join {_first} fi using ({_period})""")

oracle("f6_service_stats", "select * from ss")
oracle("f7_port_usage", f"select * replace ({ts_fmt('first_seen')} as first_seen, {ts_fmt('last_seen')} as last_seen) from pu")

oracle("r8_hourly_service_performance", f"""
select r1.service_name, s.service_type, s.risk_level, r1.hour, t.is_business_hour,
 cast(sum(total_connections) as bigint) as total_connections, cast(sum(attack_connections) as bigint) as attack_connections,
 {_pct('sum(attack_connections)', 'sum(total_connections)')} as avg_attack_percentage,
 cast(sum(total_bytes_normal + total_bytes_attack) as bigint) as total_bytes, {xavg('avg_duration')} as avg_duration
from r1 join svc s on s.name = r1.service_name join dim_time t using (time_id)
group by r1.service_name, s.service_type, s.risk_level, r1.hour, t.is_business_hour""")

oracle("r9_daily_attack_patterns", f"""
select service_name, attack_category, t.day_type, peak_hour, cast(sum(attack_connections) as bigint) as total_attacks,
 {xavg('attack_percentage')} as avg_attack_percentage, count(distinct distinct_attack_types) as attack_varieties
from r2 join dim_time t using (time_id) group by service_name, attack_category, t.day_type, peak_hour""")

R10 = f"""
select ss.service_name, s.service_type, s.risk_level, count(distinct ss.distinct_attack_types) as total_attack_types,
 {xavg('ss.attack_percentage')} as avg_attack_percentage, max(ss.peak_hour_attack) as common_attack_hour,
 cast(sum(ss.exclusive_attack_ports) as bigint) as exclusive_attack_ports,
 {xavg('ss.duration_ratio')} as avg_duration_ratio, {xavg('ss.bytes_ratio')} as avg_bytes_ratio
from ss join svc s on s.name = ss.service_name group by ss.service_name, s.service_type, s.risk_level"""
oracle("r10_service_risk_profile", R10)

R11 = f"""
select pu.port_number, p.range_type, pu.service_name, count(distinct pu.primary_attack_type) as attack_types,
 cast(sum(case when pu.exclusive_to_attacks then 1 else 0 end) as bigint) as exclusive_attack_count,
 {xavg('pu.attack_percentage')} as avg_attack_percentage, {ts_fmt('max(pu.last_seen)')} as last_attack_seen
from pu join prt p using (port_number) group by pu.port_number, p.range_type, pu.service_name"""
oracle("r11_port_security_analysis", R11)

oracle("r4_aggregate_facts", """
select 'HOURLY' as aggregation_level, 'COMPLETED' as status, count(*) as records_processed from r1
union all select 'DAILY', 'COMPLETED', count(*) from r2
union all select 'MONTHLY', 'COMPLETED', count(*) from r3""")

# The rollups of a window: the same statements over the facts of the window.
for _level, _table in (("r1_hourly_window", "select * exclude (hour) from r1"), ("r2_daily_window", "select * from r2"), ("r3_monthly_window", "select * from r3")):
    oracle(_level, _table)
    _inside = f"where time_id between {WINDOW[0]} and {WINDOW[1]}"
    for _group in ("from ft group by time_id, service_name, protocol_name, category, hour)", "as month_start from ft),"):
        assert _group in ORACLE[_level]
        ORACLE[_level] = ORACLE[_level].replace(_group, _group.replace("from ft", f"from ft {_inside}"))

oracle("h0_last_24h", "select time_id from last_24h")

oracle("qa1_service_ranking", f"""
select service_name, count(*) as total_connections, cast(sum(case when is_attack then 1 else 0 end) as bigint) as attack_connections,
 {_pct('sum(case when is_attack then 1 else 0 end)', 'count(*)')} as attack_percentage,
 {xavg('duration')} as avg_duration, cast(sum({BYTES}) as bigint) as total_bytes
from ft group by service_name""")

oracle("qa2_attack_stats", f"""
select service_name, category as attack_type, count(*) as attack_count, {xavg('duration')} as avg_duration,
 cast(sum({BYTES}) as bigint) as total_bytes
from ft where is_attack group by service_name, category""")

oracle("qa3_last_24h_volume", """
select service_name, day_type, hour, count(*) as connections, cast(sum(case when is_attack then 1 else 0 end) as bigint) as attacks
from ft where time_id in (select time_id from last_24h) group by service_name, day_type, hour""")

oracle("qb1_last_24h_normal", """
select service_name, hour, total_connections, normal_connections,
 cast(round(cast(avg_duration_normal as decimal(10,3)), 2) as double) as avg_duration,
 total_bytes_normal, total_packets_normal, avg_load_normal
from r1 where time_id in (select time_id from last_24h)""")

oracle("qb2_port_usage_attacked", """
select pu.port_number, p.range_type, total_usage, normal_usage, attack_usage, pu.attack_percentage, exclusive_to_attacks
from pu join prt p using (port_number) where pu.attack_percentage > 0""")

oracle("qb3_last_24h_by_hour", f"""
select r1.hour, t.is_business_hour, cast(sum(total_connections) as bigint) as total_connections,
 cast(sum(attack_connections) as bigint) as attack_connections,
 {_pct('sum(attack_connections)', 'sum(total_connections)')} as attack_percentage
from r1 join dim_time t using (time_id) where time_id in (select time_id from last_24h) group by r1.hour, t.is_business_hour""")

oracle("qc1_attack_type_distribution", f"""
select category as attack_type, a.severity, count(*) as occurrences, count(distinct service_name) as affected_services,
 {xavg('duration')} as avg_duration
from ft join att a using (category) where ft.is_attack group by category, a.severity""")

oracle("qc2_last_24h_attacks", f"""
select hour, category as attack_type, count(*) as attack_count, {xavg('duration')} as avg_duration,
 cast(sum({BYTES}) as bigint) as total_bytes
from ft where is_attack and time_id in (select time_id from last_24h) group by hour, category""")

oracle("qc3_service_protocol_attack", f"""
select service_name, protocol_name as protocol, category as attack_type, count(*) as occurrences, {xavg('duration')} as avg_duration
from ft where is_attack group by service_name, protocol_name, category""")

oracle("qd1_latest_comparison", """
select service_name, total_connections, normal_connections, attack_connections, round(attack_percentage, 2) as attack_percentage,
 cast(round(cast(avg_duration_normal as decimal(10,3)), 2) as double) as avg_duration_normal,
 cast(round(cast(avg_duration_attack as decimal(10,3)), 2) as double) as avg_duration_attack,
 total_bytes_normal, total_bytes_attack
from ss where time_id = (select max(time_id) from dim_time)""")

oracle("qd2_service_risk_report", f"""
select r.service_name, s.risk_level, r.total_attack_types, r.avg_attack_percentage, r.common_attack_hour, r.exclusive_attack_ports
from ({R10}) r join svc s on s.name = r.service_name""")

oracle("qd3_port_usage_report", f"""
select port_number, range_type, service_name, attack_types, exclusive_attack_count, avg_attack_percentage, last_attack_seen
from ({R11}) where avg_attack_percentage > 0""")

oracle("qd4_security_summary", f"""
select count(distinct f.service_name) as total_services,
 count(distinct case when f.is_attack then f.category end) as total_attack_types,
 {_pct("count(case when f.is_attack then 1 end)", "count(*)")} as overall_attack_percentage,
 count(distinct case when pu.exclusive_to_attacks then pu.port_number end) as exclusive_attack_ports
from ft f left join pu on f.service_name = pu.service_name and f.time_id = pu.time_id""")

oracle("qd4_security_summary_fixed", f"""
select count(distinct service_name) as total_services, count(distinct case when is_attack then category end) as total_attack_types,
 {_pct("count(case when is_attack then 1 end)", "count(*)")} as overall_attack_percentage,
 (select count(distinct case when exclusive_to_attacks then port_number end) from pu) as exclusive_attack_ports
from ft""")

oracle("qm1_top5_attack_share", f"""
select service_name, count(*) as total_connections, {_cnt('is_attack')} as attack_count,
 {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage
from ft group by service_name order by attack_percentage desc, service_name limit 5""")

oracle("qm2_attacks_by_hour", f"""
select hour, total_attacks, {_pct('total_attacks', 'sum(total_attacks) over ()')} as percentage_of_total
from (select hour, count(*) as total_attacks from ft where is_attack group by hour)""")

oracle("qm3_attack_categories", f"""
select category, occurrences, {_pct('occurrences', 'sum(occurrences) over ()')} as percentage_of_total
from (select category, count(*) as occurrences from ft where is_attack group by category)""")

oracle("qm4_mart_summary", """
select (select count(*) from svc) as active_services, (select count(*) from att) as attack_categories,
 (select count(*) from ft) as connection_facts, (select count(*) from r1) as hourly_aggregations,
 (select count(*) from r2) as daily_aggregations, (select count(*) from r3) as monthly_aggregations,
 (select count(*) from pu) as port_usage_records""")

# ---- dimensions and facts ---------------------------------------------------------------

HOUR_COLS = f"""cast(epoch(ts) as bigint) as time_id, {ts_fmt('ts')} as datetime, cast(hour(ts) as int) as hour,
 cast(day(ts) as int) as day, cast(month(ts) as int) as month, cast(year(ts) as int) as year,
 case when dayofweek(ts) in (0, 6) then 'WEEKEND' else 'WEEKDAY' end as day_type,
 rpad(dayname(ts), 9, ' ') as day_name, rpad(monthname(ts), 9, ' ') as month_name,
 (hour(ts) between 9 and 17 and dayofweek(ts) not in (0, 6)) as is_business_hour,
 hour(ts) in (9, 10, 11, 14, 15, 16) as is_peak_hour, cast(weekofyear(ts) as int) as week_of_year,
 cast(quarter(ts) as int) as quarter"""

oracle("d1_calendar", f"""
select {HOUR_COLS} from (select unnest(generate_series((select min(datetime) from dim_time),
 (select max(datetime) from dim_time), interval 1 hour)) as ts)""")

oracle("d2_dim_time", f"select {HOUR_COLS} from (select datetime as ts from dim_time)")

oracle("d3_dim_service", """
select cast(row_number() over (order by name) as int) as service_id, name, protocol, service_type, category, risk_level,
 true as is_active, 1 as version
from (select s.*, (select min(proto) from stg where stg.service = s.name) as protocol from svc s where name <> 'UNKNOWN')
union all select 0, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'LOW', true, 1""")

oracle("d4_dim_protocol", """
select cast(row_number() over (order by proto) as int) as protocol_id, proto as name,
 case when proto in ('tcp','udp') then 'TRANSPORT' when proto = 'icmp' then 'INTERNET' else 'OTHER' end as type, true as is_active
from (select distinct proto from stg where proto is not null and proto <> 'UNKNOWN')
union all select 0, 'UNKNOWN', 'UNKNOWN', true""")

oracle("d5_dim_state", """
select cast(row_number() over (order by state) as int) as state_id, state as name,
 case when state in ('CON','INT') then 'CONNECTION' when state in ('ACC','CLO') then 'ACCESS' else 'OTHER' end as category, true as is_active
from (select distinct state from stg where state is not null and state <> 'UNKNOWN')
union all select 0, 'UNKNOWN', 'UNKNOWN', true""")

oracle("d6_dim_port", """
select case when port_number = 0 then 0 else cast(row_number() over (order by port_number) - 1 as int) end as port_id,
 port_number, range_type, default_service, true as is_active, 1 as version from prt""")

oracle("d7_dim_attack", """
select case when category = 'NORMAL' then 0 else cast(row_number() over (order by category = 'NORMAL', category) as int) end as attack_id,
 category, is_attack, severity, true as is_active from att""")

oracle("d9_dimension_counts", """
select 'DIM_TIME' as dimension, count(*) as record_count from dim_time
union all select 'DIM_SERVICE', count(*) from svc
union all select 'DIM_PROTOCOL', (select count(distinct proto) from stg where proto <> 'UNKNOWN') + 1
union all select 'DIM_STATE', (select count(distinct state) from stg where state <> 'UNKNOWN') + 1
union all select 'DIM_PORT', count(*) from prt
union all select 'DIM_ATTACK', count(*) from att""")

oracle("e1_dim_time", f"""
select stime as time_key, {ts_fmt('ts')} as timestamp, cast(hour(ts) as int) as hour, cast(day(ts) as int) as day,
 cast(month(ts) as int) as month, cast(quarter(ts) as int) as quarter, cast(year(ts) as int) as year,
 dayofweek(ts) in (0, 6) as is_weekend
from (select distinct stime, make_timestamp(stime * 1000000) as ts from stg where stime is not null)""")

oracle("e2_dim_service", """
select cast(row_number() over (order by service) as int) as service_key, service as service_name
from (select distinct service from stg where service is not null)""")

oracle("e3_dim_protocol", """
select cast(row_number() over (order by proto, state nulls first) as int) as protocol_key, proto as protocol_name, state as protocol_state
from (select distinct proto, state from stg where proto is not null)""")

oracle("e4_dim_location", """
select srcip as ip_address, sport as port from stg where sport is not null
union select dstip, dsport from stg where dsport is not null""")

oracle("e5_dim_attack_category", """
select cast(row_number() over (order by attack_cat) as int) as category_key, attack_cat as category_name
from (select distinct attack_cat from stg where attack_cat is not null)""")

oracle("e6_dim_attack", """
select cast(row_number() over (order by p.category_name nulls first, p.is_attack nulls first) as int) as attack_key,
 c.category_key, p.category_name, p.is_attack
from (select distinct attack_cat as category_name, (label = 1) as is_attack from stg) p
left join (select cast(row_number() over (order by attack_cat) as int) as category_key, attack_cat
           from (select distinct attack_cat from stg where attack_cat is not null)) c on c.attack_cat = p.category_name""")

oracle("f1_fact_connections", """
select time_key, src_ip, src_port, dst_ip, dst_port, service_name, protocol_name, protocol_state, category_name, is_attack,
 duration, src_bytes, dst_bytes, src_packets, dst_packets, total_bytes, total_packets from g1""")

oracle("f3_fact_connection", """
select time_id, service_name, source_port, dest_port, state_name, protocol_name, category as attack_category,
 cast(duration as double) as duration, source_bytes, dest_bytes, source_packets, dest_packets,
 cast(source_load as double) as source_load, cast(dest_load as double) as dest_load,
 source_ttl, dest_ttl, source_loss, dest_loss, ct_srv_src, ct_srv_dst, ct_state_ttl from ft""")

# ---- design-document queries (P) and written requirements (K) ---------------------------

oracle("p1_duration_anomalies", f"""
select service_name, count(*) as connections, {xavg('duration')} as avg_duration
from ft where duration > (select percentile_cont(0.95) within group (order by duration) from ft) group by service_name""")

oracle("p2_hourly_load_profile", f"""
select hour, cast(sum(total_connections) as bigint) as connections, {xavg('avg_duration')} as duration from r1 group by hour""")

oracle("p3_service_protocol_attack_counts", """
select service_name, protocol_name, category as attack_category, count(*) as connections from ft
group by service_name, protocol_name, category""")

oracle("p4_monthly_trend", """
select service_name, cast(month(make_timestamp(time_id * 1000000)) as int) as month, total_connections, attack_percentage from r3""")

oracle("p5_attacks_per_service", "select service_name, count(*) as attack_count from ft where is_attack group by service_name")

oracle("p6_mean_hourly_connections", f"select hour, {xavg('total_connections')} as avg_connections from r1 group by hour")

oracle("k1_by_day_of_week", f"""
select service_name, cast(dayofweek(datetime) as int) as day_of_week, count(*) as total_connections,
 {_cnt('is_attack')} as attack_connections, {_cnt('not is_attack')} as normal_connections
from ft group by service_name, dayofweek(datetime)""")

oracle("k2_bytes_by_service_category", f"""
select service_name, category as attack_category, cast(sum(source_bytes) as bigint) as source_bytes,
 cast(sum(dest_bytes) as bigint) as dest_bytes, cast(sum({BYTES}) as bigint) as total_bytes
from ft where is_attack group by service_name, category""")

oracle("k3_duration_by_category_service", f"""
select category as attack_category, service_name, cast(min(duration) as double) as min_duration,
 {xavg('duration')} as avg_duration, cast(max(duration) as double) as max_duration
from ft where is_attack group by category, service_name""")

oracle("k4_top_ports_per_category", """
select * from (select category as attack_category, dest_port, count(*) as connection_count,
 cast(rank() over (partition by category order by count(*) desc) as int) as rank
 from ft where is_attack group by category, dest_port) where rank <= 10""")

oracle("k5_attacks_by_category_time", "\nunion all\n".join(
    f"""select category as attack_category, service_name, {h} as hour, {d} as day, {mo} as month, count(*) as attack_count,
 '{unit}' as grouping_type from ft where is_attack group by category, service_name, {unit}"""
    for unit, h, d, mo in (
        ("hour", "hour", "cast(null as int)", "cast(null as int)"),
        ("day", "cast(null as int)", "day", "cast(null as int)"),
        ("month", "cast(null as int)", "cast(null as int)", "month"),
    )))

oracle("k6_compare_by_unit", "\nunion all\n".join(
    f"""select service_name, '{unit}' as time_unit, {unit} as time_value,
 {xavg(f'case when not is_attack then {BYTES} end')} as normal_avg_bytes,
 {xavg(f'case when is_attack then {BYTES} end')} as attack_avg_bytes,
 {xavg(f'case when not is_attack then {PACKETS} end')} as normal_avg_packets,
 {xavg(f'case when is_attack then {PACKETS} end')} as attack_avg_packets
from ft group by service_name, {unit}""" for unit in ("hour", "day", "month")))

oracle("k7_duration_by_unit", "\nunion all\n".join(
    f"""select service_name, '{unit}' as time_unit, {value} as time_value,
 {xavg('case when not is_attack then duration end')} as avg_normal,
 {xavg('case when is_attack then duration end')} as avg_attack,
 round({xavg_raw('case when is_attack then duration end')} / nullif({xavg_raw('case when not is_attack then duration end')}, 0), 6) as duration_ratio
from ft group by service_name{group}""" for unit, value, group in (
        ("hour", "hour", ", hour"), ("day", "day", ", day"), ("month", "month", ", month"), ("all", "cast(null as int)", ""))))

oracle("k8_exclusive_ports_per_service", """
select service_name, dest_port from ft group by service_name, dest_port having bool_and(is_attack)""")

oracle("k9_top5_service_summary", f"""
select s.*, p.top_ports from (
 select service_name, count(*) as total_connections, {_cnt('not is_attack')} as normal_connections,
  {_cnt('is_attack')} as attack_connections,
  {xavg('case when not is_attack then duration end')} as avg_duration_normal,
  {xavg('case when is_attack then duration end')} as avg_duration_attack,
  count(distinct hour) as active_hours, count(distinct day) as active_days, count(distinct month) as active_months
 from ft group by service_name order by attack_connections desc, service_name limit 5) s
left join (
 select service_name, string_agg(cast(dest_port as varchar), ',' order by rn) as top_ports from (
  select service_name, dest_port, row_number() over (partition by service_name order by count(*) desc, dest_port) as rn
  from ft group by service_name, dest_port) where rn <= 5 group by service_name) p using (service_name)""")

oracle("k10_service_protocol_matrix", "select service_name, protocol_name, count(*) as connections from ft group by service_name, protocol_name")
oracle("k10_port_service_matrix", "select dest_port, service_name, count(*) as connections from ft group by dest_port, service_name")
oracle("k10_service_protocol_pivot", "select service_name, " + ", ".join(
    f"count(*) filter (where protocol_name = '{p}') as {p}" for p in ("arp", "icmp", "tcp", "udp")) + ", count(*) filter (where protocol_name not in ('arp', 'icmp', 'tcp', 'udp')) as other from ft group by service_name")
oracle("k10_attack_service_matrix", "select category as attack_category, service_name, count(*) as connections from ft group by category, service_name")

oracle("k11_derived_metrics", f"""
select time_id, service_name, source_bytes, dest_bytes,
 round(cast({BYTES} as double) / nullif(cast(duration as double), 0), 6) as transfer_rate,
 round(cast(source_loss + dest_loss as double) / nullif(cast({PACKETS} as double), 0), 6) as packet_loss_ratio
from ft""")

oracle("k12_monthly_trend_changes", f"""
select service_name, month, total_connections, attack_percentage,
 total_connections - lag(total_connections) over w as delta_connections,
 {_pct('total_connections - lag(total_connections) over w', 'lag(total_connections) over w')} as pct_change,
 round(attack_percentage - lag(attack_percentage) over w, 2) as delta_attack_percentage
from (select service_name, strftime(datetime, '%Y-%m') as month, count(*) as total_connections,
       {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage
      from ft group by service_name, strftime(datetime, '%Y-%m'))
window w as (partition by service_name order by month)""")

oracle("k13_first_seen_threats", f"""
select service_name, category as attack_category, {ts_fmt('min(datetime)')} as first_seen
from ft where is_attack group by service_name, category""")

oracle("k14_protocol_safety", f"""
select protocol_name, count(*) as total_connections, {_cnt('is_attack')} as attack_connections,
 {_pct(_cnt('is_attack'), 'count(*)')} as attack_percentage from ft group by protocol_name""")

oracle("k15_overload_hours", """
select * from (select service_name, hour, count(*) as connections,
 cast(rank() over (partition by service_name order by count(*) desc) as int) as rank
 from ft group by service_name, hour) where rank <= 3""")

# ---- load, sink, validation, versioning, streaming --------------------------------------

USED_COLS = ("srcip, sport, dstip, dsport, proto, state, dur, sbytes, dbytes, sttl, dttl, sloss, dloss, service, sload, dload, "
             "spkts, dpkts, stime, ltime, ct_srv_src, ct_srv_dst, ct_state_ttl, attack_cat, label")
SAMPLE_ORDER = ", ".join(f"{c.strip()} nulls first" for c in USED_COLS.split(","))
G1_VALID = "sport is not null and dsport is not null and stime is not null"

oracle("s1_csv_with_header", f"select {USED_COLS} from stg")
oracle("s3_parse_raw_lines", f"select {USED_COLS} from raw")

RULE_MSGS = """concat_ws('; ',
 case when not coalesce(sport between 0 and 65535, true) then 'source port out of range 0..65535' end,
 case when not coalesce(dsport between 0 and 65535, true) then 'destination port out of range 0..65535' end,
 case when not coalesce(dur >= 0, true) then 'negative duration' end,
 case when not coalesce(sbytes >= 0 and dbytes >= 0, true) then 'negative bytes' end,
 case when not coalesce(spkts >= 0 and dpkts >= 0, true) then 'negative packets' end,
 case when not coalesce(stime >= 0 and ltime >= 0 and ltime >= stime, true) then 'invalid start/end time' end)"""

oracle("s7_rejected_rows", f"""
select srcip, sport, dstip, dsport, dur, stime, ltime, {RULE_MSGS} as error_message
from raw where not (coalesce(sport between 0 and 65535, true) and coalesce(dsport between 0 and 65535, true)
 and coalesce(dur >= 0, true) and coalesce(sbytes >= 0 and dbytes >= 0, true) and coalesce(spkts >= 0 and dpkts >= 0, true)
 and coalesce(stime >= 0 and ltime >= 0 and ltime >= stime, true))""")

oracle("s9_quality_profile", """
select count(*) as total_records,
 count(case when srcip is null or dstip is null then 1 end) as missing_ips,
 count(case when sport is null or dsport is null then 1 end) as missing_ports,
 count(case when proto is null then 1 end) as missing_protocols,
 count(case when state is null then 1 end) as missing_states,
 count(case when dur < 0 then 1 end) as negative_durations,
 count(case when sbytes < 0 or dbytes < 0 then 1 end) as negative_bytes,
 count(case when spkts < 0 or dpkts < 0 then 1 end) as negative_packets,
 count(case when stime > ltime then 1 end) as invalid_timestamps,
 count(distinct service) as distinct_services, count(distinct attack_cat) as distinct_attack_categories,
 count(case when label not in (0, 1) then 1 end) as invalid_labels
from raw""")

oracle("s11_staging_counts", """
select 'source_data' as table_name, count(*) as record_count from raw union all select 'valid_rows', count(*) from stg
union all select 'rejected_rows', (select count(*) from raw) - (select count(*) from stg)""")
oracle("s2_line_numbers", """
select count(*) as lines, count(*) as distinct_numbers, count(*) + count(case when sport % 5 = 0 then 1 end) as physical_lines from raw""")
oracle("s8_load_errors", """
select concat_ws('; ', case when sport % 7 = 0 then 'invalid dur' end, case when sport % 11 = 0 then 'invalid stime' end) as error_message,
 srcip, sport, dstip, true as has_line from raw where sport % 7 = 0 or sport % 11 = 0""")

oracle("e7_attack_flag_facts", """
select 1 as attack_key, cast(null as int) as category_key, true as is_attack, count(case when label = 1 then 1 end) as connections from stg
union all select 2, null, false, count(case when label <> 1 then 1 end) from stg""")
oracle("s12_valid_sample", f"select {USED_COLS} from stg where {G1_VALID} order by {SAMPLE_ORDER} limit 1000")
oracle("s13_distinct_sample", f"select * from (select distinct {USED_COLS} from stg where {G1_VALID}) order by {SAMPLE_ORDER} limit 1000")

PORT_IDS = """pid AS (
select 0 as port_id, port_number, range_type, default_service from prt where port_number = 0
union all select cast(row_number() over (order by port_number) as int), port_number, range_type, default_service from prt where port_number <> 0),
rawports AS (
select port_number, min(service) as lo, max(service) as hi
from (select sport as port_number, service from raw where sport is not null union all select dsport, service from raw where dsport is not null)
where port_number <> 0 group by port_number)"""


def oracle_ports(name: str, body: str) -> None:
    oracle(name, "select * from (with " + PORT_IDS + body + ")")


oracle_ports("s14_merge_ports", """
select port_id, port_number, range_type, default_service from pid
union all
select cast((select max(port_id) from pid) + row_number() over (order by port_number) as int), port_number,
 case when port_number < 1024 then 'SYSTEM' when port_number < 49152 then 'USER' else 'DYNAMIC' end, coalesce(lo, 'UNKNOWN')
from rawports where port_number not in (select port_number from pid)""")

oracle("s17_partition_counts", """
select strftime(make_timestamp(time_id * 1000000), '%Y-%m') as year_month, count(*) as record_count from ft group by 1""")

oracle("s20_window_source_count", f"select count(*) as source_records from ft where time_id between {WINDOW[0]} and {WINDOW[1]}")
oracle("s21_fact_counts", """
select 'fact_connection' as table_name, count(*) as record_count from ft
union all select 'g1_fact_connections', count(*) from g1""")

oracle("v3_orphan_checks", """
select 'time_id' as check_name, count(*) as orphan_count from ft where time_id not in (select time_id from dim_time)
union all select 'service_id', count(*) from ft where service_name not in (select name from svc)
union all select 'source_port_id', count(*) from ft where source_port not in (select port_number from prt)
union all select 'dest_port_id', count(*) from ft where dest_port not in (select port_number from prt)
union all select 'state_id', count(*) from ft where state_name not in (select distinct coalesce(state, 'UNKNOWN') from stg union select 'UNKNOWN')
union all select 'protocol_id', count(*) from ft where protocol_name not in (select distinct coalesce(proto, 'UNKNOWN') from stg union select 'UNKNOWN')
union all select 'attack_id', count(*) from ft where category not in (select category from att)""")

oracle("v5_orphan_matrix", """
select 'FACT_CONNECTION' as table_name, count(*) as total_records,
 count(case when s.name is null then 1 end) as orphaned_services, count(case when p.name is null then 1 end) as orphaned_protocols
from ft left join svc s on s.name = ft.service_name
left join (select distinct proto as name from stg where proto is not null union select 'UNKNOWN') p on p.name = ft.protocol_name""")

oracle("v6_active_service_facts", "select count(s.name) as kept_rows, count(*) - count(s.name) as removed_rows from ft left join svc s on s.name = ft.service_name")

oracle("v8_key_violations", """
select 'dim_time' as table_name, 'time_id' as key, count(*) as violations from (select 1 from dim_time group by time_id having count(*) > 1)
union all select 'dim_service', 'name', count(*) from (select 1 from svc group by name having count(*) > 1)
union all select 'dim_port', 'port_number', count(*) from (select 1 from prt group by port_number having count(*) > 1)
union all select 'dim_attack', 'category', count(*) from (select 1 from att group by category having count(*) > 1)
union all select 'fact_hourly_traffic', 'time_id,service_id,protocol_id,attack_id',
 (select count(*) from (select 1 from r1 group by time_id, service_name, protocol_name, attack_category having count(*) > 1))
union all select 'fact_daily_traffic', 'time_id,service_id,protocol_id,attack_id',
 (select count(*) from (select 1 from r2 group by time_id, service_name, protocol_name, attack_category having count(*) > 1))
union all select 'fact_daily_traffic_declared', 'time_id,service_id,protocol_id,attack_id', (select count(*) from (
 select 1 from (select distinct first_id as time_id, service_name, protocol_name, category, day_start from ftp join day_first using (day_start))
 group by time_id, service_name, protocol_name, category having count(*) > 1))""")

_EXPECTED = """case when category in ('Backdoors','Shellcode','Worms') then 5 when category in ('DoS','Exploits') then 4
 when category in ('Fuzzers','Generic') then 3 when category in ('Analysis','Reconnaissance') then 2 else 1 end"""
for _name, _times, _hourly, _shift, _active, _severity in (
    ("v9_business_rules", "select time_id, datetime from dim_time", "select * from r1", 0, "true", "severity"),
    ("v9_rules_found", "select time_id, case when hour = 3 then datetime + interval 1000 years else datetime end as datetime from dim_time where hour % 4 <> 1",
     "select * from r1 where time_id // 86400 % 2 = 0 or protocol_name <> 'udp'", 60000, "name not in ('ftp', 'ssh')",
     "case when category in ('Worms', 'Fuzzers') then 0 else severity end"),
):
    oracle(_name, f"""
select 'hour_gaps' as rule, (select count(*) from (select lead(time_id) over (order by time_id) - time_id as step from ({_times})) where step > 3600) as violations
union all select 'future_hours', (select count(*) from ({_times}) where datetime > now()::timestamp)
union all select 'hourly_rollup_mismatch', (select count(*) from (select time_id, service_name, protocol_name, category as attack_category, count(*) as n
   from ft group by all) x full outer join ({_hourly}) r using (time_id, service_name, protocol_name, attack_category)
   where x.n is distinct from r.total_connections)
union all select 'inactive_services', (select count(*) from ft join (select name, {_active} as is_active from svc) s on s.name = ft.service_name where not s.is_active)
union all select 'ports_out_of_range', (select count(*) from ft where dest_port + {_shift} not between 0 and 65535)
union all select 'unclassified_connections', (select count(*) from ft where category is null)
union all select 'severity_mismatch', (select count(*) from att where is_attack and {_severity} <> {_EXPECTED})""")

CUR = """(select name, (select min(proto) from stg where stg.service = s.name) as p_old,
 (select max(proto) from stg where stg.service = s.name) as p_new from svc s where name <> 'UNKNOWN')"""
oracle("d10_scd2_service", f"""
select name, p_old as protocol, 1 as version, false as is_active, '2024-01-01 00:00:00' as valid_from, '2024-03-01 00:00:00' as valid_to
 from {CUR} where p_old is distinct from p_new
union all select name, p_new, 2, true, '2024-03-01 00:00:00', null from {CUR} where p_old is distinct from p_new
union all select name, p_old, 1, true, '2024-01-01 00:00:00', null from {CUR} where p_old is not distinct from p_new
union all select 'UNKNOWN', 'UNKNOWN', 1, true, '2024-01-01 00:00:00', null""")

oracle("x1_stream_hourly_rollup", f"""
select time_id as window_start, service_name, protocol_name, category as attack_category, count(*) as total_connections,
 {_cnt('not is_attack')} as normal_connections, {_cnt('is_attack')} as attack_connections,
 cast(sum({BYTES}) as bigint) as total_bytes, cast(sum({PACKETS}) as bigint) as total_packets,
 cast(sum(cast(duration * 1000 as bigint)) as bigint) as duration_ms_sum
from ft group by time_id, service_name, protocol_name, category""")

oracle("f5_measure_rejects", """
select service, sport, stime, dur, sload, dload from stg
where (dur is not null and try_cast(dur as decimal(10,3)) is null) or (sload is not null and try_cast(sload as decimal(10,3)) is null)
 or (dload is not null and try_cast(dload as decimal(10,3)) is null)""")

oracle("v3_orphans_found", """
select 'time_id' as check_name, count(*) as orphan_count from ft where time_id % 18000 = 0
union all select 'service_id', count(*) from ft where service_name = 'dns'
union all select 'source_port_id', count(*) from ft where source_port % 7 = 3
union all select 'dest_port_id', count(*) from ft where dest_port % 7 = 3
union all select 'state_id', count(*) from ft where state_name = 'FIN'
union all select 'protocol_id', count(*) from ft where protocol_name = 'icmp'
union all select 'attack_id', count(*) from ft where category = 'DoS'""")

oracle("v5_orphans_found", """
select 'FACT_CONNECTION' as table_name, count(*) as total_records, count(case when service_name = 'dns' then 1 end) as orphaned_services,
 count(case when protocol_name = 'icmp' then 1 end) as orphaned_protocols from ft""")

oracle("v6_inactive_removed", """
select count(case when service_name not in ('ftp', 'ssh') then 1 end) as kept_rows,
 count(case when service_name in ('ftp', 'ssh') then 1 end) as removed_rows from ft""")

oracle("f5_overflow_found", """
select service, sport, stime, dur, sload * 200 as sload, dload * 200 as dload from stg
where (dur is not null and try_cast(dur as decimal(10,3)) is null) or (sload is not null and try_cast(sload * 200 as decimal(10,3)) is null)
 or (dload is not null and try_cast(dload * 200 as decimal(10,3)) is null)""")

for _name, _bytes, _odd, _peak, _last in (
    ("v8_declared_checks", "source_bytes < 0", "false", 0, "first_seen > last_seen"),
    ("v8_checks_found", "source_bytes % 10 = 7", "time_id // 86400 % 2 = 1", 20, "true"),
):
    _total = lambda t, table, a="total_connections", b="normal_connections + attack_connections", odd=_odd: (
        f"select '{t}' as table_name, 'total_is_normal_plus_attack' as rule, count(*) as violations from {table} where {a} + case when {odd} then 1 else 0 end <> {b}"
    )
    oracle(_name, f"""
select 'fact_connection' as table_name, 'non_negative_measures' as rule, count(*) as violations from ft where {_bytes}
union all {_total('fact_hourly_traffic', 'r1')}
union all {_total('fact_daily_traffic', 'r2')}
union all select 'fact_daily_traffic', 'peak_hour_of_day', count(*) from r2 where not (peak_hour + {_peak} between 0 and 23)
union all {_total('fact_monthly_traffic', 'r3')}
union all {_total('fact_service_stats', 'ss')}
union all select 'fact_service_stats', 'peak_hour_of_day', count(*) from ss where not (peak_hour_normal + {_peak} between 0 and 23 and peak_hour_attack between 0 and 23)
union all {_total('fact_port_usage', 'pu', 'total_usage', 'normal_usage + attack_usage')}
union all select 'fact_port_usage', 'first_seen_before_last', count(*) from pu where {_last}""")

oracle("v8_duplicates_found", """
select 'dim_time' as table_name, 'time_id' as key, count(*) as violations from dim_time where time_id % 7200 = 0
union all select 'dim_service', 'name', count(*) from svc where risk_level = 'HIGH'
union all select 'dim_port', 'port_number', count(*) from prt where port_number % 4 = 1
union all select 'dim_attack', 'category', count(*) from att where severity = 4
union all select 'fact_connection', 'connection_id', count(*) from ft where time_id % 7200 = 0
union all select 'fact_hourly_traffic', 'time_id,service_id,protocol_id,attack_id', count(*) from r1 where time_id % 7200 = 0
union all select 'fact_service_stats', 'time_id,service_id,protocol_id,attack_id', count(*) from ss where time_id % 7200 = 0
union all select 'fact_port_usage', 'port_id,time_id,service_id,protocol_id,attack_id', count(*) from pu where time_id % 7200 = 0""")

_KEYS4 = "time_id, service_name, protocol_name, attack_category"
oracle("v9_coherence", f"""
select 'hourly_rollup_mismatch' as rule, (select count(*) from (select time_id, service_name, protocol_name, category as attack_category, count(*) as n
   from ft group by all) x full outer join r1 using ({_KEYS4}) where x.n is distinct from r1.total_connections) as violations
union all select 'daily_rollup_mismatch', (select count(*) from (select first_id as time_id, service_name, protocol_name, category as attack_category, hour as peak_hour, count(*) as n
   from ftp join day_first using (day_start) group by all) x full outer join r2 using ({_KEYS4}, peak_hour) where x.n is distinct from r2.total_connections)
union all select 'monthly_rollup_mismatch', (select count(*) from (select first_id as time_id, service_name, protocol_name, category as attack_category, day as peak_day, count(*) as n
   from ftp join month_first using (month_start) group by all) x full outer join r3 using ({_KEYS4}, peak_day) where x.n is distinct from r3.total_connections)
union all select 'source_ports_out_of_range', (select count(*) from ft where source_port not between 0 and 65535)
union all select 'dest_ports_out_of_range', (select count(*) from ft where dest_port not between 0 and 65535)""")

oracle("v9_incoherence_found", """
select 'hourly_rollup_mismatch' as rule, (select count(*) from r1 where time_id // 86400 % 2 = 1 and protocol_name = 'udp') as violations
union all select 'daily_rollup_mismatch', (select count(*) from r2 where time_id // 86400 % 2 = 1 and protocol_name = 'udp')
union all select 'monthly_rollup_mismatch', (select count(*) from r3 where time_id // 86400 % 2 = 1 and protocol_name = 'udp')
union all select 'source_ports_out_of_range', (select count(*) from ft where source_port + 60000 > 65535)
union all select 'dest_ports_out_of_range', (select count(*) from ft where dest_port + 60000 > 65535)""")

_PORT_VERSIONS = """, old AS (select * from pid where port_number % 10 <> 9), j AS (
select coalesce(old.port_number, s.port_number) as port_number, old.default_service as a, coalesce(s.hi, 'UNKNOWN') as b,
 old.port_number is not null as was, s.port_number is not null as now_ from old full outer join rawports s on old.port_number = s.port_number),
versions AS (
select port_number, a as default_service, 1 as version, not (now_ and a <> b) as is_active, '2024-01-01 00:00:00' as valid_from,
 case when now_ and a <> b then '2024-03-01 00:00:00' end as valid_to from j where was
union all select port_number, b, case when was then 2 else 1 end, true, '2024-03-01 00:00:00', null from j where now_ and (not was or a <> b))
"""
oracle_ports("d10_scd2_port", _PORT_VERSIONS + "select *, true as id_is_own from versions")
oracle_ports("d10_ports_as_of", _PORT_VERSIONS + "select port_number, default_service, version from versions where valid_from < '2024-02-15' and coalesce(valid_to, '9999') > '2024-02-15'")

ORACLE["r12_refresh_views"] = " union all ".join(
    f"select '{view}' as view_name, count(*) as record_count from ({ORACLE[query]})"
    for view, query in (
        ("mv_hourly_service_stats", "r5_hourly_service_stats"),
        ("mv_daily_traffic", "r6_daily_traffic"),
        ("mv_weekly_traffic", "r7_weekly_traffic"),
        ("mv_hourly_service_performance", "r8_hourly_service_performance"),
        ("mv_daily_attack_patterns", "r9_daily_attack_patterns"),
        ("mv_service_risk_profile", "r10_service_risk_profile"),
        ("mv_port_security_analysis", "r11_port_security_analysis"),
    )
)

# Appended batches give the fact of one build.
ORACLE["f4_appended_fact"] = ORACLE["f3_fact_connection"]
ORACLE["f4_appended_simple_fact"] = ORACLE["f1_fact_connections"]
ORACLE["f4_appended_hourly"] = ORACLE["r1_hourly_traffic"]
ORACLE["x1_compacted_rollup"] = ORACLE["x1_stream_hourly_rollup"]

_RANGES = """ranged AS (select *, case when stime >= 1705276800 and stime < 1706745600 then '2024_jan_late' when stime >= 1706745600 and stime < 1709251200 then '2024_feb'
 when stime >= 1710028800 and stime < 1711929600 then '2024_mar_late' else 'default' end as range_name
from (select * replace (case when sport % 13 = 0 then null else stime end as stime) from stg))"""


def _ranged(body: str) -> str:
    return f"select * from (with {_RANGES} {body})"


oracle("s16_declared_partitions", _ranged("""
select n.range_name, count(r.range_name) as record_count
from (values ('2024_jan_late'), ('2024_feb'), ('2024_mar_late'), ('default')) n(range_name) left join ranged r using (range_name) group by n.range_name"""))
oracle("s16_range_read", _ranged("""
select coalesce(service, 'UNKNOWN') as service_name, count(*) as connections, cast(sum(sbytes + dbytes) as bigint) as total_bytes
from ranged where stime >= 1707000000 and stime < 1708300000 group by 1"""))
oracle("s16_range_read_default", _ranged("""
select proto, count(*) as connections, min(stime) as first_stime, max(stime) as last_stime
from ranged where stime >= 1708300000 and stime < 1710200000 group by proto"""))

for _name, _table, _start in (("r2_daily_distinct_ports", "day_first", "day_start"), ("r3_monthly_distinct_ports", "month_first", "month_start")):
    oracle(_name, f"""
select first_id as time_id, service_name, protocol_name, category as attack_category,
 count(distinct source_port) as distinct_source_ports, count(distinct dest_port) as distinct_dest_ports
from ftp join {_table} using ({_start}) group by first_id, service_name, protocol_name, category""")
oracle("r1_window_distinct_ports", f"""
select service_name, count(distinct source_port) as distinct_source_ports, count(distinct dest_port) as distinct_dest_ports
from ft where time_id between {WINDOW[0]} and {WINDOW[1]} group by service_name""")

_SERVICE_VERSIONS = """
, seen AS (select service as name, min(proto) as lo, max(proto) as hi from stg where service is not null group by service),
service_versions AS (
select name, lo as protocol, 1 as version, timestamp '2024-01-01' as valid_from, case when lo <> hi then timestamp '2024-02-01' when name <> 'ftp' then timestamp '2024-03-10' end as valid_to
 from seen where name <> 'ssh'
union all select name, hi, case when name = 'ssh' then 1 else 2 end, timestamp '2024-02-01', case when name <> 'ftp' then timestamp '2024-03-10' end from seen where name = 'ssh' or lo <> hi
union all select name, lo || '/' || hi, case when name = 'ssh' or lo = hi then 2 else 3 end, timestamp '2024-03-10', null from seen where name <> 'ftp')
"""
oracle_ports("d10_facts_as_of", _PORT_VERSIONS + _SERVICE_VERSIONS + """
select stime, service as service_name, s.version as service_version, s.protocol as service_protocol, dsport as dest_port,
 p.version as port_version, p.default_service as port_service, sbytes, dbytes
from stg left join service_versions s on s.name = service and make_timestamp(stime * 1000000) >= s.valid_from and make_timestamp(stime * 1000000) < coalesce(s.valid_to, timestamp '9999-01-01')
left join versions p on p.port_number = dsport and make_timestamp(stime * 1000000) >= p.valid_from::timestamp and make_timestamp(stime * 1000000) < coalesce(p.valid_to::timestamp, timestamp '9999-01-01')
where stime is not null""")
