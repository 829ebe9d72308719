"""The same results as plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

_JOBS = """
jobs as (
  select concat('job_', cast(o_orderkey as varchar)) as job_name, o_orderpriority as job_description,
    case o_orderstatus when 'F' then 'N' when 'O' then 'Y' end as is_active,
    o_orderdate as modified_timestamp,
    coalesce(shipped, timestamp '1970-01-01 00:00:00') as last_sync_timestamp,
    concat('s3://scripts/', cast(o_custkey as varchar), '.py') as script_location,
    case when o_orderpriority <> '5-LOW' then '2.0' end as glue_version,
    cast(o_custkey as double) + 0.5 as max_capacity,
    case when o_orderpriority <> '5-LOW' then 'pythonshell' end as command_name,
    case o_orderpriority when '1-URGENT' then 7 when '2-HIGH' then 4 end as max_concurrent_runs,
    case when o_orderstatus = 'O' then 2 end as max_retries,
    cast(o_custkey as integer) as timeout_minutes
  from orders left join
    (select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey) s
    on o_orderkey = s.l_orderkey)"""

_LISTED = """
listed as (
  select concat('job_', cast(l_orderkey as varchar)) as job_name,
    concat('shipped ', cast(max(l_linenumber) as varchar)) as job_description,
    concat('s3://old/', cast(max(l_linenumber) as varchar)) as script_location,
    cast(max(l_quantity) as double) as max_capacity, 'pythonshell' as command_name,
    max(l_linenumber) as max_concurrent_runs, '1.0' as glue_version,
    max(l_linenumber) as max_retries, cast(max(l_quantity) as integer) as timeout_minutes
  from lineitem group by l_orderkey
  union all
  select concat('event_', cast(event_id as varchar)), event_type, 's3://others', 1.0, 'glueetl', 1,
    '0.9', 0, 60 from events)"""

_OWNERS = """
owners as (
  select concat('cust_', cast(c_custkey as varchar)) as job_name,
    case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Y' else 'N' end as is_active,
    case when c_nationkey = 3 then 'Y' else 'N' end as is_run_sync
  from customer)"""

_INST = """
inst as (
  select concat('cust_', cast(o_custkey as varchar)) as job_name, o_orderkey as job_instance,
    case when o_orderstatus = 'O' and o_orderpriority = '4-NOT SPECIFIED' then null
         when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then null
         else concat('jr_', cast(o_orderkey as varchar)) end as job_run_id,
    case concat(o_orderstatus, ' ', o_orderpriority)
      when 'F 1-URGENT' then 'STARTING' when 'F 2-HIGH' then 'RUNNING'
      when 'F 3-MEDIUM' then 'STOPPING' when 'F 4-NOT SPECIFIED' then 'UNKNOWN'
      when 'F 5-LOW' then 'SUCCEEDED'
      when 'O 1-URGENT' then 'FAILED' when 'O 2-HIGH' then 'TIMEOUT'
      when 'O 3-MEDIUM' then 'STOPPED' when 'O 4-NOT SPECIFIED' then 'RUNNING'
      when 'O 5-LOW' then 'UNKNOWN'
      when 'P 1-URGENT' then 'SUCCEEDED' when 'P 2-HIGH' then 'RUNNING'
      when 'P 3-MEDIUM' then 'FAILED' when 'P 4-NOT SPECIFIED' then 'STOPPED'
      when 'P 5-LOW' then 'TIMEOUT' end as status
  from orders)"""

_DET = """
det as (
  select l_orderkey as job_instance, concat('t_', cast(l_partkey as varchar)) as table_name,
    max(case when l_linestatus = 'O' then 'Y' else 'N' end) as is_active,
    max(l_shipdate) as last_run_timestamp
  from lineitem group by l_orderkey, l_partkey)"""

_RUNS = """
runs as (
  select concat('jr_', cast(o_orderkey as varchar)) as job_run_id,
    case when o_totalprice >= 300000 then 'RUNNING' when o_totalprice >= 100000 then 'SUCCEEDED'
         else 'FAILED' end as actual_status,
    case when o_totalprice < 100000 then concat('error ', o_orderpriority) end as error_message
  from orders)"""

_GATE = """
gate as (
  select i.job_name, i.job_instance, i.job_run_id, r.actual_status
  from inst i join runs r on i.job_run_id = r.job_run_id
  where i.status in ('STARTING', 'RUNNING', 'STOPPING', 'UNKNOWN')
    and r.actual_status in ('STARTING', 'RUNNING', 'STOPPING'))"""

_PLAN = """
merged as (
  select coalesce(w.job_name, l.job_name) as job_name, w.is_active, w.job_description,
    w.modified_timestamp, w.last_sync_timestamp, w.glue_version, w.max_retries, w.timeout_minutes,
    w.script_location, w.max_capacity, w.command_name, w.max_concurrent_runs,
    l.script_location as old_script, l.max_capacity as old_capacity, l.command_name as old_command,
    l.max_concurrent_runs as old_runs, l.job_description as old_description, l.glue_version as old_version,
    l.max_retries as old_retries, l.timeout_minutes as old_timeout,
    case when l.job_name is null then 'left_only' when w.job_name is null then 'right_only'
         else 'both' end as merge_side
  from jobs w full outer join listed l on w.job_name = l.job_name),
plan as (
  select *, case
    when merge_side = 'left_only' and is_active = 'Y' then 'create'
    when merge_side = 'both' and is_active = 'Y' and modified_timestamp > last_sync_timestamp
      then 'update'
    when merge_side = 'both' and (is_active is null or is_active <> 'Y') then 'delete'
    else 'none' end as action
  from merged)"""

_APPLIED = """
select job_name,
  case when action in ('create', 'update') then job_description else old_description end
    as job_description,
  case when action in ('create', 'update') then script_location else old_script end as script_location,
  case when action in ('create', 'update') then max_capacity else old_capacity end as max_capacity,
  case when action in ('create', 'update') then coalesce(command_name, 'glueetl') else old_command end
    as command_name,
  case action when 'create' then coalesce(max_concurrent_runs, 10)
    when 'update' then coalesce(max_concurrent_runs, 3) else old_runs end as max_concurrent_runs,
  case action when 'create' then glue_version else old_version end as glue_version,
  case action when 'create' then '3' end as python_version,
  case action when 'create' then coalesce(max_retries, 0)
    when 'update' then coalesce(max_retries, 1) else old_retries end as max_retries,
  case action when 'create' then coalesce(timeout_minutes, 180)
    when 'update' then coalesce(timeout_minutes, 180) else old_timeout end as timeout_minutes
from plan
where action = 'create' or (merge_side <> 'left_only' and action <> 'delete')"""

_REQUESTS = """
requests as (
  select o_orderkey as job_instance, o_orderpriority as context,
    case o_orderstatus
      when 'F' then concat('t_', cast(lo as varchar), ' | t_', cast(hi as varchar))
      when 'P' then concat('t_', cast(lo as varchar), '|t_', cast(o_custkey as varchar))
    end as tables,
    case o_orderstatus when 'F' then concat('t_', cast(hi as varchar))
      when 'P' then concat('t_', cast(o_custkey as varchar)) end as second_table,
    concat('t_', cast(lo as varchar)) as first_table,
    strftime(o_orderdate, '%Y-%m-%d') as incr_from,
    case when o_orderpriority = '1-URGENT' then cast(10 as double) end as max_capacity, lo
  from orders left join
    (select l_orderkey, min(l_partkey) as lo, max(l_partkey) as hi from lineitem group by l_orderkey) p
    on o_orderkey = l_orderkey
  union all
  select -1 - c_custkey, c_mktsegment, null, null, null, null, null, null from customer),
asked as (
  select job_instance, first_table as table_name from requests where tables is not null and lo is not null
  union all
  select job_instance, second_table from requests where tables is not null and lo is not null),
checked as (
  select a.job_instance, count(*) = count(distinct d.table_name) as valid
  from asked a left join det d on a.job_instance = d.job_instance and a.table_name = d.table_name
  group by a.job_instance),
decided as (
  select q.*, case when i.job_instance is null then 'no_instance' when g.job_instance is not null then 'overlap'
    when not c.valid then 'bad_tables' else 'start' end as decision,
    case when lo is not null then tables end as given
  from requests q left join inst i on q.job_instance = i.job_instance
    left join gate g on q.job_instance = g.job_instance
    left join checked c on q.job_instance = c.job_instance)"""

_MESSAGES = """
messages as (
  select event_id as seq, concat('user_', cast(user_id as varchar)) as job_name,
    cast(day(ts) as integer) as job_instance, event_type as body, ts as sent
  from events)"""

_TAKEN = """
tabled as (
  select *, case body when 'click' then 'customer' when 'view' then 'supplier'
    when 'purchase' then 'orders' when 'signup' then 'part' end as table_name
  from messages),
taken as (
  select t.* from tabled t left join
    (select job_name, job_instance, min(seq) as stop_seq from messages where body = 'error'
     group by job_name, job_instance) s
    on t.job_name = s.job_name and t.job_instance = s.job_instance
  where stop_seq is null or seq < stop_seq)"""

_PART_REQUEST = "concat(p_brand, ' | ', p_type, '|', case when p_size > 40 then p_brand else p_name end)"


def _with(*ctes: str) -> str:
    return "with" + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "etl_csv_to_parquet": "select * from customer",
    "etl_csv_declared": "select * from orders",
    "etl_csv_to_orc": "select * from part",
    "etl_convert_many": """
        select 'customer' as table_name, count(*) as n_rows from customer
        union all select 'supplier', count(*) from supplier
        union all select 'part', count(*) from part
        union all select 'nation', count(*) from nation
        union all select 'region', count(*) from region""",
    "control_scan": _with(_JOBS) + """
        select job_name, job_description, is_active, 'N' as is_run_sync, modified_timestamp,
          timestamp '1970-01-01 00:00:00' as last_sync_timestamp from jobs""",
    "snapshot_listing": _with(_LISTED) + "select job_name from listed",
    "read_partition_pruned": """
        select event_id, user_id from events where cast(ts as date) >= date '2024-01-16'""",
    "stage_full_refresh": "select * from orders",
    "stage_truncate": "select * from supplier where false",
    "incremental_window": """
        select o_orderkey, o_orderdate from orders
        where o_orderdate >= timestamp '1996-07-01 00:00:00'
          and o_orderdate < timestamp '1999-01-01 00:00:00'""",
    "incremental_load": """
        select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as order_year
        from orders""",
    "status_class": _with(_INST) + """
        select job_name, job_instance, status,
          case when status in ('STARTING', 'RUNNING', 'STOPPING') then 'running'
               when status = 'UNKNOWN' then 'unknown'
               when status in ('SUCCEEDED', 'FAILED', 'TIMEOUT') then 'terminal'
               else 'other' end as status_class
        from inst""",
    "param_extract": _with(_JOBS) + """
        select job_name, script_location, glue_version, max_capacity,
          coalesce(command_name, 'glueetl') as command_name,
          coalesce(max_concurrent_runs, 3) as max_concurrent_runs,
          case when is_active is not null then coalesce(max_retries, 1) end as max_retries,
          coalesce(timeout_minutes, 180) as timeout_minutes
        from jobs""",
    "param_violations": """
        select concat('job_', cast(o_orderkey as varchar)) as job_name, 'max_retries' as field, '2.5' as text
        from orders where o_orderstatus not in ('O', 'F')""",
    "param_extract_events": """
        select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
          coalesce(cast(json_extract_string(props, '$.timeout_minutes') as integer), 180)
            as timeout_minutes
        from events""",
    "column_defaults": _with(_JOBS) + "select job_name, coalesce(is_active, 'N') as is_active from jobs",
    "table_list_explode": f"""
        select p_partkey, trim(u) as table_name
        from (select p_partkey, unnest(string_split({_PART_REQUEST}, '|')) as u from part) t""",
    "quoted_list": """
        select p_partkey, concat('''', p_brand, ''',''', p_type, ''',''',
          case when p_size > 40 then p_brand else p_name end, '''') as quoted from part""",
    "run_arguments": """
        select o_orderkey, cast(o_orderkey as varchar) as job_instance,
          o_orderstatus || '|' || o_orderpriority as tables, '' as incr_from,
          case when o_orderstatus = 'O' then cast(10 as double) end as max_capacity
        from orders""",
    "name_templates": """
        select o_orderkey,
          concat('cust', cast(o_custkey as varchar), '_', cast(o_orderkey as varchar), '.fifo')
            as queue_name,
          concat('s3://loads/data/', o_orderpriority, '/parquet/') as load_path
        from orders""",
    "active_tables": _with(_INST, _DET) + """
        select job_instance, table_name from det
        where is_active = 'Y' and job_instance in
          (select job_instance from inst where status not in ('STARTING', 'RUNNING', 'STOPPING'))""",
    "active_table_counts": _with(_DET) + """
        select job_instance, count(*) as n_tables from det where is_active = 'Y' group by job_instance""",
    "run_lookup": _with(_INST) + """
        select job_name, job_instance, job_run_id, status from inst
        where job_instance in (select l_orderkey from lineitem where l_returnflag = 'R')""",
    "overlap_gate": _with(_INST, _RUNS, _GATE) + "select * from gate",
    "failed_runs": _with(_RUNS) + "select * from runs where error_message is not null",
    "active_instances": _with(_OWNERS, _INST) + """
        select i.job_name, i.job_instance from owners o join inst i on o.job_name = i.job_name
        where o.is_active = 'Y'""",
    "jobs_with_instances": _with(_OWNERS, _INST) + """
        select job_name from owners where is_active = 'Y'
          and exists (select 1 from inst i where i.job_name = owners.job_name)""",
    "run_requests": _with(_INST, _DET, _RUNS, _GATE, _REQUESTS) + """
        select job_instance, decision, given as tables, coalesce(incr_from, '') as incr_from, context, max_capacity
        from decided""",
    "run_request_tables": _with(_INST, _DET, _RUNS, _GATE, _REQUESTS) + """
        select a.job_instance, a.table_name from asked a join decided q on a.job_instance = q.job_instance
        where q.decision = 'start'
        union all
        select d.job_instance, d.table_name from det d join decided q on d.job_instance = q.job_instance
        where q.decision = 'start' and q.given is null and d.is_active = 'Y'""",
    "run_starts_stored": _with(_INST, _DET, _RUNS, _GATE, _REQUESTS) + """
        select i.job_name, i.job_instance,
          case when decision = 'start' then concat('new_', cast(i.job_instance as varchar))
            else job_run_id end as job_run_id,
          case when decision = 'start' then 'UNKNOWN' else status end as status
        from inst i join decided q on i.job_instance = q.job_instance""",
    "run_ends_stored": _with(_INST, _RUNS) + """
        select i.job_name, i.job_instance, i.job_run_id,
          case when actual_status in ('SUCCEEDED', 'FAILED', 'TIMEOUT') then actual_status
            else status end as status
        from inst i left join runs r on i.job_run_id = r.job_run_id""",
    "merge_indicator": _with(_JOBS, _LISTED, _PLAN) + "select job_name, is_active, merge_side from merged",
    "sync_plan": _with(_JOBS, _LISTED, _PLAN) + "select job_name, action from plan",
    "sync_plan_bucketed": _with(_JOBS, _LISTED, _PLAN) + "select job_name, action from plan",
    "sync_plan_counts": _with(_JOBS, _LISTED, _PLAN)
    + "select action, count(*) as n from plan group by action",
    "apply_changes": _with(_JOBS, _LISTED, _PLAN) + _APPLIED,
    "sync_cycle": _with(_JOBS, _LISTED, _PLAN) + _APPLIED,
    "set_sync_flag": _with(_OWNERS) + "select job_name, 'Y' as is_run_sync from owners",
    "mark_synced": _with(_JOBS) + """
        select job_name, timestamp '2002-01-01 00:00:00' as last_sync_timestamp, 'N' as is_run_sync
        from jobs""",
    "update_instances": _with(_INST) + """
        select i.job_name, i.job_instance,
          case when o_totalprice < 300000 then concat('jr2_', cast(o_orderkey as varchar))
            else job_run_id end as job_run_id,
          case when o_totalprice < 100000 then 'FAILED' when o_totalprice < 300000 then 'SUCCEEDED'
            else status end as status
        from inst i join orders on job_instance = o_orderkey""",
    "update_instances_latest": _with(_INST) + """
        select job_name, job_instance,
          case when shipped is null then job_run_id
            else concat('ship_', strftime(shipped, '%Y-%m-%d')) end as job_run_id,
          case when shipped is null then status else 'SUCCEEDED' end as status
        from inst left join
          (select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey) s
          on job_instance = l_orderkey""",
    "update_details": """
        select l_orderkey as job_instance, concat('t_', cast(l_partkey as varchar)) as table_name,
          max(case when l_linestatus = 'O' then 'Y' else 'N' end) as is_active,
          case when max(case when l_returnflag = 'R' then 1 else 0 end) = 1
            then timestamp '2002-01-01 00:00:00' else max(l_shipdate) end as last_run_timestamp
        from lineitem group by l_orderkey, l_partkey""",
    "sync_flag_count": _with(_OWNERS) + """
        select count(*) as n, count(*) > 0 as is_running from owners where is_run_sync = 'Y'""",
    "empty_guard": _with(_OWNERS) + "select count(*) = 0 as is_empty from owners",
    "membership_count": _with(_DET) + """
        select job_instance, count(*) as n from det
        where table_name in
          (select concat('t_', cast(p_partkey as varchar)) from part where p_type = 'ECONOMY')
        group by job_instance""",
    "membership_validate": _with(_DET) + """
        select l_orderkey as job_instance, count(*) as requested, count(distinct d.table_name) as matched,
          count(*) = count(distinct d.table_name) as valid
        from lineitem left join det d
          on l_orderkey = d.job_instance and concat('t_', cast(l_partkey as varchar)) = d.table_name
        group by l_orderkey""",
    "membership_validate_lists": f"""
        select t.p_partkey, count(*) as requested,
          count(distinct case when name in (p_brand, p_type, p_name) then name end) as matched,
          count(*) = count(distinct case when name in (p_brand, p_type, p_name) then name end) as valid
        from (select p_partkey, trim(u) as name
              from (select p_partkey, unnest(string_split({_PART_REQUEST}, '|')) as u from part) s) t
          join part on t.p_partkey = part.p_partkey
        group by t.p_partkey""",
    "batch_completeness": _with(_MESSAGES) + """
        select job_name, job_instance, count(*) as expected,
          count(case when body <> 'error' then 1 end) as received,
          count(*) = count(case when body <> 'error' then 1 end) as complete
        from messages group by job_name, job_instance""",
    "pk_violations": """
        select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "fk_orphans": """
        select o_orderkey, count(*) as n from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey) group by o_orderkey""",
    "null_violations": _with(_INST) + "select job_name, job_instance from inst where job_run_id is null",
    "length_violations": """
        select p_partkey, p_name, p_type from part where length(p_name) > 10 or length(p_type) > 7""",
    "control_violations": """
        select 'jobs' as table_name, 'primary key' as rule, count(*) as n
          from (select o_orderkey from orders group by o_orderkey having count(*) > 1) d
        union all select 'jobs', 'not null', count(*) from orders where o_orderdate is null
        union all select 'jobs', 'length', count(*) from orders where length(o_orderpriority) > 100
        union all select 'job_instances', 'primary key', count(*)
          from (select 1 from lineitem
                group by l_orderkey, case when l_returnflag <> 'N' then l_linenumber end
                having count(*) > 1) d
        union all select 'job_instances', 'not null', count(*) from lineitem where l_returnflag = 'N'
        union all select 'job_instances', 'length', count(*) from lineitem where l_returnflag = 'R'
        union all select 'job_instances', 'foreign key', count(*)
          from (select distinct l_orderkey from lineitem
                where l_orderkey not in (select o_orderkey from orders)) d
        union all select 'job_details', 'primary key', count(*)
          from (select 1 from lineitem
                group by case when l_linestatus = 'O' then -l_suppkey else l_orderkey end,
                  case when l_returnflag <> 'A' then l_linenumber end, l_partkey
                having count(*) > 1) d
        union all select 'job_details', 'not null', count(*) from lineitem
          where l_returnflag = 'A' or l_shipdate is null
        union all select 'job_details', 'length', count(*) from lineitem where l_returnflag = 'R'
        union all select 'job_details', 'foreign key', count(*)
          from (select distinct l_linestatus, case when l_linestatus = 'O' then l_suppkey else l_orderkey end,
                  l_linenumber
                from lineitem c
                where l_returnflag <> 'A' and (l_linestatus = 'O' or not exists
                  (select 1 from lineitem p where p.l_orderkey = c.l_orderkey
                     and p.l_linenumber = c.l_linenumber and p.l_returnflag <> 'N'))) d""",
    "stream_loads": """
        select event_type as table_name, count(*) as n_messages, max(event_id) as last_seq,
          count(*) as n_rows from events group by event_type""",
    "stream_table_loads": _with(_MESSAGES, _TAKEN) + """
        , sizes as (
          select 'customer' as table_name, count(*) as n_rows from customer
          union all select 'supplier', count(*) from supplier
          union all select 'orders', count(*) from orders
          union all select 'part', count(*) from part)
        select t.table_name, count(*) as n_messages, max(seq) as last_seq, max(n_rows) as n_rows
        from taken t join sizes on t.table_name = sizes.table_name group by t.table_name""",
    "stream_details_stamped": _with(_MESSAGES, _TAKEN) + """
        , named as (select distinct job_name, job_instance, table_name from taken)
        select d.job_name, d.job_instance, d.table_name,
          case when n.table_name is not null then timestamp '2002-01-01 00:00:00' else first_sent
            end as last_run_timestamp
        from (select job_name, job_instance, coalesce(table_name, 'region') as table_name,
                min(sent) as first_sent
              from tabled group by all) d
          left join named n on d.job_name = n.job_name and d.job_instance = n.job_instance
            and d.table_name = n.table_name""",
    "stream_retention": _with(_MESSAGES) + """
        select seq, job_name, body from messages
        where sent >= (select max(sent) from messages) - interval 12 hours""",
    "message_retention": _with(_MESSAGES) + """
        select seq, job_name, body from messages
        where sent >= (select max(sent) from messages) - interval 12 hours""",
    "stream_until_sentinel": _with(_MESSAGES) + """
        select s.job_name, s.job_instance, s.n_messages, e.expected, s.n_messages = e.expected as complete
        from (select s.job_name, s.job_instance, count(m.seq) as n_messages
              from (select job_name, job_instance, min(seq) as stop_seq from messages
                    where body = 'signup' group by job_name, job_instance) s
                left join messages m on m.job_name = s.job_name and m.job_instance = s.job_instance
                  and m.seq < s.stop_seq
              group by s.job_name, s.job_instance) s
          left join (select job_name, job_instance, count(*) as expected from messages
                     where body <> 'signup' group by job_name, job_instance) e
            on s.job_name = e.job_name and s.job_instance = e.job_instance""",
    "messages_until_sentinel": _with(_MESSAGES) + """
        select m.seq, m.job_name, m.body
        from (select job_name, min(seq) as stop_seq from messages where body = 'signup'
              group by job_name) s
          join messages m on m.job_name = s.job_name and m.seq < s.stop_seq""",
    "stream_latest_status": _with(_MESSAGES) + """
        select job_name, arg_max(body, seq) as last_status, max(seq) as last_seq
        from messages group by job_name""",
}

# the same messages over several micro-batches
ORACLE |= {
    f"{name}_many_files": ORACLE[twin]
    for name, twin in {
        "stream_loads": "stream_loads",
        "stream_details": "stream_details_stamped",
        "stream_until_sentinel": "stream_until_sentinel",
        "stream_latest_status": "stream_latest_status",
    }.items()
}
ORACLE["stream_until_sentinel_any_order"] = ORACLE["stream_until_sentinel"]
ORACLE["stream_run_timeouts"] = _with(_MESSAGES) + """
        select job_name, job_instance, started,
          case when ended <= due then ended else due end as ended,
          case when ended <= due then status else 'TIMEOUT' end as outcome
        from (select job_name, job_instance, min(sent) as started, min(sent) + interval 180 minute as due,
                min(sent) filter (where body in ('purchase', 'error')) as ended,
                arg_min(case body when 'purchase' then 'SUCCEEDED' else 'FAILED' end, (sent, seq))
                  filter (where body in ('purchase', 'error')) as status
              from messages group by job_name, job_instance)
        where epoch_ms(due) < (select epoch_ms(max(sent)) from messages)"""
