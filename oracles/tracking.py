"""SQL for the run, job and query reports, over tables derived from ``events``."""

from __future__ import annotations

BASE = """
    job as (
      select user_id as id, 1 + user_id % 5 as run,
             case user_id % 3 when 0 then concat('load', cast(user_id as varchar))
                              when 1 then 'single-user-stream' else 'multi-user-stream' end as name,
             min(ts) as start, cast(sum(cast(value as decimal(12,2))) as double) as duration,
             case when user_id % 3 = 0 then cast(user_id + 1 as int) end as step_lo,
             case when user_id % 3 = 0 then cast(user_id + 3 as int) end as step_hi
      from events group by user_id),
    run as (
      select distinct run as id, concat('run_', cast(run as varchar)) as name,
             concat('sys_', cast(run % 3 as varchar)) as system, 'full' as schedule from job),
    query as (
      select event_id as id, user_id as job, event_type as name, value as duration
      from events where user_id % 3 <> 0),
    results as (
      select r.name as run, r.system, r.schedule, j.name as job,
             row_number() over (partition by r.id order by j.id) as job_number,
             j.start, j.duration,
             case when step_lo is not null
                  then concat(cast(step_lo as varchar), '..', cast(step_hi as varchar)) end as steps,
             greatest(1, (select count(*) from query q where q.job = j.id)) as count
      from job j join run r on r.id = j.run)
"""

SECONDS = "cast(sum(cast(q.duration as decimal(12,2))) as double)"


def _with(body: str, extra: str = "") -> str:
    return f"with {BASE}{', ' + extra if extra else ''} {body}"


def timings(condition: str) -> str:
    levels = {"median": 0.5, "90%": 0.9, "95%": 0.95, "98%": 0.98, "99%": 0.99}
    spread = ", ".join(
        f'round(quantile_cont(q.duration, {p}), 6) as "{n}"' for n, p in levels.items())
    return _with(f"""
        select r.name as run, r.system, s.sf, j.name as jobname, q.name as query,
               count(*) as count, {SECONDS} / count(*) as average, {spread}
        from query q join job j on q.job = j.id join run r on r.id = j.run
             join scales s on s.id = j.id
        group by r.name, r.system, s.sf, j.id, j.name, q.name""", f"""
        scales as (
          select a.id, arg_max(b.step_hi, b.id) as sf
          from job a left join job b on b.id < a.id and b.step_hi is not null {condition}
          group by a.id)""")


def tracking() -> dict[str, str]:
    return {
        "track_results": _with("select * from results"),
        "track_qpm": _with(f"""
            select r.name as run, r.system, j.name as job, j.step_hi as sf, j.duration,
                   case when j.step_hi is null then {SECONDS} / count(q.id) end as qtime,
                   count(q.id) as queries,
                   round(cast(count(q.id) as double) / nullif({SECONDS}, 0) * 60, 4) as qpm
            from job j join run r on r.id = j.run left join query q on q.job = j.id
            where j.step_hi is not null or regexp_matches(j.name, 'stream')
            group by r.name, r.system, j.id, j.name, j.step_hi, j.duration"""),
        "track_query_timings": timings(""),
        "track_query_timings_per_run": timings("and b.run = a.run"),
        "asof_latest_load": _with("""
            select a.id, a.run, arg_max(b.step_hi, b.id) as sf
            from job a left join job b on b.id < a.id and b.step_hi is not null
            group by a.id, a.run"""),
        "track_run_report": _with("""
            select run, system, job, job_number, duration, steps, count from results"""),
        "track_run_summary": _with("""
            select run, system, max(job_number) as current_job_number,
                   arg_max(job, job_number) as current_job,
                   cast(sum(cast(duration as decimal(18,2))) as double) as total_duration,
                   max(steps) as step, cast(sum(count) filter (count > 1) as bigint) as queries
            from results group by run, system"""),
        "track_count_by_system": _with(
            "select run, system, count(*) as count from results group by run, system"),
        "track_delete_run": _with("""
            select 'run' as table_name, count(*) as rows, cast(sum(id) as bigint) as id_sum
              from run where name <> 'run_2'
            union all select 'job', count(*), cast(sum(id) as bigint) from job
              where run not in (select id from run where name = 'run_2')
            union all select 'query', count(*), cast(sum(id) as bigint) from query
              where job not in (select j.id from job j join run r on r.id = j.run
                                where r.name = 'run_2')"""),
        "track_merge": _with("""
            select 'run' as table_name, id, cast(null as bigint) as parent, name from run
            union all select 'run', id + (select max(id) + 1 - min(id) from run), null, name from run
            union all select 'job', id, run, name from job
            union all select 'job', id + (select max(id) + 1 - min(id) from job),
                             run + (select max(id) + 1 - min(id) from run), name from job
            union all select 'query', id, job, name from query
            union all select 'query', id + (select max(id) + 1 - min(id) from query),
                             job + (select max(id) + 1 - min(id) from job), name from query"""),
        "track_upsert_duration": _with(f"""
            select j.id, j.name, coalesce({SECONDS}, j.duration) as duration
            from job j left join query q on q.job = j.id group by j.id, j.name, j.duration"""),
        "extract_query_timings": """
            select cast(user_id as varchar) as log, event_type as name,
                   concat(cast(arg_max(value, event_id) as varchar), ' ms') as timing
            from events where user_id % 3 <> 0 group by user_id, event_type""",
        "track_register": """
            select cast(user_id as varchar) as log, event_type as name,
                   cast(arg_max(value, event_id) as double) / 1000 as duration
            from events where user_id % 3 <> 0 group by user_id, event_type""",
        "check_tracking": _with("""
            select 'run_name_system_unique' as check_name, count(*) as violations from run
            union all select unnest(['run_id_unique', 'job_id_unique', 'query_id_unique', 'run_not_null',
                                     'job_not_null', 'query_not_null', 'job_run_known', 'query_job_known']), 0"""),
        "throughput": _with("""
            select j.id as job_id, j.name as job, cast(max(n) as bigint) as streams,
                   cast(sum(n) as bigint) as queries, j.duration,
                   round(cast(max(n) as double) / j.duration * 60, 6) as streams_per_minute,
                   round(cast(sum(n) as double) / j.duration * 60, 6) as queries_per_minute
            from job j join (select job, name, count(*) as n from query group by all) q on q.job = j.id
            where step_lo is null group by j.id, j.name, j.duration"""),
    }
