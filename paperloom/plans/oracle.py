"""The SQL that the core queries are held against."""

from __future__ import annotations

from paperloom.plans.queries import _FAMILIES

_P5_SIDE = "select distinct package_name, location, para_index, accepted, rejected, has_tracked_changes from paragraph where copy_no = {0}"
P5 = f"""with a as ({_P5_SIDE.format(1)}), b as ({_P5_SIDE.format(2)}),
j as (select coalesce(a.package_name, b.package_name) as package_name, coalesce(a.location, b.location) as location, coalesce(a.para_index, b.para_index) as para_index, a.package_name is null as no_a, b.package_name is null as no_b,
  a.accepted is distinct from b.accepted as d1, a.rejected is distinct from b.rejected as d2, a.has_tracked_changes is distinct from b.has_tracked_changes as d3
  from a full join b on a.package_name = b.package_name and a.location = b.location and a.para_index = b.para_index),
r as (select distinct package_name, location, index1, index2, text1, text2 from paragraph_diff)
select package_name, location, para_index, 'row' as field_name, case when no_b then 'only_first' else 'only_second' end as state from j where no_a or no_b
union select package_name, location, para_index, 'accepted', 'differs' from j where not no_a and not no_b and d1
union select package_name, location, para_index, 'rejected', 'differs' from j where not no_a and not no_b and d2
union select package_name, location, para_index, 'has_tracked_changes', 'differs' from j where not no_a and not no_b and d3
union select r.package_name, r.location, index1, 'text1', case when a.package_name is null then 'only_report' else 'differs' end from r left join a on r.package_name = a.package_name and r.location = a.location and r.index1 = a.para_index
  where index1 is not null and (a.package_name is null or text1 is distinct from accepted)
union select r.package_name, r.location, index2, 'text2', case when b.package_name is null then 'only_report' else 'differs' end from r left join b on r.package_name = b.package_name and r.location = b.location and r.index2 = b.para_index
  where index2 is not null and (b.package_name is null or text2 is distinct from accepted)"""

# The forms of a date with the groups of each as year, first, second, hour, minute, second, fraction, half, zone, in
# patterns of their own. Wall times that occur twice are moved to the earlier of the two instants.
_MON = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_TIME, _TAIL = "([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,9}))?)?", "[ ]*(z|[+-][0-9]{2}(?::?[0-9]{2})?|[a-z]{3,4}|\\[[a-z0-9_+/-]+\\]|[a-z_]+(?:/[a-z0-9_+-]+)+)?"
_FORMS = {
    "([0-9]{4})-([0-9]{2})-([0-9]{2})[t ][ ]*" + _TIME + _TAIL: r"\1|\2|\3|\4|\5|\6|\7||\8",
    "([0-9]{4})([0-9]{2})([0-9]{2})t([0-9]{2})([0-9]{2})([0-9]{2})(?:[.,]([0-9]{1,9}))?" + _TAIL: r"\1|\2|\3|\4|\5|\6|\7||\8",
    "([0-9]{1,2})[.]([0-9]{1,2})[.]([0-9]{4}|[0-9]{2}),? +" + _TIME + _TAIL: r"\3|\2|\1|\4|\5|\6|\7||\8",
    "([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2}),? +" + _TIME + "(?: *([ap])[.]?m[.]?)?" + _TAIL: r"\3|\1|\2|\4|\5|\6|\7|\8|\9",
    f"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +)?({_MON})[.]? +([0-9]{{1,2}}),? +([0-9]{{4}}),? +" + _TIME + "(?: *([ap])[.]?m[.]?)?" + _TAIL: r"\3|\1|\2|\4|\5|\6|\7|\8|\9",
    f"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +)?([0-9]{{1,2}})[ -]({_MON})[.]?[ -]([0-9]{{4}}|[0-9]{{2}}),? +" + _TIME + "(?: *([ap])[.]?m[.]?)?" + _TAIL: r"\3|\2|\1|\4|\5|\6|\7|\8|\9",
}
P3 = f"""with r as (select distinct 'tracked_change' as table_name, change_id as record_id, author, change_date as stored from tracked_change union select distinct 'review_comment', comment_key, author, comment_date from review_comment),
l as (select author, any_value(zone_name) as zn, upper(any_value(date_order)) as dord from author_locale group by 1),
s as (select r.*, zn, dord, lower(regexp_replace(stored, '^\\s+|\\s+$', '', 'g')) as s from r left join l on r.author = l.author),
f as (select *, string_split(case {' '.join(f"when regexp_matches(s, '^{k}$') then regexp_replace(s, '^{k}$', '{v}')" for k, v in _FORMS.items())} end, '|') as e from s),
g as (select *, try_cast(e[1] as int) + case when length(e[1]) = 2 then 2000 else 0 end as y, contains(s, '/') and regexp_matches(s, '^[0-9]{{1,2}}/') as slashed,
  coalesce(try_cast(e[2] as int), list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], e[2][:3])) as a, try_cast(e[3] as int) as b, try_cast(e[4] as int) as h0, e[8] as half, nullif(e[9], '') as z from f),
m as (select *, case when slashed and dord = 'DMY' then b else a end as mo, case when slashed and dord = 'DMY' then a else b end as d, case when half = '' then h0 when h0 between 1 and 12 then h0 % 12 + case half when 'p' then 12 else 0 end end as h from g),
w as (select *, case when h between 0 and 23 and (not slashed or dord in ('DMY', 'MDY')) then try_cast(printf('%04d-%02d-%02d %02d:%s:%s', y, mo, d, h, e[5], case when e[6] = '' then '00' else e[6] end) as timestamp) end as wall,
  rpad(e[7], 6, '0')[:6]::bigint as us, case when regexp_matches(s, '^([0-9]{{10}}|[0-9]{{13}}|[0-9]{{16}})$') then s::bigint * (case length(s) when 10 then 1000000 when 13 then 1000 else 1 end) end as epoch,
  case replace(replace(z, '[', ''), ']', '') when 'utc' then 0 when 'gmt' then 0 when 'z' then 0 when 'est' then -300 when 'edt' then -240 when 'pst' then -480 when 'pdt' then -420 when 'cet' then 60 when 'cest' then 120 end as named,
  case when regexp_matches(z, '^[+-][0-9]{{2}}(:?[0-9]{{2}})?$') then (case z[1] when '-' then -1 else 1 end) * (z[2:3]::int * 60 + case when length(z) > 3 then right(z, 2)::int else 0 end) end as num from m),
k as (select w.*, coalesce(num, named) as off, t.name from w left join pg_timezone_names() t on lower(t.name) = case when z is null then lower(zn) when contains(z, '/') or z[1] = '[' then replace(replace(z, '[', ''), ']', '') end),
c as (select *, case when off is null and name is not null and wall is not null then timezone(name, wall) end as late from k),
i as (select *, case when epoch is not null then epoch when wall is null then null when off is not null then epoch_us(wall) + coalesce(us, 0) - off * 60000000::bigint
  when late is not null then epoch_us(case when timezone(name, late - interval 1 hour) = wall then late - interval 1 hour when timezone(name, late - interval 30 minute) = wall then late - interval 30 minute else late end) + coalesce(us, 0) end as utc_micros,
  case when epoch is not null then 'epoch' when wall is null then null when off is not null then 'offset' when late is null then null when timezone(name, late) <> wall then 'skipped'
    when timezone(name, late - interval 1 hour) = wall or timezone(name, late - interval 30 minute) = wall then 'ambiguous' else 'single' end as kind from c)
"""

SQL: dict[str, str] = {
    "p3_dates": P3 + "select table_name, record_id, stored, utc_micros, kind from i",
    "p3_found": P3 + r"select table_name, record_id, utc_micros from i where utc_micros is not null and not regexp_matches(stored, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$')",
    "p5_found": P5,
    **{name: text for family in _FAMILIES for name, text in family.sql.items()},
}
