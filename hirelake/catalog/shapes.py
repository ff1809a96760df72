"""The given tables in the forms the jobs read. Same text for Spark SQL and DuckDB;
`{orders}` and the like stand for the tables."""

SHAPES = {
    # (source, page_no, n_links): stop rules, resume, counters
    "listing_pages": """
select source, page_no, case when page_no % 17 = 16 then 0 else count(*) end as n_links
from (select case when o_orderstatus = 'O' then 'alpha' when o_orderstatus = 'F' then 'beta' else 'gamma' end as source,
             cast(floor(o_orderkey / 200) as bigint) + 1 as page_no from {orders}) t
group by source, page_no""",
    # relative ages; as_of is the event time
    "posted_text": """
select event_id as id, ts as as_of, case event_id % 11
  when 0 then 'Posted: just now' when 1 then 'Posted: Today'
  when 2 then concat('Posted: ', cast(1 + user_id % 12 as string), ' hours ago')
  when 3 then 'Posted: yesterday' when 4 then 'Posted: a month ago'
  when 5 then concat('Posted: ', cast(2 + user_id % 5 as string), ' months ago')
  when 6 then 'Posted: 30+ days ago'
  when 7 then concat('Posted: ', cast(1 + user_id % 29 as string), ' days ago')
  when 8 then concat('Posted ', cast(1 + user_id % 3 as string), ' weeks ago')
  when 9 then concat('Posted ', cast(1 + user_id % 29 as string), '+ Days Ago')
  else null end as posted
from {events}""",
    "slash_dates": """
select o_orderkey as id, case when o_orderstatus = 'P' then '' else
  concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/', cast(year(o_orderdate) as string)) end as posted
from {orders}""",
    "pay_and_experience": """
select p_partkey as id,
  case p_partkey % 4 when 0 then 'Fresher' when 1 then concat(cast(p_size as string), '-', cast(p_size + 3 as string), ' years')
    when 2 then concat(cast(p_size as string), ' - ', cast(p_size + 3 as string), ' Years') else concat(cast(p_size as string), '+ years') end as experience,
  case p_partkey % 5 when 0 then 'Not Specified' when 1 then concat(cast(p_size as string), ',000-', cast(p_size + 9 as string), ',000')
    when 2 then concat(cast(p_size as string), ',500 - ', cast(p_size + 9 as string), ',500 ') when 3 then concat(cast(p_size as string), ',000 SGD')
    else concat(cast(p_size as string), '000-', cast(p_size + 9 as string), '000') end as salary,
  case p_partkey % 3 when 0 then 'Permanent Job' when 1 then 'Contract' else 'permanent, full time' end as employment_type
from {part}""",
    "cards": """
select concat('https://jobs.example.com/j/', cast(o_orderkey as string)) as job_url,
  concat('  ', o_orderpriority, ' ') as industry,
  case when o_orderkey % 40 = 0 then cast(o_orderkey as string)
       else concat('Clerk ', o_orderstatus, ' ', cast(o_orderkey as string)) end as label
from {orders}""",
    # some postings have no detail page, some pages lack elements
    "details": """
select concat('https://jobs.example.com/j/', cast(o.o_orderkey as string)) as job_url,
  case when o.o_orderkey % 7 = 0 then null else n.n_name end as location,
  case when o.o_orderkey % 11 = 0 then null else c.c_name end as description,
  case when o.o_orderkey % 13 = 0 then null else concat('/apply/', cast(o.o_orderkey as string)) end as apply_url
from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
where o.o_orderpriority <> '5-LOW'""",
    "job_api": """
select c_custkey as id, concat('{{"jobs":[{{"data":{{"slug":"', cast(c_custkey as string), '","title":"', c_name,
  '","state":"', r_name, '","city":"', n_name, '","country":"', n_name, '","country_code":"', cast(n_nationkey as string), '"',
  case when c_custkey % 10 = 0 then '' else concat(',"postal_code":"', cast(c_custkey % 1000 as string), '"') end,
  ',"description":"<p>Work at&nbsp;', n_name, '<br>for ', c_mktsegment, ' &amp; more</p><script>x()</script>"',
  ',"create_date":"2021-0', cast(1 + c_custkey % 9 as string), '-11T08:00:00+0000","apply_url":"https://apply.example.com/', cast(c_custkey as string),
  '","experience_levels":"Entry Level","employment_type":"FULL_TIME","industry":"', c_mktsegment,
  '","meta_data":{{"googlejobs":{{"derivedInfo":{{"jobCategories":["', c_mktsegment, '","', r_name, '"]}}}}}}}}}}]}}') as body,
  c_name, n_name, r_name, c_mktsegment, n_nationkey
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "paging_api": """
select event_id as id, concat('{{"body":{{"children":[{{"children":[{{"listItems":[{{"title":{{"commandLink":"/job/', cast(event_id as string),
  '"}}}},{{"title":{{"commandLink":"/job/', cast(event_id + 1 as string), '"}}}}]}}]}}]}}}}') as body
from {events}""",
    # '~' stands between parts
    "text_lists": """
select p_partkey as id,
  concat('a~b~', p_name, '~', p_brand, case when p_partkey % 3 = 0 then '' else concat('~', p_type, '~', cast(p_size as string)) end) as parts,
  concat(p_name, chr(160), '12~ ~', p_type, '~', p_brand, chr(160)) as skills,
  concat('<li><svg class="i"><use/></svg> ', case when p_partkey % 2 = 0 then concat('<span>', p_type, '</span>') else p_type end, ' </li>') as icon_item,
  case when p_partkey % 2 = 0 then concat('City~', p_type, '~Full time') else concat('City~', cast(p_size as string), '~', p_type, '~Part time') end as layout
from {part}""",
    "detail_rows": """
select c_custkey as id, 1 as seq, 'Job Location' as key, cast(c_nationkey as string) as value from {customer}
union all select c_custkey, 2, 'Industry', c_mktsegment from {customer} where c_acctbal > 2000
union all select c_custkey, 3, 'Key Skills', c_name from {customer} where c_mktsegment <> 'BUILDING'
union all select c_custkey, 4, 'Function', c_mktsegment from {customer} where c_acctbal < 5000
union all select c_custkey, 5, 'Work Location', 'Remote' from {customer} where c_mktsegment = 'MACHINERY'""",
    "titles": """
select p_partkey as id, concat('Co-op ', p_name, ' - ', p_brand, ' (', p_type, ')') as title,
  case when p_partkey % 6 = 0 then 'Nowhere' else concat(p_brand, ' (', p_type, ')') end as location
from {part}""",
    "badges": """
select o_orderkey as id, case when o_orderkey % 3 = 0 then null else concat('Job Id: ', cast(o_orderkey as string)) end as badge4,
  case when o_orderkey % 4 = 0 then 'Ref: n/a' else concat('Ref: ', cast(o_custkey as string)) end as badge3,
  case when o_orderkey % 5 = 0 then concat(' Showing jobs of ', cast(o_custkey as string), ',000 ')
       when o_orderkey % 5 = 1 then ' No jobs ' else concat(' Showing jobs of ', cast(o_orderkey as string), ' ') end as heading
from {orders}""",
    "fetch_log": """
select concat('https://jobs.example.com/j/', cast(user_id as string)) as url, event_id, ts,
  case when user_id % 3 = 0 then 'alpha' else 'beta' end as source,
  cast(case event_type when 'error' then 503 when 'click' then 200 else null end as int) as status,
  case event_type when 'error' then 'HttpError' when 'signup' then 'DNSLookupError' when 'purchase' then 'TCPTimedOutError'
    when 'view' then 'ConnectionRefusedError' else null end as error
from {events}""",
    "source_a": """
select cast(c_custkey as string) as JobID, c_name as Title, c_mktsegment as EmploymentIndustry, 'alpha' as Source from {customer}""",
    "source_b": """
select cast(s_suppkey as string) as JobID, s_name as JobTitle, concat('/apply/', cast(s_suppkey as string)) as JobApplyLink, 'beta' as Source from {supplier}""",
    "source_c": """
select cast(p_partkey as string) as JobID, p_name as Title, concat('/jobs/', cast(p_partkey as string)) as JobLink, p_type as Description from {part}""",
}
