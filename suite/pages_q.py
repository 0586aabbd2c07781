"""Extraction, listing, seeding and text queries over the page and conversation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import testbed as tb
from suite.registry import register
from vacancia.functions.text import archive_slug, html_to_text, keyword_slug
from vacancia.operators import extract, frontier as fr, listing
from vacancia.operators.frontier_store import FrontierStore
from vacancia.plans import loader, reports
from vacancia.schemas import JOB_TABLE, KEY
from vacancia.session import work_dir

P = "page_id"
LD = "<script type=\"application/ld+json\">"


def as_of():
    return F.lit(tb.AS_OF_EVENTS).cast("timestamp")


# ------------------------------------------------------------------ pages with a generated block
# Block texts are Spark SQL over page_id; the expected fields are written from
# page_id directly, so the checking SQL does not repeat the parsing.

_DATES = f"'\"datePosted\":\"2024-01-02\",\"validThrough\":\"' || case when {P} % 3 = 0 then '2024-03-01T00:00:00Z' else '2024-01-15' end || '\"'"
_ORG = f"'\"hiringOrganization\":{{\"name\":\"Co ' || {P} % 7 || '\",\"logo\":\"https://l.example.com/' || {P} || '.png\",\"description\":\"We build\"}}'"
_PAY = (
    f"case {P} % 4 when 0 then '\"baseSalary\":{{\"currency\":\"VND\",\"value\":{{\"value\":\"Negotiable\"}}}}' "
    f"when 1 then '\"baseSalary\":{{\"currency\":\"USD\",\"value\":{{\"value\":\" 1k - 2k \",\"minValue\":' || (1000 + {P}) || ',\"maxValue\":\"' || (2000 + {P}) || '\"}}}}' "
    f"when 2 then '\"baseSalary\":{{\"currency\":\"VND\",\"value\":{{\"value\":5,\"minValue\":\"abc\",\"maxValue\":9}}}}' "
    f"else '\"industry\":\"\"' end"
)
_TEXT = f"'\"description\":\"<p>Line ' || {P} || ' &amp; <b>more</b></p><ul><li>one</li><li>two</li></ul>\"'"
_SKILLS = "'\"skills\":\"Python, SQL ,, Go \"'"
_MONTHS = f"'\"experienceRequirements\":{{\"monthsOfExperience\":' || ({P} * 5 % 60) || ',\"description\":\"Kinh nghiem 3 nam\"}}'"
_PLACE = "'{\"address\":{\"addressRegion\":\"Hanoi\",\"addressLocality\":\"Cau Giay\",\"streetAddress\":\"1 Main St\"}}'"


def _posting(place: str, extra: str) -> str:
    return (
        f"'{{\"@type\":\"JobPosting\",\"title\":\"Engineer ' || {P} || '\",' || {_DATES} || ',' || {_ORG} || ',' || {_PAY} || ',' || {_TEXT} || ',' || "
        f"{_SKILLS} || ',' || {_MONTHS} || ',\"employmentType\":\"FULL_TIME\",\"jobLocation\":' || {place} || {extra} || '}}'"
    )


_ITVIEC = _posting(f"'[' || {_PLACE} || ',{{\"address\":\"nowhere\"}}]'", "',\"potentialAction\":{\"target\":\"https://itviec.com/x/' || page_id || '/job_applications/new\"}'")
_TOPCV = _posting(f"case when {P} % 2 = 0 then {_PLACE} else '[' || {_PLACE} || ']' end", "''")
_CAREER = (
    f"'{{\"@type\":\"JobPosting\",\"title\":\"Engineer ' || {P} || '\",' || {_DATES} || ',' || {_ORG} || ',' || "
    f"case {P} % 4 when 0 then '\"baseSalary\":{{\"currency\":\"VND\",\"value\":{{\"value\":\"Canh tranh\"}}}}' "
    f"when 1 then '\"baseSalary\":{{\"currency\":\"VND\",\"value\":{{\"minValue\":\"10,000,' || lpad(cast({P} % 1000 as string), 3, '0') || ' VND\",\"maxValue\":20000000}}}}' "
    f"when 2 then '\"baseSalary\":{{\"currency\":\"\",\"value\":{{\"value\":' || (500 + {P}) || '}}}}' else '\"x\":1' end || ',' || {_TEXT} || ',' || {_SKILLS} || ',' || {_MONTHS} || "
    f"',\"employmentType\":[\"\\\\\"FULL_TIME\\\\\"\"],\"workHours\":\" 8:00-17:00 \",\"industry\":\"IT , Data,\",\"jobBenefits\":\" Laptop \",\"url\":\"https://careerviet.vn/' || {P} || '\","
    f"\"identifier\":{{\"name\":\"Co\",\"value\":\"35c' || {P} || '\"}},\"jobLocation\":[{{\"address\":{{\"addressRegion\":\"Quan 7\",\"addressLocality\":\" Ho Chi Minh \",\"streetAddress\":\"12 A\"}}}},{{\"address\":{{}}}}]}}'"
)


def _page(json: str, arrays: bool = True) -> str:
    """A page: a foreign block, a broken block, then the posting (broken on every 10th page)."""
    body = f"case when {P} % 10 = 9 then substr({json}, 1, 60) " + (f"when {P} % 5 = 0 then '[{{\"@type\":\"Thing\"}},' || {json} || ']' " if arrays else "") + f"else {json} end"
    return (
        f"replace(html, '</head>', '{LD}{{\"@type\":\"WebSite\"}}</script>{LD}{{broken</script>"
        f"<link rel=\"canonical\" href=\"https://www.topcv.vn/viec-lam/job/' || {P} || '.html?ref=1\"/>{LD} ' || {body} || ' </script></head>')"
    )


def pages_with(json: str, arrays: bool = True):
    def build(s, d):
        tb.pin_utc(s)
        return tb.read(s, d, "pages").selectExpr(f"cast({P} as string) as key", f"{_page(json, arrays)} as html")
    return build


COMMON = ["source", "source_job_id", "source_url", "title", "company_name", "company_logo_url", "salary_min", "salary_max", "salary_currency",
          "is_salary_visible", "pretty_salary", "years_of_experience", "employment_type", "job_function", "locations", "skills", "industries",
          "benefits", "job_description_text", "posted_at", "expired_at", "is_expired", "is_active", "working_from_hour", "working_to_hour"]


def _shown(df, columns=COMMON):
    """Records, and a row that only says so for each page that gave none."""
    return df.select(*[F.when(~F.col("failed"), F.col(c)).alias(c) for c in columns], "failed")


def _with_failed(sql, failed):
    return f"select *, false failed from ({sql}) union all by name select true failed from pages where {failed}"


_BODY = f"'Line ' || {P} || ' & more' || chr(10) || '- one' || chr(10) || '- two'"
_LD_SHARED = f"""'Engineer ' || {P} title, 'Co ' || {P} % 7 company_name, 'https://l.example.com/' || {P} || '.png' company_logo_url,
  case when {P} % 4 = 1 then 1000.0 + {P} end::double salary_min, case when {P} % 4 = 1 then 2000.0 + {P} end::double salary_max,
  case {P} % 4 when 1 then 'USD' when 3 then null else 'VND' end salary_currency, {P} % 4 = 1 is_salary_visible,
  cast(greatest(1, ({P} * 5 % 60) // 12) as int) years_of_experience, 'FULL_TIME' employment_type, 'IT' job_function,
  '[{{"name":"Python"}},{{"name":"SQL"}},{{"name":"Go"}}]' skills, '[]' industries, '[]' benefits, {_BODY} job_description_text,
  '2024-01-02' posted_at, case when {P} % 3 = 0 then '2024-03-01T00:00:00Z' else '2024-01-15' end expired_at,
  {P} % 3 <> 0 is_expired, {P} % 3 = 0 is_active, null::varchar working_from_hour, null::varchar working_to_hour"""

register(
    "jobposting_itviec", lambda s, d: _shown(extract.jobposting_itviec(pages_with(_ITVIEC)(s, d), as_of())),
    _with_failed(f"""select 'itviec' source, cast({P} as varchar) source_job_id, 'https://itviec.com/x/' || {P} source_url,
      case {P} % 4 when 0 then 'Negotiable' when 1 then ' 1k - 2k ' end pretty_salary,
      '[{{"city":"Hanoi","city_vi":"Hanoi","address":"1 Main St"}}]' locations, {_LD_SHARED} from pages where {P} % 10 <> 9 and {P} % 5 <> 0""", f"{P} % 10 = 9 or {P} % 5 = 0"),
)
register(
    "jobposting_topcv", lambda s, d: _shown(extract.jobposting_topcv(pages_with(_TOPCV)(s, d), as_of())),
    _with_failed(f"""select 'topcv' source, cast({P} as varchar) source_job_id, 'https://www.topcv.vn/viec-lam/job/' || {P} || '.html' source_url,
      case when {P} % 4 = 1 then '1k - 2k' end pretty_salary,
      '[{{"city":"Hanoi","city_vi":"Hanoi","district":"Cau Giay","address":"1 Main St"}}]' locations, {_LD_SHARED} from pages where {P} % 10 <> 9""", f"{P} % 10 = 9"),
)
register(
    "jobposting_careerviet", lambda s, d: _shown(extract.jobposting_careerviet(pages_with(_CAREER)(s, d), as_of())),
    _with_failed(f"""select 'careerviet' source, '35C' || {P} source_job_id, 'https://careerviet.vn/' || {P} source_url, 'Engineer ' || {P} title, 'Co ' || {P} % 7 company_name,
      'https://l.example.com/' || {P} || '.png' company_logo_url,
      case {P} % 4 when 1 then 10000000.0 + {P} % 1000 when 2 then 500.0 + {P} end::double salary_min, case {P} % 4 when 1 then 20000000.0 when 2 then 500.0 + {P} end::double salary_max,
      case when {P} % 4 < 2 then 'VND' end salary_currency, {P} % 4 in (1, 2) is_salary_visible, case when {P} % 4 = 0 then 'Canh tranh' end pretty_salary,
      cast(case when {P} * 5 % 60 = 0 then 3 else ({P} * 5 % 60) // 12 end as int) years_of_experience, 'FULL_TIME' employment_type, null::varchar job_function,
      '[{{"city":"Ho Chi Minh","district":"Quan 7","address":"12 A","country":"VN"}}]' locations, '[]' skills, '[{{"name":"IT"}},{{"name":"Data"}}]' industries,
      '[{{"name":"Laptop"}}]' benefits, '<p>Line ' || {P} || ' &amp; <b>more</b></p><ul><li>one</li><li>two</li></ul>' job_description_text, '2024-01-02' posted_at,
      case when {P} % 3 = 0 then '2024-03-01T00:00:00Z' else '2024-01-15' end expired_at, false is_expired, null::boolean is_active, '8:00' working_from_hour, '17:00' working_to_hour
    from pages where {P} % 10 <> 9""", f"{P} % 10 = 9"),
)
register(
    "jsonld_parse_counters",
    lambda s, d: extract.jobposting_topcv(pages_with(_TOPCV)(s, d), as_of()).groupBy("failed").agg(F.count("*").alias("n")),
    f"select {P} % 10 = 9 as failed, count(*) n from pages group by 1",
)

# ------------------------------------------------------------------ class-anchored pages

_LI_PAY = f"""case {P} % 5 when 0 then '1,000,000 - 3,000,000 VND/month' when 1 then '₫1.000.000 - ₫3.000.000/tháng' when 2 then '$50 - $80/hr' when 3 then '$90000/yr' else '' end"""
_LI = (
    f"replace(html, '</head>', '</head>' || case when {P} % 10 = 9 then '' else '<h1 class=\"top-card-layout__title x\"> Engineer ' || {P} || ' </h1>' end || "
    f"'<a class=\"topcard__org-name-link y\">Co ' || {P} % 7 || '</a><span class=\"topcard__flavor--bullet\"> Hanoi, Vietnam </span>' || "
    "'<span class=\"description__job-criteria-text z\"> Associate </span><span class=\"description__job-criteria-text z\">Full-time</span>"
    "<span class=\"description__job-criteria-text z\">Engineering</span><span class=\"description__job-criteria-text z\">IT Services</span>' || "
    f"'<div class=\"salary-main-rail__data-body\"> ' || {_LI_PAY} || ' </div><span class=\"posted-time-ago__text t\"> ' || ({P} % 9) || ' ' || "
    f"{tb.nth('days ago|weeks ago|months ago|hours ago|moments', P + ' % 5')} || '</span><figcaption class=\"num-applicants__caption\">Over 1,' || lpad(cast({P} % 1000 as string), 3, '0') || ' applicants</figcaption>"
    f"<img class=\"artdeco-entity-image\" data-ghost-url=\"https://l.example.com/' || {P} || '.png\"/><div class=\"show-more-less-html__markup\"><p>Line ' || {P} || ' &amp; <b>more</b></p></div>')"
)
_LI_COLS = ["source", "source_job_id", "source_url", "title", "company_name", "company_logo_url", "salary_min", "salary_max", "salary_currency",
            "is_salary_visible", "salary_period_id", "job_level", "employment_type", "job_function", "industries", "locations", "job_description_text",
            "pretty_salary", "num_of_applications", "posted_at", "is_active"]


def _linkedin(s, d):
    tb.pin_utc(s)
    pages = tb.read(s, d, "pages").selectExpr(f"cast({P} as string) as key", f"{_LI} as html")
    return _shown(extract.jobposting_linkedin(pages, as_of()), _LI_COLS)


register(
    "jobposting_linkedin", _linkedin,
    _with_failed(f"""select 'linkedin' source, cast({P} as varchar) source_job_id, 'https://www.linkedin.com/jobs/view/' || {P} source_url, 'Engineer ' || {P} title,
      'Co ' || {P} % 7 company_name, 'https://l.example.com/' || {P} || '.png' company_logo_url,
      case {P} % 5 when 0 then 1000000.0 when 1 then 1000000.0 when 2 then 50.0 when 3 then 90000.0 end::double salary_min,
      case {P} % 5 when 0 then 3000000.0 when 1 then 3000000.0 when 2 then 80.0 when 3 then 90000.0 end::double salary_max,
      case when {P} % 5 < 2 then 'VND' when {P} % 5 < 4 then 'USD' end salary_currency, {P} % 5 < 4 is_salary_visible,
      cast(case {P} % 5 when 0 then 1 when 1 then 1 when 2 then 2 when 3 then 3 end as int) salary_period_id, 'Associate' job_level, 'Full-time' employment_type,
      'Engineering' job_function, '[{{"name":"IT Services"}}]' industries, '[{{"city":"Hanoi, Vietnam"}}]' locations, 'Line ' || {P} || ' & more' job_description_text,
      nullif({_LI_PAY}, '') pretty_salary, cast(1000 + {P} % 1000 as int) num_of_applications,
      strftime(timestamp '{tb.AS_OF_EVENTS}' - ({P} % 9) * case {P} % 5 when 0 then interval 1 day when 1 then interval 7 day when 2 then interval 30 day when 3 then interval 1 hour else interval 0 day end, '%Y-%m-%dT%H:%M:%SZ') posted_at,
      true is_active from pages where {P} % 10 <> 9""", f"{P} % 10 = 9"),
)

# ------------------------------------------------------------------ pushed chunks and decoded objects

_RSC = (
    f"html || '<script>self.__next_f.push([1,\"{{\\\\\"jobTitle\\\\\":\\\\\"Dev \\\\u00e9 ' || {P} || '\\\\\",\\\\\"salaryMin\\\\\":' || ({P} * 10) || ',\\\\\"isX\\\\\":true\"])</script>"
    f"<script>self.__next_f.push([1,\"\\\\\"companyName\\\\\":\\\\\"Co ' || {P} % 7 || '\\\\\",\\\\\"jobLevel\\\\\":' || case {P} % 4 when 0 then 'null' else '\\\\\"L' || {P} % 4 || '\\\\\"' end || ',\\\\\"numOfViews\\\\\":' || ({P} % 50) || ',\\\\\"salaryMax\\\\\":99.5,\\\\\"expiredOn\\\\\":\\\\\"2024-02-0' || ({P} % 9 + 1) || '\\\\\"}}\"])</script>'"
)


def _rsc_rows(s, d):
    pages = tb.read(s, d, "pages").selectExpr(f"cast({P} as string) as key", f"{_RSC} as html")
    return extract.rsc_scalar_fields(pages)


tb.cte("rsc", [], f"""select cast({P} as varchar) job_id, 'Dev é ' || {P} title, 'Co ' || {P} % 7 company, case when {P} % 4 > 0 then 'L' || {P} % 4 end as level, ({P} * 10)::double salary_min,
  99.5::double salary_max, '2024-02-0' || ({P} % 9 + 1) expires, ({P} % 50)::bigint as views, null::bigint applications from pages""")
register("rsc_scalar_fields", _rsc_rows, tb.sql("select * from rsc", "rsc"))
register("profile_crawled", lambda s, d: reports.profile_summary(_rsc_rows(s, d)),
         tb.sql("select count(*) total, count(title) titles, count(company) companies, count(*) filter (where salary_min <> 0) salary_visible, count(views) views_present, count(distinct company) unique_companies from rsc", "rsc"))
register("profile_top_companies", lambda s, d: reports.value_counts(_rsc_rows(s, d), "company", 5),
         tb.sql("select company, count(*) n from rsc group by 1 order by n desc, company limit 5", "rsc"))
register("profile_levels", lambda s, d: reports.value_counts(_rsc_rows(s, d), "level", 10),
         tb.sql("select level, count(*) n from rsc where level is not null group by 1 order by n desc, level limit 10", "rsc"))
register("profile_most_viewed", lambda s, d: reports.most_viewed(_rsc_rows(s, d), 5),
         tb.sql("select job_id, title, views, coalesce(applications, 0) applications from rsc where views > 0 order by views desc, job_id limit 5", "rsc"))

_MAIN = (
    "'{\"jobId\":' || o_orderkey || ',\"alias\":\"dev-' || o_custkey || '\",\"jobTitle\":\"Dev ' || o_custkey || '\",\"companyId\":' || o_custkey || "
    "',\"companyName\":\"Co\",\"salaryMin\":' || case when o_orderkey % 3 = 0 then '0' else cast(o_orderkey as string) end || ',\"salaryMax\":' || case when o_orderkey % 3 = 0 then 'null' else cast(o_orderkey + 5 as string) end || "
    "',\"isSalaryVisible\":true,\"salaryCurrency\":\"\",\"currency\":\"VND\",\"jobLevel\":\"\",\"jobLevelVI\":\"Senior\",\"yearOfExperience\":' || o_orderkey % 3 || ',\"typeWorkingId\":1,"
    "\"jobFunction\":{\"parentId\":5,\"children\":[{\"id\":' || o_orderkey % 9 || ',\"name\":\"Data\"}]},\"workingLocations\":[{\"cityName\":\"Hanoi\",\"cityNameVI\":\"HN\",\"address\":\"A\",\"cityId\":24,\"districtId\":3},7],"
    "\"industries\":[],\"industriesV3\":[{\"industryId\":35,\"industryName\":\"IT\",\"industryNameVI\":\"CNTT\"}],\"skills\":[{\"skillId\":1,\"skillName\":\"SQL\",\"skillWeight\":100}],"
    "\"benefits\":[{\"benefitType\":\"bonus\",\"benefitValue\":\"13th\",\"benefitId\":2}],\"jobDescription\":\"<p>D &amp; D</p>\",\"approvedOn\":\"\",\"createdOn\":\"2024-01-02\",\"isExpired\":false,\"numOfViews\":' || o_custkey || ',\"requiredResume\":1,\"isActive\":true}'"
)
_VNW_COLS = ["source_job_id", "source_url", "title", "company_id", "salary_min", "salary_max", "salary_currency", "is_salary_visible", "job_level",
             "years_of_experience", "employment_type", "job_function", "locations", "industries", "skills", "benefits", "job_description_text",
             "posted_at", "is_expired", "num_of_views", "required_resume", "is_active", "services"]
register(
    "vnw_record_map",
    lambda s, d: extract.vnw_record_map(tb.pin_utc(s) and tb.read(s, d, "orders").selectExpr("cast(o_orderkey as string) as key", f"{_MAIN} as main_json"), as_of()).select(*_VNW_COLS),
    """select cast(o_orderkey as varchar) source_job_id, 'https://www.vietnamworks.com/dev-' || o_custkey || '-' || o_orderkey || '-jv' source_url, 'Dev ' || o_custkey title,
      o_custkey company_id, case when o_orderkey % 3 <> 0 then o_orderkey end::double salary_min, case when o_orderkey % 3 <> 0 then o_orderkey + 5 end::double salary_max,
      'VND' salary_currency, o_orderkey % 3 <> 0 is_salary_visible, 'Senior' job_level, case when o_orderkey % 3 > 0 then cast(o_orderkey % 3 as int) end years_of_experience,
      '1' employment_type, '{"children":[{"id":' || o_orderkey % 9 || ',"name":"Data"}],"parentId":5}' job_function,
      '[{"city":"Hanoi","city_vi":"HN","address":"A","city_id":24,"district_id":3}]' locations, '[{"id":35,"name":"IT","name_vi":"CNTT"}]' industries,
      '[{"id":1,"name":"SQL","weight":100}]' skills, '[{"type":"bonus","value":"13th","id":2}]' benefits, 'D & D' job_description_text, '2024-01-02' posted_at,
      false is_expired, cast(o_custkey as int) num_of_views, true required_resume, true is_active, '[]' services from orders""",
)


def _pages_twice(s, d, block):
    """Pages of a board, every fourth one again with another title."""
    first = tb.read(s, d, "pages").selectExpr(f"cast({P} as string) as key", f"{block} as html", "1 as arrival", P)
    return first.unionByName(first.filter(f"{P} % 4 = 0").withColumns({"html": F.expr("replace(html, 'Engineer ', 'Engineer v2 ')"), "arrival": F.lit(2)})).drop(P)


def _parse_and_load(s, d):
    """Pages of all boards in, the table read back with the counters beside it."""
    tb.pin_utc(s)
    boards = {
        "itviec": _pages_twice(s, d, f"replace({_page(_ITVIEC)}, '\"name\":\"Co 3\"', '\"name\":\"\"')"), "topcv": _pages_twice(s, d, _page(_TOPCV)),
        "careerviet": _pages_twice(s, d, _page(_CAREER)), "linkedin": _pages_twice(s, d, _LI),
        "vietnamworks": tb.read(s, d, "orders").selectExpr(
            "cast(o_orderkey as string) as key", "1 as arrival",
            f"replace({_MAIN}, '\"companyName\":\"Co\"', case when o_orderkey % 7 = 0 then '\"companyName\":\"\"' else '\"companyName\":\"Co\"' end) as main_json"),
    }
    target = work_dir(s, "parse-and-load")
    counters = loader.parse_and_load_batch(s, boards, target, as_of(), 4)
    return s.read.schema(JOB_TABLE).parquet(target).select(
        *KEY, "title", "company_name", "is_salary_visible", "loaded_at", *[F.lit(v).cast("bigint").alias(k) for k, v in counters.items()]
    )


_ARRIVALS = f"(select *, unnest(case when {P} % 4 = 0 then [1, 2] else [1] end) arrival from pages where {P} % 10 <> 9)"
_TITLE = f"case arrival when 1 then 'Engineer ' else 'Engineer v2 ' end || {P}"
tb.cte("paged", [], f"""select 'itviec' source, cast({P} as varchar) source_job_id, {_TITLE} title, case when {P} % 7 = 3 then '' else 'Co ' || {P} % 7 end company_name, {P} % 4 = 1 visible, arrival from {_ARRIVALS} where {P} % 5 <> 0
  union all select 'topcv', cast({P} as varchar), {_TITLE}, 'Co ' || {P} % 7, {P} % 4 = 1, arrival from {_ARRIVALS}
  union all select 'careerviet', '35C' || {P}, {_TITLE}, 'Co ' || {P} % 7, {P} % 4 in (1, 2), arrival from {_ARRIVALS}
  union all select 'linkedin', cast({P} as varchar), {_TITLE}, 'Co ' || {P} % 7, {P} % 5 < 4, arrival from {_ARRIVALS}
  union all select 'vietnamworks', cast(o_orderkey as varchar), 'Dev ' || o_custkey, case when o_orderkey % 7 = 0 then '' else 'Co' end, o_orderkey % 3 <> 0, 1 from orders""")
register(
    "parse_and_load_batch", _parse_and_load,
    tb.sql(f"""select source, source_job_id, arg_max(title, arrival) title, any_value(company_name) company_name, any_value(visible) is_salary_visible, timestamp '{tb.AS_OF_EVENTS}' loaded_at,
      (select count(*) from paged) parsed, (select count(*) from paged where company_name <> '') as valid, (select count(*) from paged where company_name = '') rejected,
      (select count(*) from (select distinct source, source_job_id from paged where company_name <> '')) loaded from paged where company_name <> '' group by source, source_job_id""", "paged"),
)
register(
    "post_to_record",
    lambda s, d: extract.post_to_record(
        tb.read(s, d, "conversations").selectExpr(
            "case when turn % 3 = 0 then '' else conv_id || '-' || turn end as id", "case when turn % 4 = 0 then '  ' else text end as text",
            "'https://t.example.com/' || conv_id as permalink", "'2024-01-02T00:00:00+0000' as timestamp",
            "case when turn % 6 = 0 then '' else 'file-' || conv_id || '-' || turn end as key",
        ), as_of(),
    ).select("source", "source_job_id", "source_url", "title", "company_name", "job_description_text", "posted_at", "failed"),
    """select 'threads' source, case when turn % 3 <> 0 then conv_id || '-' || turn when turn % 6 = 0 then '' else 'file-' || conv_id || '-' || turn end source_job_id,
      'https://t.example.com/' || conv_id source_url, null::varchar title, null::varchar company_name,
      case when turn % 4 <> 0 then nullif(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '') end job_description_text, '2024-01-02T00:00:00+0000' posted_at, turn % 6 = 0 failed from conversations""",
)
register(
    "html_to_text",
    lambda s, d: tb.read(s, d, "pages").select("page_id", html_to_text(F.col("html")).alias("body")),
    """with t as (select page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g') h from pages),
    u as (select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '(?i)<\\s*br\\s*/?\\s*>', chr(10), 'g'), '(?i)<li\\b[^>]*>', '- ', 'g'), '(?i)</(li|p|div|h[1-4]|ul|ol|tr)\\s*>', chr(10), 'g'), '(?s)<[/!?a-zA-Z][^>]*>', '', 'g') h from t),
    v as (select page_id, replace(replace(replace(replace(h, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&') h from u)
    select page_id, nullif(regexp_replace(regexp_replace(regexp_replace(h, '[^\\S\\n]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g'), '') body from v""",
)
register(
    "keyword_slug", lambda s, d: tb.read(s, d, "part").select("p_partkey", keyword_slug(F.concat("p_name", F.lit(" / "), "p_brand", F.lit("!"))).alias("slug")),
    "select p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_brand || '!'), '[^a-z0-9]+', '-', 'g'), '-') slug from part",
)

register(
    "archive_slug",
    lambda s, d: tb.read(s, d, "part").select("p_partkey", archive_slug(F.expr("case when p_partkey % 9 = 0 then ' ?! ' else ' ' || p_name || ' / Kế ' || p_brand || '!' end")).alias("slug")),
    """select p_partkey, coalesce(nullif(trim(regexp_replace(lower(case when p_partkey % 9 = 0 then ' ?! ' else ' ' || p_name || ' / Kế ' || p_brand || '!' end), '[^\\p{L}\\p{N}]', '-', 'g'), '-'), ''), 'kw') slug from part""",
)

# ------------------------------------------------------------------ listing pages

_LIST = (
    f"html || '{LD}{{\"@type\":\"ItemList\",\"itemListElement\":[{{\"url\":\"https://itviec.com/it-jobs/a-' || {P} || '\"}},{{\"url\":\"https://itviec.com/companies/x\"}},{{\"position\":2}},"
    f"{{\"url\":\"https://itviec.com/it-jobs/b-' || {P} || '\"}}]}}</script>{LD}{{oops</script><a href=\"/it-jobs?query=1&page=' || ({P} % 17) || '\">p</a><a href=\"?page=3\">3</a> text ?page=40 "
    f"<a href=\"https://www.topcv.vn/viec-lam/dev-' || {P} || '/' || ({P} * 3) || '.html?ta=1\">x</a><a href=\"https://www.topcv.vn/viec-lam/dev-' || {P} || '/' || ({P} * 3) || '.html\">again</a>"
    f"<a href=\"/vi/tim-viec-lam/dev.35C' || {P} || '.html\">c</a><div data-entity-urn=\"urn:li:jobPosting:' || (7000 + {P}) || '\"></div><div data-entity-urn=\"urn:li:jobPosting:' || (7000 + {P}) || '\"></div>'"
)


def _list_pages(s, d):
    return tb.read(s, d, "pages").selectExpr(f"cast({P} as string) as key", f"{_LIST} as html")


register("listing_urls_jsonld", lambda s, d: listing.listing_urls_jsonld(_list_pages(s, d)),
         f"select cast({P} as varchar) as key, i as position, 'https://itviec.com/it-jobs/' || case i when 0 then 'a-' else 'b-' end || {P} as url from pages, (values (0), (1)) v(i)")
register(
    "listing_urls_regex",
    lambda s, d: listing.listing_urls_regex(_list_pages(s, d), "topcv").unionByName(listing.listing_urls_regex(_list_pages(s, d), "careerviet"))
    .unionByName(listing.listing_urls_regex(_list_pages(s, d), "linkedin")),
    f"""select cast({P} as varchar) as key, 0 as position, 'https://www.topcv.vn/viec-lam/dev-' || {P} || '/' || ({P} * 3) || '.html' as url from pages
    union all select cast({P} as varchar), 0, 'https://careerviet.vn/vi/tim-viec-lam/dev.35C' || {P} || '.html' from pages
    union all select cast({P} as varchar), i, cast(7000 + {P} as varchar) from pages, (values (0), (1)) v(i)""",
)
register(
    "detect_max_page",
    lambda s, d: _list_pages(s, d).select("key", listing.detect_max_page(F.col("html"), True).alias("in_links"), listing.detect_max_page(F.col("html")).alias("anywhere")),
    f"select cast({P} as varchar) as key, greatest(3, {P} % 17) in_links, 40::bigint anywhere from pages",
)

_ALIAS = "case o_orderkey % 6 when 0 then '' when 1 then '/Dev-Ops/' when 2 then 'data-' || o_orderkey || '-jv' when 3 then 'bad slug' else 'dev-' || o_custkey end"
_JID = "case when o_orderkey % 14 = 5 then ' ' else cast(o_orderkey as string) end"
_URL = f"""case when {_ALIAS} = '' or trim({_JID}) = '' then null when o_orderkey % 6 = 2 then 'https://www.vietnamworks.com/data-' || o_orderkey || '-jv'
  else 'https://www.vietnamworks.com/' || lower(trim({_ALIAS}, '/')) || '-' || o_orderkey || '-jv' end"""
tb.cte("listed", [], f"""select trim({_JID}) job_id, {_ALIAS} as alias, {_URL} url,
  case when {_URL} is null then 'skipped' when o_orderkey % 6 = 3 then 'rejected_url' else 'enqueue' end route from orders""")


def _listed(s, d):
    return listing.route_listing_records(tb.read(s, d, "orders").selectExpr(f"{_JID} as job_id", f"{_ALIAS} as alias"))


register("detail_url_build", lambda s, d: _listed(s, d), tb.sql("select * from listed", "listed"))


def _listings(s, d, alias):
    """Listing responses as JSON lines, two records each: an order's own and one more with another link."""
    path = work_dir(s, "listings")
    tb.read(s, d, "orders").selectExpr(
        f"array(named_struct('jobId', {_JID}, 'alias', {alias}), named_struct('jobId', 'x' || o_custkey % 50, 'alias', 'bad slug')) as data",
        "named_struct('nbPages', 9) as meta",
    ).coalesce(1).write.json(path)
    return path


def _seeded(s, d):
    """The frontier after a listing was read twice, with the counters of each time."""
    store = FrontierStore(s, work_dir(s, "seeded"), 4)
    path = _listings(s, d, _ALIAS)
    first, again = (store.seed_from_listings(path, as_of(), one_per_object=False) for _ in range(2))
    return store.rows().select("source", "job_id", "url", "status", "first_seen_at", "retry_count", *[
        F.lit(v).cast("bigint").alias(k) for k, v in first.items()], F.lit(first == again).alias("same_again"))


register(
    "seed_from_listings", _seeded,
    tb.sql(f"""select 'vietnamworks' source, job_id, url, 'pending' status, timestamp '{tb.AS_OF_EVENTS}' first_seen_at, 0 retry_count, 1::bigint scanned_files,
      (select count(distinct job_id) from listed where route = 'enqueue') enqueued, (select count(*) from listed where route = 'skipped') skipped,
      (select count(*) from listed where route = 'rejected_url') + (select count(*) from orders) rejected_url, true same_again from listed where route = 'enqueue'""", "listed"),
)


def _cycle(s, d):
    """Listing, claim, outcomes, the next listing and claim on one stored frontier; the claims are repeated as after a crash."""
    store = FrontierStore(s, work_dir(s, "cycle"), 4)
    later = F.lit("2024-02-02 00:00:00").cast("timestamp")
    store.seed_from_listings(_listings(s, d, _ALIAS), as_of(), one_per_object=False)
    claimed = store.claim(500, as_of(), "c1")
    store.claim(500, as_of(), "c1")
    outcomes = claimed.selectExpr(
        "source", "job_id", "case cast(job_id as bigint) % 3 when 0 then 'success' when 1 then 'failed' else 'expired' end as outcome", "200 as http_status",
        "'error ' || job_id as error", "'raw/' || job_id as raw_object_key", "'run1' as run_id")
    done = work_dir(s, "outcomes")
    outcomes.write.parquet(done)
    for _ in range(2):
        store.finish(s.read.parquet(done), as_of())
    store.claim(500, later, "c1")
    store.seed_from_listings(_listings(s, d, f"case when {_ALIAS} like 'dev-%' then 'new-' || o_custkey else {_ALIAS} end"), later, one_per_object=False)
    for _ in range(2):
        store.claim(200, later, "c2")
    return store.rows().select("job_id", "url", "status", "retry_count", "claim_token", "first_seen_at", "last_attempt_at", "crawled_at", "http_status", "error_message", "raw_object_key")


register(
    "frontier_stored_cycle", _cycle,
    tb.sql(f"""with q as (select job_id, case when url like '%/dev-ops-%' then url else replace(url, '/dev-', '/new-') end url, cast(job_id as bigint) % 3 o, row_number() over (order by job_id) <= 500 c1 from listed where route = 'enqueue'),
    w as (select *, not (c1 and o = 0) and row_number() over (partition by c1 and o = 0 order by job_id) <= 200 c2 from q)
    select job_id, url, case when c1 and o = 0 then 'success' when c2 then 'in_progress' else 'pending' end status, (case when c1 then 1 else 0 end) + (case when c2 then 1 else 0 end) retry_count,
      case when c2 then 'c2' when c1 then 'c1' end claim_token, timestamp '{tb.AS_OF_EVENTS}' first_seen_at,
      case when c2 then timestamp '2024-02-02' when c1 then timestamp '{tb.AS_OF_EVENTS}' end last_attempt_at, case when c1 and o in (0, 2) then timestamp '{tb.AS_OF_EVENTS}' end crawled_at,
      case when c1 and o = 2 then 404 when c1 then 200 end http_status, case when c1 and o = 1 then 'error ' || job_id end error_message, case when c1 and o = 0 then 'raw/' || job_id end raw_object_key from w""", "listed"),
)

_URLS = {
    "careerviet": ("'https://careerviet.vn/vi/tim-viec-lam/dev.' || case when event_id % 7 = 0 then 'zz' else '35c8' || lpad(cast(event_id % 500 as string), 4, '0') end || '.html'",
                   "case when event_id % 7 <> 0 then '35C8' || lpad(cast(event_id % 500 as varchar), 4, '0') end"),
    "itviec": ("'https://itviec.com/it-jobs/dev-co-' || case when event_id % 7 = 0 then 'x' else cast(event_id % 500 as string) end",
               "case when event_id % 7 <> 0 then cast(event_id % 500 as varchar) end"),
    "topcv": ("'https://www.topcv.vn/viec-lam/dev-' || user_id || '/' || case when event_id % 7 = 0 then 'x' else cast(event_id % 500 as string) end || '.html?utm=' || event_id",
              "case when event_id % 7 <> 0 then cast(event_id % 500 as varchar) end"),
}


def _seed(source):
    def run(s, d):
        urls = tb.read(s, d, "events").selectExpr(f"{_URLS[source][0]} as url", "event_id as ordinal")
        items = listing.items_from_urls(urls, source)
        empty = tb.frontier(s, d).filter("false")
        queued = fr.frontier_upsert(empty, items.filter("route = 'enqueue'"), as_of())
        return queued.select("source", "job_id", "url", "status").withColumn(
            "rejected_url", items.agg(F.count_if(F.col("route") == "rejected_url")).scalar()
        )
    return run


for _board, (_url, _id) in _URLS.items():
    _pick = "arg_min" if _board == "topcv" else "arg_max"
    _kept = f"split_part({_url}, '?', 1)" if _board == "topcv" else _url
    register(
        f"seed_from_urls_{_board}", _seed(_board),
        f"""select '{_board}' source, {_id} job_id, {_pick}({_kept}, event_id) url, 'pending' status,
          (select count(*) from events where event_id % 7 = 0) rejected_url from events where event_id % 7 <> 0 group by {_id}""",
    )
register(
    "seed_from_job_ids",
    lambda s, d: listing.items_from_urls(tb.read(s, d, "events").selectExpr("case when event_id % 7 = 0 then ' ' else ' ' || event_id || ' ' end as url", "event_id as ordinal"), "linkedin"),
    "select 'linkedin' source, cast(event_id as varchar) job_id, 'https://www.linkedin.com/jobs/view/' || event_id url, event_id ordinal, 'enqueue' route from events where event_id % 7 <> 0",
)


def _search(s, d):
    """Each turn of a conversation is a result page: up to two posts, none on some first pages."""
    return tb.read(s, d, "conversations").selectExpr(
        "'kw' || conv_id as keyword", "conv_id as keyword_no", "cast(turn + 1 as int) as page",
        "case when conv_id % 5 = 0 and turn = 0 then cast(array() as array<struct<id:string,text:string>>) "
        "else array(named_struct('id', cast((conv_id * 3 + turn) % 200 as string), 'text', text), named_struct('id', case when turn % 3 = 0 then '' else 'p' || turn end, 'text', role)) end as posts",
        "case when conv_id % 11 = 0 and turn = 2 then 'HTTP 500' end as error",
    )


tb.cte("search_posts", [], """select conv_id, turn, 0 as position, cast((conv_id * 3 + turn) % 200 as varchar) id, text from conversations where not (conv_id % 5 = 0 and turn = 0)
  union all select conv_id, turn, 1, case when turn % 3 = 0 then '' else 'p' || turn end, role from conversations where not (conv_id % 5 = 0 and turn = 0)""")
register(
    "search_dedup_counters", lambda s, d: listing.search_counters(_search(s, d)),
    tb.sql("""select (select count(distinct conv_id) from conversations) keywords, count(*) posts_raw, count(distinct nullif(id, '')) posts_unique,
      (select count(distinct conv_id) from conversations where conv_id % 5 = 0 and turn = 0) empty_keywords,
      (select count(distinct conv_id) from conversations where conv_id % 11 = 0 and turn = 2) failed_keywords from search_posts""", "search_posts"),
)
register(
    "search_first_seen", lambda s, d: listing.search_posts(_search(s, d)),
    tb.sql("""select conv_id keyword_no, cast(turn + 1 as int) page, position, id, text from search_posts where id <> ''
      qualify row_number() over (partition by id order by conv_id, turn, position) = 1""", "search_posts"),
)
