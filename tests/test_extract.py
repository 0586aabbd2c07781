import json

import pytest
from pyspark.sql import functions as F

from vacancia.functions.text import html_to_text
from vacancia.operators import extract, listing

LD = '<script type="application/ld+json">{}</script>'


def page(*docs, key="42", extra=""):
    return [(key, "<html>" + extra + "".join(LD.format(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for d in docs) + "</html>")]


def one(spark, job, rows, as_of):
    return job(spark.createDataFrame(rows, "key string, html string"), as_of()).first().asDict()


def posting(**over):
    return {"@type": "JobPosting", "title": "Dev", **over}


def test_itviec_quirks(spark, as_of):
    r = one(spark, extract.jobposting_itviec, page(
        {"@type": "X"}, "{broken", posting(
            baseSalary={"currency": "USD", "value": {"value": "You'll love it", "minValue": "1000"}},
            experienceRequirements={"monthsOfExperience": 6}, skills="Python, ,SQL ", validThrough="2024-06-01",
            jobLocation=[{"address": {"addressRegion": "HCM", "streetAddress": "1"}}, {"address": "bad"}, "junk", {}],
            potentialAction={"target": "https://itviec.com/a/job_applications/new"}, description="<p>a</p>",
        )), as_of)
    assert not r["failed"] and r["pretty_salary"] is None
    assert (r["salary_min"], r["salary_max"], r["is_salary_visible"]) == (1000.0, None, True)
    assert r["years_of_experience"] == 1 and r["is_expired"] and not r["is_active"]
    assert r["source_url"] == "https://itviec.com/a" and r["job_function"] == "IT"
    assert json.loads(r["skills"]) == [{"name": "Python"}, {"name": "SQL"}]
    assert json.loads(r["locations"]) == [
        {"city": "HCM", "city_vi": "HCM", "address": "1"}, {"city": None, "city_vi": None, "address": None},
    ]


def test_itviec_ignores_arrays_topcv_reads_them(spark, as_of):
    rows = page(json.dumps([{"@type": "Thing"}, posting()]))
    assert one(spark, extract.jobposting_itviec, rows, as_of)["failed"]
    r = one(spark, extract.jobposting_topcv, rows, as_of)
    assert not r["failed"] and r["source_url"] == "https://www.topcv.vn/viec-lam/42.html"


@pytest.mark.parametrize("link", [
    '<link rel="canonical" href="https://www.topcv.vn/viec-lam/a/1.html?x=1">',
    "<LINK href='https://www.topcv.vn/viec-lam/a/1.html' rel='canonical'>",
])
def test_topcv_canonical_and_sentinel(spark, as_of, link):
    r = one(spark, extract.jobposting_topcv, page(posting(
        baseSalary={"value": {"value": " Thoả thuận "}}, jobLocation={"address": {"addressRegion": "HN", "addressLocality": "CG"}},
    ), extra=link), as_of)
    assert r["source_url"] == "https://www.topcv.vn/viec-lam/a/1.html"
    assert r["pretty_salary"] is None and not r["is_salary_visible"]
    assert json.loads(r["locations"])[0]["district"] == "CG"


def test_careerviet_quirks(spark, as_of):
    r = one(spark, extract.jobposting_careerviet, page(posting(
        identifier={"name": "Co", "value": "35c80246"}, employmentType=['"FULL_TIME"'], workHours="8:00-17:00",
        baseSalary={"currency": "VND", "value": {"value": "Cạnh tranh"}}, skills="stuffing, words",
        experienceRequirements={"monthsOfExperience": 36, "description": "Kinh nghiệm 3 Năm"}, industry="IT, Bank",
        jobLocation={"address": {"addressRegion": "Quận 7", "addressLocality": "Hồ Chí Minh"}}, jobBenefits=["A", " "],
    )), as_of)
    assert r["source_job_id"] == "35C80246" and r["employment_type"] == "FULL_TIME"
    assert (r["salary_min"], r["pretty_salary"], r["is_salary_visible"]) == (None, "Cạnh tranh", False)
    assert r["years_of_experience"] == 3 and r["skills"] == "[]"
    assert (r["working_from_hour"], r["working_to_hour"]) == ("8:00", "17:00")
    assert json.loads(r["locations"]) == [{"city": "Hồ Chí Minh", "district": "Quận 7", "address": None, "country": "VN"}]
    assert json.loads(r["industries"]) == [{"name": "IT"}, {"name": "Bank"}] and json.loads(r["benefits"]) == [{"name": "A"}]


@pytest.mark.parametrize("req,years", [
    ({"monthsOfExperience": 6}, 0), ({"monthsOfExperience": 30}, 2), ({"monthsOfExperience": 0, "description": "5 năm"}, 5),
    ("2 years", 2), ({"description": "none"}, None), (None, None),
])
def test_careerviet_years(spark, as_of, req, years):
    assert one(spark, extract.jobposting_careerviet, page(posting(experienceRequirements=req)), as_of)["years_of_experience"] == years


@pytest.mark.parametrize("text,expected", [
    ("1,000,000 - 3,000,000 VND/month", (1e6, 3e6, "VND", 1)),
    ("₫1.000.000 - ₫3.000.000/tháng", (1e6, 3e6, "VND", 1)),
    ("$50 - $80/hr", (50.0, 80.0, "USD", 2)),
    ("$90,000/yr", (90000.0, 90000.0, "USD", 3)),
    ("Negotiable", (None, None, None, 1)),
    ("", (None, None, None, None)),
])
def test_linkedin_salary(spark, as_of, text, expected):
    html = f'<h1 class="top-card-layout__title">Dev</h1><div class="salary-main-rail__data-body"> {text} </div>'
    r = one(spark, extract.jobposting_linkedin, [("9", html)], as_of)
    assert (r["salary_min"], r["salary_max"], r["salary_currency"], r["salary_period_id"]) == expected


@pytest.mark.parametrize("text,expected", [
    ("2 days ago", "2024-06-13T12:00:00Z"), ("1 week ago", "2024-06-08T12:00:00Z"), ("3 months ago", "2024-03-17T12:00:00Z"),
    ("5 minutes ago", "2024-06-15T11:55:00Z"), ("just now", "2024-06-15T12:00:00Z"),
])
def test_linkedin_dates_and_missing_title(spark, as_of, text, expected):
    html = f'<h1 class="top-card-layout__title">Dev</h1><span class="posted-time-ago__text"> {text} </span>'
    assert one(spark, extract.jobposting_linkedin, [("9", html)], as_of)["posted_at"] == expected
    assert one(spark, extract.jobposting_linkedin, [("9", "<p>nothing</p>")], as_of)["failed"]


@pytest.mark.parametrize("html,text", [
    (None, None), ("", None), ("   ", None), ("hello world", "hello world"), ("a<br>b<br/>c", "a\nb\nc"),
    ("<ul><li>Python</li><li>SQL</li></ul>", "- Python\n- SQL"), ("Java &amp; Python", "Java & Python"),
    ("<p>a</p><p></p><p></p><p>b</p>", "a\n\nb"), ("x &amp;lt; y &#233; &#x1F600; &nope;", "x &lt; y é 😀 &nope;"),
    ("<script>bad()</script>ok<!-- c -->", "ok"), ("a < b", "a < b"),
])
def test_html_to_text(spark, html, text):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(html_to_text(F.col("h"))).first()[0] == text


def test_posts_invent_nothing(spark, as_of):
    df = spark.createDataFrame([("7", " hi ", "u", "t", "k"), ("", "x", None, None, ""), (None, " ", None, None, "file")],
                               "id string, text string, permalink string, timestamp string, key string")
    rows = extract.post_to_record(df, as_of()).collect()
    assert [(r.source_job_id, r.job_description_text, r.failed) for r in rows] == [("7", "hi", False), ("", "x", True), ("file", None, False)]
    assert all(r.title is None and r.company_name is None for r in rows)


@pytest.mark.parametrize("source,url,job_id", [
    ("careerviet", "https://careerviet.vn/vi/tim-viec-lam/a-b.35c80246.html", "35C80246"),
    ("careerviet", "https://careerviet.vn/vi/tim-viec-lam/a.xyz.html", None),
    ("itviec", "https://itviec.com/it-jobs/dev-co-4611", "4611"), ("itviec", "https://itviec.com/it-jobs/dev?x=1", None),
    ("topcv", "https://www.topcv.vn/viec-lam/dev/12.html?ta=1", "12"), ("topcv", "https://www.topcv.vn/x/12.html", None),
])
def test_job_ids(spark, source, url, job_id):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(listing.job_id_from_url(F.col("u"), source)).first()[0] == job_id


@pytest.mark.parametrize("slug,jid,url", [
    ("dev", "1", "https://www.vietnamworks.com/dev-1-jv"), ("/Dev-1-jv/", "1", "https://www.vietnamworks.com/dev-1-jv"), ("", "1", None), ("dev", " ", None),
])
def test_detail_url(spark, slug, jid, url):
    df = spark.createDataFrame([(slug, jid)], "s string, j string")
    assert df.select(listing.detail_url(F.col("s"), F.col("j"))).first()[0] == url
