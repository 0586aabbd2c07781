import json

import pytest

from vacancia.operators import validate

DDL = (
    "source string, source_job_id string, parsed_at string, title string, company_name string, salary_min double, "
    "salary_max double, is_salary_visible boolean, posted_at string, expired_at string, job_function string, locations string"
)
GOOD = dict(
    source="itviec", source_job_id="1", parsed_at="2024-01-01T00:00:00Z", title="T", company_name="C", salary_min=None,
    salary_max=None, is_salary_visible=False, posted_at=None, expired_at=None, job_function=None, locations="[]",
)


def frame(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(r[n.split()[0]] for n in DDL.split(", ")) for r in rows], DDL)


def verdict(spark, rule, **change):
    row = frame(spark, change).select(rule.alias("v")).first()["v"]
    return None if row is None else tuple(row)


@pytest.mark.parametrize("change,expected", [
    ({}, None),
    ({"title": ""}, ("MISSING_TITLE", "")),
    ({"title": None, "company_name": None}, ("MISSING_TITLE", "")),
    ({"title": "  "}, None),
    ({"company_name": ""}, ("MISSING_COMPANY", "")),
    ({"is_salary_visible": True, "salary_min": 5.0, "salary_max": 1.0}, ("BAD_SALARY_RANGE", "min=5.0 > max=1.0")),
    ({"is_salary_visible": True, "salary_min": 12345678.5, "salary_max": 1.0}, ("BAD_SALARY_RANGE", "min=12345678.5 > max=1.0")),
    ({"is_salary_visible": False, "salary_min": 5.0, "salary_max": 1.0}, None),
    ({"is_salary_visible": True, "salary_min": 5.0, "salary_max": 5.0}, None),
    ({"is_salary_visible": True, "salary_min": 5.0}, None),
    ({"posted_at": "2024-02-01", "expired_at": "2024-01-01"}, ("BAD_DATE_RANGE", "expired_at=2024-01-01 < posted_at=2024-02-01")),
    ({"posted_at": "2024-01-01", "expired_at": "2024-01-01"}, None),
    ({"posted_at": "", "expired_at": "2024-01-01"}, None),
])
def test_business_rules(spark, change, expected):
    assert verdict(spark, validate.business_rules(), **change) == expected


@pytest.mark.parametrize("value,expected", [
    (None, None),
    ("Data Engineer role", None),
    ("Cook", ("OUT_OF_FOCUS", "function='Cook' (string, no keyword match)")),
    (json.dumps({"children": [{"id": 7, "name": "X"}]}), None),
    (json.dumps({"children": [{"id": 1, "name": "NGO"}], "parentId": 25}), ("OUT_OF_FOCUS", "function='NGO' parentId=25")),
    (json.dumps({"parentName": "P"}), ("OUT_OF_FOCUS", "function='P' parentId=None")),
    (json.dumps({"children": []}), ("OUT_OF_FOCUS", "function='?' parentId=None")),
    ("[1]", ("OUT_OF_FOCUS", "job_function is not a dict: list")),
    ("42", ("OUT_OF_FOCUS", "job_function is not a dict: int")),
])
def test_focus(spark, value, expected):
    assert verdict(spark, validate.focus([7]), job_function=value) == expected


def test_location_and_title(spark):
    place = json.dumps([{"city": "Singapore"}, {"city": None}])
    assert verdict(spark, validate.location_in_vietnam(), locations=place) == (
        "OUT_OF_LOCATION", "locations='Singapore, ' (not Vietnam)"
    )
    assert verdict(spark, validate.location_in_vietnam(), locations='[{"city":"Quận 1, Hồ Chí Minh"}]') is None
    assert verdict(spark, validate.location_in_vietnam(), locations="[]") is None
    assert verdict(spark, validate.title_keywords(), title="Senior DATA ENGINEER") is None
    assert verdict(spark, validate.title_keywords(), title="Cook")[0] == "OUT_OF_FOCUS"
    assert verdict(spark, validate.title_keywords(), title="") is None


def test_routing_keeps_the_rest_of_a_batch(spark):
    df = frame(spark, {}, {"source_job_id": ""}, {"title": None, "source_job_id": "2"}, {"parsed_at": None, "source_job_id": "3"})
    split = validate.split_valid_rejected(df)
    assert [r.source_job_id for r in split.valid.collect()] == ["1"]
    assert [(r.source_job_id, r.reject_reason) for r in split.rejected.collect()] == [("2", "MISSING_TITLE")]
    assert split.failed.count() == 2
    assert validate.with_outcome(df, validate=False).filter("outcome = 'loaded'").count() == 2
