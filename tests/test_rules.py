import pytest
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.operators import normalize, rules
from vacancia.operators.rules import TitleRule

FN = seeds.as_dict(seeds.FUNCTION_CATEGORIES)
RULES = [
    TitleRule("data engineer", "Data Engineer", 10), TitleRule("ai", "AI Engineer", 20), TitleRule("c++", "Embedded", 5),
    TitleRule("(bad", "Never", 1, "regex"), TitleRule("off", "Off", 1, is_active=False), TitleRule("exact me", "Exact", 2, "exact"),
    TitleRule("kế toán", "Accounting", 80), TitleRule("phd$", "Research", 30, "regex"),
]


def classify(spark, title, source="itviec", function=None):
    df = spark.createDataFrame([(title, source, function)], "title string, source string, job_function string")
    r = rules.classify_title(df, RULES, FN).first()
    return r.job_category, r.category_method, r.category_confidence, r.category_matched_on


@pytest.mark.parametrize("title,expected", [
    ("Senior Data Engineer", ("Data Engineer", "title_keyword", 0.9, "data engineer")),
    ("Email marketer", ("Other", "default", 0.0, None)),
    ("AI/ML lead", ("AI Engineer", "title_keyword", 0.8, "ai")),
    ("C++ dev", ("Other", "default", 0.0, None)),
    ("Exact me", ("Exact", "title_keyword", 0.98, "exact me")),
    ("not exact me", ("Other", "default", 0.0, None)),
    ("Nhân viên Kế Toán", ("Accounting", "title_keyword", 0.5, "kế toán")),
    ("Fellow PhD", ("Research", "title_keyword", 0.7, "phd$")),
    (None, ("Other", "default", 0.0, None)),
])
def test_classify(spark, title, expected):
    assert classify(spark, title) == expected


def test_function_decides_for_one_board_only(spark):
    js = '{"children":[{"id":1,"name":"Sales/Business Development"}]}'
    assert classify(spark, "Data Engineer", "vietnamworks", js)[:3] == ("Business Development", "source_metadata", 0.95)
    assert classify(spark, "Data Engineer", "linkedin", js)[0] == "Data Engineer"
    assert classify(spark, "Data Engineer", "vietnamworks", "[]")[0] == "Data Engineer"


def test_first_match_join_equals_inline(spark):
    table = seeds.seed(spark, "job_level_map")
    titles = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["Senior Intern", "Team Lead", "CVCC", None, "", "Giám đốc", "lead x", "zzz", "Senior Intern"])],
        "id int, title string",
    )
    order = [F.col("priority"), F.length("keyword").desc(), F.col("keyword"), F.col("job_level")]

    def run(by_join):
        return sorted((r.id, r.lv) for r in rules.first_match(titles, "title", table, "keyword", {"job_level": "lv"}, order, by_join).collect() if r.lv)

    inline = run(False)
    assert run(True) == inline and len(inline) == 6


def test_many_rules_whose_key_is_named_like_the_text(spark):
    many = spark.createDataFrame([(i, f"word{i} ", f"out{i}") for i in range(1500)], "priority int, title string, level string")
    titles = spark.createDataFrame([(1, "a word1499 b"), (2, "word7 word3 "), (3, "nothing"), (4, None)], "id int, title string")
    for by_join in (False, True):
        found = rules.first_match(titles, "title", many, "title", {"level": "lv"}, [many["priority"], many["title"]], by_join).collect()
        assert {r.id: r.lv for r in found} == {1: "out1499", 2: "out3", 3: None, 4: None}


def test_regex_rules_know_letters_beyond_ascii(spark):
    rule = rules.TitleRule(r"k\w+ to\w+", "Accounting", 10, "regex")
    rows = spark.createDataFrame([("Kế toán", "x", None)], "title string, source string, job_function string")
    assert rules.classify_title(rows, [rule], {}).first().job_category == "Accounting"
    many = spark.createDataFrame([("t%d" % i, "C%d" % i, i, "word_boundary", True) for i in range(700)], "pattern string, job_category string, priority int, match_mode string, is_active boolean")
    assert rules.classify_title(rows.withColumn("title", F.lit("t699")), rules.load_title_rules(many), {}).first().job_category == "C699"

def test_rule_tables(spark):
    assert len(seeds.synonym_pairs()) == normalize.skill_synonyms(spark).count() == 114
    assert len(seeds.lines(seeds.JOB_LEVEL_KEYWORDS)) == 42
    titles = seeds.table(spark, [("kafka", "X", "1"), ("data engineer", "Data Engineer", "10")], "keyword string, job_category string, priority int")
    got = {r.pattern: r.job_category for r in normalize.category_rules(spark, titles).collect()}
    assert got["kafka"] == "Data Engineer" and len(got) == 20
    cities = seeds.table(spark, [("Sai Gon", "HCMC", "South")], "city_raw_en string, city_canonical string, region string")
    assert normalize.city_aliases(spark, cities).count() == len(seeds.lines(seeds.EXTRA_CITY_ALIASES))
