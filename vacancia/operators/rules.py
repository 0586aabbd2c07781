"""First-match rules: the first rule, by a fixed order, whose keyword fits a text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.jsontext import literal_map, sql_text


@dataclass(frozen=True)
class Ordered:
    """Rules in match order. ``keys`` are lower-cased keywords, ``values`` output tuples."""

    keys: list[str]
    values: list[tuple]


def collect_rules(rules: DataFrame, order: Sequence[Column], key: str, outputs: Sequence[str]) -> Ordered:
    """Rules as literals."""
    rows = rules.orderBy(*order).select(F.lower(key).alias("_k"), *outputs).collect()
    return Ordered([r[0] for r in rows], [tuple(r[1:]) for r in rows])


def _case_index(conditions: list[str]) -> Column:
    """Position of the first SQL condition that holds; evaluation stops there.

    Written as text: one parse instead of several gateway calls per rule.
    """
    if not conditions:
        return F.lit(None).cast("int")
    return F.expr("case " + " ".join(f"when {c} then {i}" for i, c in enumerate(conditions)) + " end")


def contains_index(text: str, rules: Ordered) -> Column:
    return _case_index([f"contains({text}, {sql_text(k)})" for k in rules.keys])


def pick(index: str, rules: Ordered, position: int, kind: str) -> Column:
    """Output column of the matched rule."""
    if not rules.values:
        return F.lit(None).cast(kind)

    def lit(x) -> str:
        return "null" if x is None else sql_text(x) if isinstance(x, str) else str(x)

    body = ", ".join(lit(v[position]) for v in rules.values)
    return F.expr(f"get(cast(array({body}) as array<{kind}>), {index})")


def first_match(
    df: DataFrame, text: str, rules: DataFrame, key: str, outputs: dict[str, str],
    order: Sequence[Column], by_join: bool = False,
) -> DataFrame:
    """Add ``outputs`` (rule column -> new name) of the first rule contained in df[text].

    The order must be total. The rules become a CASE chain that each row evaluates, without a
    shuffle: right for tables a person maintains. A caller whose rule table grows with the data
    says ``by_join``: no rule is collected, and distinct texts meet the rules by q-grams
    (``keyword_hits``). Both give the same rows, whatever the sizes.
    """
    if by_join:
        return _first_match_join(df, text, rules, key, outputs, order)
    kinds = {f.name: f.dataType.simpleString() for f in rules.schema.fields}
    inline = collect_rules(rules, order, key, list(outputs))
    with_idx = df.withColumn("_rule_idx", contains_index(f"lower({text})", inline))
    return with_idx.select(
        *df.columns,
        *[pick("_rule_idx", inline, i, kinds[c]).alias(n) for i, (c, n) in enumerate(outputs.items())],
    )


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """Distinct substrings of the given lengths."""
    def cut(n: int) -> Column:
        if not n:
            return F.array(F.lit(""))
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        pieces = F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))
        return F.when(F.length(text) >= n, pieces).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[cut(n) for n in sizes])))


def keyword_hits(texts: DataFrame, text: str, rules: DataFrame, key: str, q: int = 3) -> DataFrame:
    """``texts`` beside every rule whose keyword is contained in the text, both lower-cased; any number of rules.

    Each keyword is filed under one of its q-grams, the one that fewest texts hold (a shorter
    keyword under itself). Texts meet the rules that are filed under their grams, and the keyword
    itself is looked for there alone. ``texts`` should be distinct.
    """
    low = F.lower(key)
    sizes = sorted(r[0] for r in rules.select(F.least(F.length(key), F.lit(q))).distinct().collect() if r[0] is not None)
    if not sizes:
        return texts.crossJoin(rules).limit(0)
    held = texts.filter(F.col(text).isNotNull())
    pieces = held.select(*texts.columns, F.explode(_grams(F.lower(text), sizes)).alias("_gram"))
    own = rules.select(low.alias("_key")).distinct().select("_key", F.explode(_grams(F.col("_key"), sizes)).alias("_gram")).filter(
        F.length("_gram") == F.least(F.length("_key"), F.lit(q))
    )
    seen = pieces.join(own.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    from vacancia.operators.merge import first_per_key

    filed = first_per_key(own.join(seen, "_gram", "left"), ["_key"], [F.coalesce("_n", F.lit(0)), F.col("_gram")]).select("_key", "_gram")
    hits = pieces.join(filed, "_gram").filter(F.contains(F.lower(text), F.col("_key"))).drop("_gram")
    # The rules stand first, so that a caller's columns of them keep their meaning.
    return rules.withColumn("_key", low).join(hits, "_key").drop("_key")


def _first_match_join(df, text, rules, key, outputs, order) -> DataFrame:
    from vacancia.operators.merge import first_per_key

    hits = keyword_hits(df.select(F.col(text).alias("_text")).distinct(), "_text", rules, key)
    best = first_per_key(hits, ["_text"], order).select("_text", *[F.col(c).alias(n) for c, n in outputs.items()])
    return df.join(best, df[text] == best["_text"], "left").select(*[df[c] for c in df.columns], *[best[n] for n in outputs.values()])


# ------------------------------------------------------------------ title rules

@dataclass(frozen=True)
class TitleRule:
    pattern: str
    job_category: str
    priority: int
    match_mode: str = "word_boundary"
    is_active: bool = True


def _usable(spark, regex: str) -> bool:
    """A rule that does not compile is skipped, not an error."""
    try:
        re.compile(regex)
    except re.error:
        return False
    jvm = spark._jvm.java.util.regex.Pattern
    try:
        jvm.compile("(?U)" + regex)
    except Exception:  # noqa: BLE001 - the JVM error type is wrapped by the gateway
        return False
    return True


def _condition(title: str, rule: TitleRule) -> str:
    low = rule.pattern.lower()
    if rule.match_mode == "exact":
        return f"{title} in ({sql_text(low)}, {sql_text(low + chr(10))})"
    if rule.match_mode == "word_boundary":
        # The plain containment test is cheap and rejects nearly every title.
        word = sql_text(r"(?U)\b\Q" + low + r"\E\b")
        return f"(contains({title}, {sql_text(low)}) and {title} rlike {word})"
    return f"{title} rlike {sql_text('(?U)' + low)}"


def load_title_rules(rules: DataFrame) -> list[TitleRule]:
    """Active rules by (priority, longest pattern, pattern, category), for ``classify_title``."""
    rows = (
        rules.filter("is_active")
        .orderBy("priority", F.length("pattern").desc(), "pattern", "job_category")
        .collect()
    )
    return [TitleRule(r.pattern, r.job_category, r.priority, r.match_mode, True) for r in rows]


def classify_title(df: DataFrame, rules: Sequence[TitleRule], function_map: dict[str, str]) -> DataFrame:
    """Add job_category, category_method, category_confidence, category_matched_on.

    A mapped function name of the first board decides; else the first title rule;
    else 'Other'. Map-only: rules are literals in a CASE chain.
    """
    spark = df.sparkSession
    active = [
        r for r in rules
        if r.is_active and (r.match_mode != "regex" or _usable(spark, r.pattern.lower()))
    ]
    title = "lower(coalesce(title, ''))"
    mapping = literal_map(function_map)
    name = F.get_json_object("job_function", "$.children[0].name")
    by_function = F.when(F.col("source") == "vietnamworks", F.try_element_at(mapping, name))
    kept = Ordered(
        [r.pattern for r in active],
        [(r.job_category, round(max(0.50, 1.0 - r.priority / 100.0), 2), r.pattern) for r in active],
    )
    df2 = df.withColumn("_fn", by_function).withColumn(
        "_idx", F.when(F.col("_fn").isNull(), _case_index([_condition(title, r) for r in active]))
    )
    fn, idx = F.col("_fn"), F.col("_idx")
    return df2.select(
        *df.columns,
        F.coalesce(fn, pick("_idx", kept, 0, "string"), F.lit("Other")).alias("job_category"),
        F.when(fn.isNotNull(), "source_metadata").when(idx.isNotNull(), "title_keyword")
        .otherwise("default").alias("category_method"),
        F.when(fn.isNotNull(), F.lit(0.95)).when(idx.isNotNull(), pick("_idx", kept, 1, "double"))
        .otherwise(F.lit(0.0)).alias("category_confidence"),
        F.when(fn.isNotNull(), F.substring("job_function", 1, 100))
        .otherwise(pick("_idx", kept, 2, "string")).alias("category_matched_on"),
    )
