"""Quality rules kept as a bitmask ledger: measure once, store failure bits, apply any policy later."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import batch_of, id_texts, slices

WINDOW = 5
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
OUT = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_stops")])


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` is the rule's place in the ledger and never reused."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "long_words", "word_chars > 12 * n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
    Rule(6, "upper_case", "2 * n_upper > word_chars"),
    Rule(7, "no_sentence_ends", "n_words >= 100 and 100 * n_stops < n_words"),
)
BASE = ("few_words", "repeated_windows")
#: A version, once used, stays as it is; a change gets a new one.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "upper_case"),
    "v3": (*BASE, "symbols", "repeated_lines", "long_words", "short_words", "upper_case"),
    "v4": tuple(r.name for r in RULES),
}


def policy_mask(version: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[version])


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text, the first place included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    window, span = at[:n], len(ids)
    for k in range(1, width):  # exact: ranks are renewed before a number could pass 63 bits
        if span * len(ids) >= 1 << 62:
            distinct, window = np.unique(window, return_inverse=True)
            span = len(distinct)
        window = window * len(ids) + at[k : k + n]
        span *= len(ids)
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), lines, dup, repeated_words(words),
        sum(map(str.isupper, text)) if text.upper() != text.lower() else 0, sum(map(text.count, ".!?")),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed_bits``: bit b is set if the rule with that bit fails. Map-only.

    A null text counts as empty; repeated rows each get a row; other columns are not read.
    """

    def run(batches):
        for part in slices(batches):
            rows = [measure(t) for t in part.column("text").to_pylist()]
            yield batch_of(OUT, part.column("doc_id"), *(zip(*rows) if rows else [[]] * (len(OUT) - 1)))

    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    measured = id_texts(docs).mapInArrow(
        run, ", ".join(f"{n} long" for n in OUT.names)
    )
    return measured.withColumn("failed_bits", bits)


def fails_policy(version: str, bits: Column | None = None) -> Column:
    return (F.col("failed_bits") if bits is None else bits).bitwiseAND(F.lit(policy_mask(version))) != 0


def apply_policy(rows: DataFrame, version: str) -> DataFrame:
    """The ledger's rows with ``kept`` under a policy; no text is read again."""
    return rows.withColumn("kept", ~fails_policy(version))


def ablations(rows: DataFrame) -> DataFrame:
    """policy, rule, n_docs, failing (by the rule), alone (kept if just this rule were dropped), rejected (by the policy).

    One aggregation of the ledger's bits; an empty ledger gives zeros.
    """
    bits = F.col("failed_bits")
    sums = [F.count(F.lit(1)).alias("n_docs")]
    sums += [F.count_if(bits.bitwiseAND(F.lit(1 << r.bit)) != 0).alias(f"f{r.bit}") for r in RULES]
    names = {r.name: r for r in RULES}
    cases = [(v, names[n]) for v in POLICIES for n in POLICIES[v]]
    for version in POLICIES:
        sums.append(F.count_if(fails_policy(version)).alias(f"rejected_{version}"))
    for version, rule in cases:
        sums.append(F.count_if(bits.bitwiseAND(F.lit(policy_mask(version))) == (1 << rule.bit)).alias(f"a_{version}_{rule.bit}"))
    entry = [
        F.struct(
            F.lit(v).alias("policy"), F.lit(r.name).alias("rule"), F.col("n_docs"), F.col(f"f{r.bit}").alias("failing"),
            F.col(f"a_{v}_{r.bit}").alias("alone"), F.col(f"rejected_{v}").alias("rejected"),
        )
        for v, r in cases
    ]
    return rows.agg(*sums).select(F.inline(F.array(*entry)))
