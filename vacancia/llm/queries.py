"""The document queries, as they are registered: name -> (spark, folder of tables) -> rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import alignment, bpe, decontamination, language_id, line_dedup, merkle_manifest, ngram_lm, packing, quality_classifier, quality_rules, sharding
from vacancia.llm import simhash_dedup, token_counts, token_files
from vacancia.llm.common import fold, read_documents
from vacancia.session import work_dir


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_documents(spark, sf_dir), bpe.default_path(), limit=512)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_documents(spark, sf_dir), bpe.default_path(), size=2048, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels.where(fold("doc_id", 5) != 0))
    scored = quality_classifier.score_quality(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(read_documents(spark, sf_dir), width=4)


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = fold("doc_id", 7) == 2
    model = ngram_lm.train(docs.where(~held_out).select("text"))
    scored = ngram_lm.score(docs, held_out, model)
    model.release()
    return scored


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = language_id.train(docs.where(fold("doc_id", 4) != 2))
    found = language_id.identify(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_documents(spark, sf_dir), shards=8)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "token-files")
    token_files.write_ids(read_documents(spark, sf_dir), target, bpe.default_path(), end_id=0)
    return token_files.read_ids(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kept`` is policy v2's verdict; failed_bits holds the rest of the ledger."""
    rows = quality_rules.apply_policy(quality_rules.ledger(read_documents(spark, sf_dir)), "v2")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality_rules.fails_policy("v1").alias("base_failed"), "kept", "failed_bits"
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``groups_sha256`` is the hash of the groups' list; of a text without tokens, the empty text."""
    aligned = alignment.align(read_documents(spark, sf_dir), bpe.default_path(), bpe.default_path("piece_bpe_32k.model"))
    return aligned.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is checked; rows where 7 divides the id's crc32 are checked with n_chars one too high."""
    own = merkle_manifest.leaf_hash()
    tampered = merkle_manifest.leaf_hash({"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1})
    manifest = merkle_manifest.build(read_documents(spark, sf_dir), F.when(fold("doc_id", 7) == 0, tampered).otherwise(own))
    found = merkle_manifest.proofs(manifest, spark)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_holders``: documents that hold the most frequent of a document's dropped lines."""
    kept = line_dedup.drop_repeated_lines(read_documents(spark, sf_dir), min_docs=3, least=20)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"), "n_holders")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_packing, op3_quality_classifier, op4_simhash_dedup, op5_ngram_lm, op6_language_id, op7_sharding, op8_token_files,
        op9_decontamination, op10_quality_rules, op11_token_alignment, op12_merkle_manifest, op13_line_dedup,
    )
}

_WORD = "[^\\x20\\x09-\\x0D]+"
_BLANK = "[\\x20\\x09-\\x0D]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _field(value: str) -> str:
    return f"case when {value} is null then '-' else octet_length(encode(cast({value} as varchar))) || ':' || {value} end"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLES = {
    # Each measurement is derived from word and line lists; windows are compared as joined text.
    "op10_quality_rules": rf"""
with t as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
w as (select row, doc_id, text, regexp_extract_all(text, '{_WORD}') as words from t),
win as (
  select row, i, array_to_string(words[i:i+4], ' ') as win
  from (select row, words, unnest(range(1, greatest(len(words) - 3, 1))) as i from w)
),
dup as (select row, i from (select row, i, count(*) over (partition by row, win) as n from win) where n > 1),
rep as (select row, count(distinct i + k) as n_repeat_words from dup, range(5) as r(k) group by row),
line as (select row, unnest(string_split(text, chr(10))) as line from t),
dups as (
  select row, sum(n) as n_lines, sum(n - 1) as n_dup_lines
  from (select row, line, count(*) as n from line where regexp_matches(line, '{_WORD}') group by row, line) group by row
),
m as (
  select doc_id, len(words) as n_words, cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) as n_upper,
    length(text) - length(regexp_replace(text, '[.!?]', '', 'g')) as n_stops
  from w left join rep using (row) left join dups using (row)
),
b as (
  select *, (n_words < 10)::int as r0, (100 * n_repeat_words > 20 * n_words)::int as r1, (10 * n_symbols > n_words)::int as r2,
    (10 * n_dup_lines > 3 * n_lines)::int as r3, (word_chars > 12 * n_words)::int as r4, (word_chars < 2 * n_words)::int as r5,
    (2 * n_upper > word_chars)::int as r6, (n_words >= 100 and 100 * n_stops < n_words)::int as r7
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 + r1 > 0 as base_failed, r0 + r1 + r2 + r3 + r6 = 0 as kept,
  cast(r0 + 2 * r1 + 4 * r2 + 8 * r3 + 16 * r4 + 32 * r5 + 64 * r6 + 128 * r7 as bigint) as failed_bits
from b
""",
    # crc holds the id's CRC-32, digit by digit; up and top grow the trees level by level; steps are the proofs, folded from below.
    "op12_merkle_manifest": f"""
with recursive d as (select row_number() over () as row, * from documents),
bits as (
  select unnest(range(256)) as byte, 0 as k, unnest(range(256)) as v
  union all select byte, k + 1, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8
),
crc as (
  select row, cast(doc_id as varchar) as rest, 4294967295::bigint as c from d
  union all select row, substr(rest, 2), xor(c >> 8, v) from crc join bits on k = 8 and byte = xor(c & 255, ascii(rest)) where rest <> ''
),
leaves as (
  select row, doc_id, coalesce('=' || lang, '') as tree, {_leaf('n_chars')} as leaf, case when xor(c, 4294967295) % 7 = 0 then {_leaf('(n_chars + 1)')} else {_leaf('n_chars')} end as claim
  from d join (select row, c from crc where coalesce(rest, '') = '') using (row)
),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n from leaves
),
up as (
  select tree, 0 as level, idx, leaf as node, n from placed
  union all select tree, level + 1, idx // 2, sha256(string_agg(node, '' order by idx)), (max(n) + 1) // 2 from up where n > 1 group by tree, level, idx // 2
),
subroots as (
  select tree, node as subroot, level as height, row_number() over (order by tree) - 1 as top_idx, count(*) over () as tops from up where n = 1
),
top as (
  select 0 as level, top_idx as idx, subroot as node, tops as n from subroots
  union all select level + 1, idx // 2, sha256(string_agg(node, '' order by idx)), (max(n) + 1) // 2 from top where n > 1 group by level, idx // 2
),
lower_steps as (
  select row, s.level as step, (s.idx >> s.level) % 2 as turn, u.node as sibling
  from (select row, tree, idx, unnest(range(height)) as level from placed join subroots using (tree)) s
  left join up u on u.tree = s.tree and u.level = s.level and u.idx = xor(s.idx >> s.level, 1)
),
upper_steps as (
  select row, height + s.level as step, (s.top_idx >> s.level) % 2 as turn, t.node as sibling
  from (select row, height, top_idx, unnest(range((select max(level) from top))) as level from placed join subroots using (tree)) s
  left join top t on t.level = s.level and t.idx = xor(s.top_idx >> s.level, 1)
),
steps as (select * from lower_steps union all select * from upper_steps),
folded as (
  select row, 0 as step, claim as x from placed
  union all
  select f.row, f.step + 1, case when s.sibling is null then sha256(f.x) when s.turn = 1 then sha256(s.sibling || f.x) else sha256(f.x || s.sibling) end
  from folded f join steps s on s.row = f.row and s.step = f.step
)
select doc_id, leaf, subroot, node as root, sha256(coalesce(siblings, '')) as proof_sha256, x as folded_root, x = node as verified
from placed join subroots using (tree) join (select node from top where n = 1) on true
  left join (select row, string_agg(sibling, '' order by step) as siblings from steps group by row) using (row)
  join (select row, arg_max(x, step) as x from folded group by row) using (row)
""",
    "op13_line_dedup": f"""
with t as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
l as (select row, doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from t),
k as (select *, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_UPPER}', '{_UPPER.lower()}') as key from l),
h as (select key, count(distinct row) as n, max(doc_id) as last from k where length(key) >= 20 group by key having count(distinct row) >= 3),
m as (select k.*, h.n, h.n is not null and h.last is distinct from k.doc_id as gone from k left join h using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256, coalesce(max(n) filter (where gone), 0) as n_holders
from m group by row, doc_id
""",
}
