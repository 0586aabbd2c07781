"""Alignment against a plain version that holds both token lists of every text."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
from test_llm_operators import SF, docs, empty, rows, same  # noqa: F401

from vacancia.llm import alignment, bpe, queries

A, B = bpe.default_path(), bpe.default_path("piece_bpe_32k.model")


def library_tokens(texts):
    """For each text both lists of (id, bytes), from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {c: x for x, c in bpe.BYTE_CHARS.items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    out = []
    for t in texts:
        of_a = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        of_b = [(i, piece(i)) for i in b.encode(t)] if t else []
        data = (" " + t).encode() if t else b""
        whole = all(b"".join(x for _, x in side) == data for side in (of_a, of_b))
        out.append((of_a, of_b) if t and whole else ([], []))
    return out


def slow_align(rows):  # noqa: F811
    tokens = library_tokens([t or "" for _, t in rows])
    count, texts = Counter(), []
    for a, b in tokens:
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]).tolist(), np.cumsum([len(x) for _, x in b]).tolist()
        of_b = {y: k for k, y in enumerate(ends_b)}
        shared = [(i, of_b[x]) for i, x in enumerate(ends_a) if x in of_b]
        links = [(a[i][0], b[j][0]) for i, j in shared]
        count.update(links)
        groups, x, y = [], 0, 0
        for i, j in shared:
            groups.append(",".join(str(n) for n, _ in a[x : i + 1]) + "|" + ",".join(str(n) for n, _ in b[y : j + 1]))
            x, y = i + 1, j + 1
        texts.append((links, ";".join(groups), len(groups)))
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [
        (d, len(a), len(b), n, len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), groups)
        for (d, _), (a, b), (links, groups, n) in zip(rows, tokens, texts)
    ]


ODD = [
    (30_000, "a▁b is not given back"), (30_001, "<s> <0x0A> <unk></s> text"), (30_002, "   three spaces   inside   and after   "), (30_003, "\n \n\t x"), (30_004, "naïve 日本語 \U0001f600 \x00 end"),
    (30_005, " "), (30_006, "▁"), (30_007, "no " * 40 + "supercalifragilisticexpialidocious" * 5), (30_008, "<|endoftext|>"),
]


def test_align(spark, docs, rows, empty):  # noqa: F811
    whole = docs.unionByName(spark.createDataFrame([(d, t, "en", "s", 1, 2, 3, "k", 4, 5) for d, t in ODD], docs.schema))
    short = [(d, t) for d, t in rows + ODD if len(t or "") < 3000]
    some = whole.where("text is null or length(text) < 3000")
    want = slow_align(short)
    assert {w[0] for w in want if w[1] == 0} >= {30_000, 30_006, None}
    for piece in (alignment.PIECE, 100, 7):
        same(alignment.align(some, A, B, piece=piece).collect(), want)
    assert alignment.align(empty, A, B).collect() == []


def test_query_on_given_table(spark):
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(*w[:-1], sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in slow_align(base)]
    same(queries.op11_token_alignment(spark, SF).collect(), want)


def test_tokens_of_random_texts():
    random.seed(2)
    parts = ["a", " ", " ", "  ", "\n", "\t", ".", "é", "12", "'s", "\x1c", "\xa0", "<s>", "Foo", "!!", "\r\n", "日", "ing", "▁", "\x00", "ﬁ", "́", ",", "word. Then", "(x)?", "end:", "<|endoftext|>"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(4000)]
    want = [([i for i, _ in a], [i for i, _ in b]) for a, b in library_tokens(texts)]
    assert [(a.tolist(), b.tolist()) for a, b in alignment.tokens(A, B).encode(texts)] == want


def test_crossings():
    """Pieces meet each other, take every end once and never part an end that both lists have."""
    r = np.random.default_rng(4)
    for _ in range(300):
        a, b = (np.unique(r.integers(1, 200, r.integers(1, 60))) for _ in range(2))
        merged = sorted([(x, 0, i) for i, x in enumerate(a)] + [(x, 1, i) for i, x in enumerate(b)])
        for d in range(len(merged) + 1):
            i, j = alignment.crossing(a, b, d)
            took = {(x, s) for x, s, _ in merged[:d]}
            extra = {(a[i - 1], 1)} if i and j and a[i - 1] == b[j - 1] else set()
            assert {(x, 0) for x in a[:i]} | {(x, 1) for x in b[:j]} in (took, took | extra)
            assert not (0 < i and j < len(b) and a[i - 1] == b[j]) and not (0 < j and i < len(a) and b[j - 1] == a[i])
