"""Context-tree weighting against a direct recursion over a small corpus."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ampere.llm import context_tree

D = context_tree.DEPTH


def decisions(text):
    """(context bytes nearest first, bits so far, bit) of every binary decision."""
    b = bytes(D) + text + b"\0"
    for t in range(D, len(b)):
        ctx, bits = b[t - D:t][::-1], ""
        for k in range(7, -1, -1):
            bit = (b[t] >> k) & 1
            yield ctx, bits, bit
            bits += str(bit)


def brute(texts, train):
    counts = Counter()
    for t, learn in zip(texts, train, strict=True):
        if learn:
            for ctx, bits, bit in decisions(t):
                for d in range(D + 1):
                    counts[ctx[:d], bits, bit] += 1
    children = {}
    for ctx, bits, _ in counts:
        if ctx:
            children.setdefault((ctx[:-1], bits), set()).add(ctx)
    memo = {}

    def kt(ctx, bits):
        a, b = counts[ctx, bits, 0], counts[ctx, bits, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(ctx, bits):
        """Log block probability and the share of the own estimate."""
        if (ctx, bits) not in memo:
            own = kt(ctx, bits)
            if len(ctx) == D:
                memo[ctx, bits] = own, 1.0
            else:
                below = sum(weighted(c, bits)[0] for c in children[ctx, bits])
                m = max(own, below)
                memo[ctx, bits] = (m + math.log(math.exp(own - m) / 2 + math.exp(below - m) / 2),
                                   1 / (1 + math.exp(min(700, below - own))))
        return memo[ctx, bits]

    def one(ctx, bits, d=0):
        a, b = counts[ctx[:d], bits, 0], counts[ctx[:d], bits, 1]
        if a + b == 0:
            return None
        own = (b + .5) / (a + b + 1)
        deeper = one(ctx, bits, d + 1) if d < D else None
        if deeper is None:
            return own
        share = weighted(ctx[:d], bits)[1]
        return share * own + (1 - share) * deeper

    scores = []
    for t in texts:
        s = 0.0
        for ctx, bits, bit in decisions(t):
            p = one(ctx, bits)
            p = .5 if p is None else p
            s += math.log10(p if bit else 1 - p)
        scores.append(s)
    tokens = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", t)] + [None] for t in texts]
    c = Counter(w for ws, learn in zip(tokens, train, strict=True) if learn for w in ws)
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) for ws in tokens]
    return scores, base, n, [(len(ws), sum(c[w] > 0 for w in ws)) for ws in tokens]


@pytest.mark.parametrize("block,fan", [(1 << 20, 256), (150, 256), (150, 3)])
def test_equals_the_recursion(spark, block, fan):
    r = random.Random(2)
    words = ["the", "The", "cat", "ñu", "sat", "on", "a\tmat", "hat.\n"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(40)] + [None, "", "zzz \0 q"]
    train = [i % 3 != 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i % 30, t, x, i) for i, (t, x) in enumerate(zip(texts, train, strict=True))],
                               "doc_id long, text string, learn boolean, row int").withColumn("v", F.lit(1)).withColumn("score", F.lit("x"))
    got = {x.row: x for x in context_tree.score(df, F.col("learn"), block_bytes=block, fan=fan).collect()}
    scores, base, n, tokens = brute([(t or "").encode() for t in texts], train)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].score == pytest.approx(scores[i], rel=1e-5, abs=1e-5)
        assert got[i].base_score == pytest.approx(base[i], rel=1e-9, abs=1e-9)
        assert (got[i].n_tokens, got[i].n_known) == tokens[i] and got[i].train_tokens == n


def test_without_training_and_without_rows(spark):
    df = spark.createDataFrame([(1, "ab"), (None, None)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.score, r.train_tokens) for r in context_tree.score(df, F.lit(False)).collect())
    assert got[0][1] == pytest.approx(8 * math.log10(.5)) and got[1][1] == pytest.approx(24 * math.log10(.5))
    assert context_tree.score(df.limit(0), F.lit(True)).count() == 0


def test_held_out_texts_beat_the_word_base(spark):
    from ampere.llm.queries import op2_context_tree_scoring
    held = [r for r in op2_context_tree_scoring(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
