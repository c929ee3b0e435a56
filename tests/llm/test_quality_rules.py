"""Quality rules: base figures against plain Python, line rules, odd rows, no Python in the plan."""

import random
import re

from ampere.llm import quality_rules


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_base_figures(spark):
    r = random.Random(6)
    parts = ["a", "b", "the", "|", "#x", "\n", " ", "\t", "\r\n", "é<", "end.", "\x0b", " ", "　"]
    texts = ["".join(r.choice(parts) + r.choice([" ", "\n", ""]) for _ in range(r.randint(0, 150))) for _ in range(60)]
    texts += [None, "", " \n ", "one", "x y", "a b c a b c", "a a a a a"]
    df = spark.createDataFrame([(i, t, "x", True) for i, t in enumerate(texts)],
                               "doc_id long, text string, kept string, _t boolean")
    out = quality_rules.clean_lines(df)
    assert out.columns[:3] == ["doc_id", "text", "_t"]
    for x in out.collect():
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == base(texts[x.doc_id])
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_rules(spark):
    good = "A plain sentence of some length that ends as sentences do."
    bad = ["home | about | contact | login", "Home Login Search", "BUY!! NOW!! CHEAP!! THINGS!!", "Read more",
           "we use $$$ and %%% and ### and &&& here ***.", "All Rights Reserved by somebody in a long line here."]
    prose = [" ".join(f"{w}{i}" for w in f"{good} And more words make this line its own.".split()) + "."
             for i in range(12)]
    text = "\n".join([prose[0], bad[0], *prose[1:4], "", *bad[1:], *prose[4:]])
    row = quality_rules.clean_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.clean_text == "\n".join([*prose[:4], "", *prose[4:]]) and row.kept
    lost = "\n".join([prose[0], *[f"{b} {i}" if b != bad[1] else b for i, b in enumerate(bad * 9)]])
    assert not quality_rules.clean_lines(spark.createDataFrame([(1, lost)], "doc_id long, text string")).first().kept


def test_filter_keeps_columns(spark):
    text = "\n".join(" ".join(f"{w}{i}" for w in "This line says something of its own".split()) + "." for i in range(9))
    df = spark.createDataFrame([(1, text, 3, "x"), (2, None, 0, "y"), (None, text, None, None)],
                               "doc_id long, text string, n_chars int, kept string")
    out = quality_rules.keep_clean(df)
    assert out.schema == df.schema or out.columns == df.columns
    assert [r.n_chars for r in out.collect()] == [len(text)] * 2
    assert quality_rules.keep_clean(df.limit(0)).count() == 0
