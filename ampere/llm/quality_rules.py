"""Line-first cleaning, in DataFrame functions only.

Every line of a text is judged by rules on punctuation, navigation and boilerplate; lines
that fail are removed, and a document that loses too much of its text that way, or that
fails the document-wide base rules, is rejected.

Line rules (a line without a word is layout and always stays):

* punctuation: three or more runs like ``!!``, or more than a tenth of the characters from
  ``#*$%&|<>``, or a short line without closing punctuation;
* navigation: separators between most words, or a line of a few words that are all menu
  entries;
* boilerplate: a phrase from the list of notices.

Base rules: fewer than 50 words, or more than half the words inside 3-word windows that
occur twice or more.

Defined results: a null or blank text has no words, fails the base rules and has an empty
clean text; repeated rows are judged one by one; an input column named like an added one is
replaced; other columns pass through unchanged. All work is per row, so no key can be hot
and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import SPACE, Scratch, fresh, without, word_array

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST_SHARE = 0.3
SYMBOLS = "[#*$%&|<>]"

# Phrases of notices, and words of menus.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "copyright (c)", "enable javascript",
    "licensed under", "privacy policy", "subscribe to our newsletter", "terms of service",
    "terms of use", "this site uses cookies", "use of cookies",
)
MENU = ("about", "account", "blog", "cart", "contact", "faq", "help", "home", "login", "logout",
        "menu", "news", "next", "previous", "products", "register", "search", "share",
        "sitemap", "skip", "top", "us")

ADDED = ("clean_text", "lost_share", "n_words", "word_chars", "n_symbols", "n_dup_lines",
         "n_repeat_words", "base_failed", "kept")


CLOSING = tuple(".!?:;…。！？\"'”’»)]")
SEPARATOR = "[|›»·>/•]"


def text_flags(text: Column) -> Column:
    """What a text holds anywhere, so that most rules need not look at its lines at all."""
    low = F.lower(text)
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | F.contains(low, F.lit(phrase))
    marks = F.lit(False)
    for pair in ("!!", "??", "!?", "?!"):
        marks = marks | F.contains(text, F.lit(pair))
    return F.struct(marks.alias("marks"), text.rlike(SYMBOLS).alias("symbols"),
                    text.rlike(SEPARATOR).alias("separators"), notice.alias("notice"))


def line_fails(line: Column, flags: Column) -> Column:
    """True where a line with a word breaks a line rule."""
    n_words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    symbols = F.char_length(line) - F.char_length(F.translate(line, SYMBOLS[1:-1], ""))
    bare = F.btrim(line, F.lit(SPACE))
    punctuation = (
        (flags["marks"] & (F.regexp_count(line, F.lit(r"[!?]{2,}")) >= 3))
        | (flags["symbols"] & (symbols * 10 > F.char_length(line)))
        | (~F.right(bare, F.lit(1)).isin(*CLOSING) & (n_words < 8))
    )
    menu = "|".join(MENU)
    navigation = (
        (flags["separators"] & (F.regexp_count(
            line, F.lit(rf"(?:^|[\x20\x09]){SEPARATOR}(?=[\x20\x09]|$)")) * 3 >= n_words))
        | line.rlike(rf"(?i)^[\x20\x09-\x0D]*(?:{menu})(?:[\x20\x09|›»·>/•]+(?:{menu})){{0,11}}"
                     r"[\x20\x09-\x0D]*$")
    )
    phrases = "|".join(p.replace("(", r"\(").replace(")", r"\)") for p in BOILERPLATE)
    return punctuation | navigation | (flags["notice"] & line.rlike(f"(?i)(?:{phrases})"))


def clean_lines(docs: DataFrame, text: str = "text",
                max_lost_share: float = MAX_LOST_SHARE) -> DataFrame:
    """Add the clean text, the base figures and the verdict (see ADDED) to every row."""
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    names = [*docs.columns, *ADDED]
    t, words, lines, flags, bad, grams, runs, at, lost = (fresh(names, f"_{x}") for x in (
        "t", "words", "lines", "flags", "bad", "grams", "runs", "at", "lost"))
    col = lambda name: F.col(f"`{name}`")
    has_word = lambda x: F.btrim(x, F.lit(SPACE)) != ""

    df = docs.select(*without(docs, ADDED), F.coalesce(docs[f"`{text}`"], F.lit("")).alias(t))
    df = df.select("*", word_array(col(t)).alias(words), text_flags(col(t)).alias(flags),
                   F.filter(F.split(col(t), "\n"), has_word).alias(lines))
    df = df.select(
        "*",
        F.filter(col(lines), lambda x: line_fails(x, col(flags))).alias(bad),
        F.when(F.size(col(words)) >= 3, F.transform(
            F.sequence(F.lit(1), F.size(col(words)) - 2),
            lambda i: F.xxhash64(F.element_at(col(words), i), F.element_at(col(words), i + 1),
                                 F.element_at(col(words), i + 2)))
               ).otherwise(F.array().cast("array<bigint>")).alias(grams))
    # Windows with their places, equal ones side by side; only where some window repeats.
    df = df.select("*", F.when(
        F.size(F.array_distinct(col(grams))) < F.size(col(grams)),
        F.sort_array(F.transform(col(grams), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias(runs))
    df = df.select("*", F.sort_array(F.transform(
        F.filter(col(runs), lambda x, j: (F.get(col(runs), j - 1)["h"] == x["h"])
                 | (F.get(col(runs), j + 1)["h"] == x["h"])),
        lambda x: x["i"])).alias(at))
    repeat = F.aggregate(
        F.transform(col(at), lambda x, j: F.least(
            F.lit(3), F.coalesce(F.get(col(at), j + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    chars = lambda parts: F.char_length(F.array_join(parts, ""))
    cleaned = F.array_join(F.filter(
        F.split(col(t), "\n"), lambda x: ~has_word(x) | ~line_fails(x, col(flags))), "\n")
    df = df.select(
        *(col(c) for c in keep),
        F.when(F.size(col(bad)) == 0, col(t)).otherwise(cleaned).alias("clean_text"),
        F.size(col(words)).cast("long").alias("n_words"),
        chars(col(words)).cast("long").alias("word_chars"),
        F.regexp_count(col(t), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(col(lines)) - F.size(F.array_distinct(col(lines)))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        F.char_length(F.translate(F.array_join(col(bad), ""), SPACE, "")).alias(lost))
    df = df.select(
        "*",
        ((col("n_words") < MIN_WORDS)
         | (100 * col("n_repeat_words") > MAX_REPEAT_PCT * col("n_words"))).alias("base_failed"),
        F.when(col("word_chars") == 0, F.lit(0.0)).otherwise(
            col(lost) / col("word_chars")).alias("lost_share"))
    df = df.select("*", (~col("base_failed") & (col("lost_share") <= max_lost_share)).alias("kept"))
    return df.select(*(col(c) for c in keep), *(col(c) for c in ADDED))


def keep_clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their clean text; ``n_chars``, if there, follows it."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{text}`").alias("text"))
    judged = clean_lines(rows)
    out = []
    for c in docs.columns:
        if c.lower() == text.lower():
            out.append(F.col("clean_text").alias(c))
        elif c.lower() == "n_chars":
            out.append(F.char_length("clean_text").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    # Written before the verdict filters: Catalyst would push the filter below the projections
    # and inline each of them into it, over and over.
    flag = fresh(docs.columns, "_kept")
    written = Scratch(docs.sparkSession, "quality").write(judged.select(*out, F.col("kept").alias(flag)))
    return written.filter(F.col(flag)).drop(flag)
