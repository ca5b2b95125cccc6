r"""Line-first cleaning by rules, in DataFrame functions only.

Every line with a word is judged on its own; failing lines are removed, and a document that
loses more than `LineRules.max_lost_percent` of its word characters is rejected. Line rules:

* punctuation: `min_bare_words` words or more without any sentence mark, or doubled marks such
  as `!!` or `$$$` once per `noise_every` words or more;
* navigation: separators (`|`, `>` and the like, standing alone) once per `separator_every`
  words or more, or at most `max_menu_words` words that begin with a menu term;
* boilerplate: the line holds one of `boilerplate`, in any case.

Base figures of a text: words are runs of `[^\x20\x09-\x0D]`; a line repeats if it has a word
and equals an earlier line; a word repeats if a window of three words around it occurs twice or
more in the text. A document fails the base if it has fewer than `min_words` words or more than
half of its words repeat.

All work is within a row: no shuffle, so neither sources nor copies can be hot. Repeated windows
are found by sorting their hashes (n log n), whatever the length of the text.

Cases: a null text is empty, has no words and fails the base; a null id is kept as it is; repeated
rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.llm.text import word_list

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    min_bare_words: int = 8
    noise_every: int = 4
    separator_every: int = 4
    max_menu_words: int = 4
    max_lost_percent: int = 50
    sentence_mark: str = r"[.,;:!?…。，！？]"
    noise: str = r"[!?#*$%&|<>~=]{2,}"
    separator: str = r"(^|[\x20\x09])[|>»›•/]($|[\x20\x09\r])"
    menu: str = (
        r"^[\x20\x09]*(home|menu|log ?in|sign (in|up|out)|register|search|contact us|about us|"
        r"next page|previous page|back to top|share this|read more|site ?map)([\x20\x09\r]|$)"
    )
    boilerplate: tuple[str, ...] = (
        "all rights reserved",
        "terms of use",
        "terms of service",
        "privacy policy",
        "cookie policy",
        "accept cookies",
        "enable javascript",
        "lorem ipsum",
        "click here",
        "subscribe to our",
    )


def line_fails(line: Column, rules: LineRules) -> Column:
    n = F.regexp_count(line, F.lit(WORD))
    low = F.lower(line)
    bare = (n >= rules.min_bare_words) & ~line.rlike(rules.sentence_mark)
    noisy = F.regexp_count(line, F.lit(rules.noise)) * rules.noise_every >= n
    parted = F.regexp_count(line, F.lit(rules.separator)) * rules.separator_every >= n
    menu = (n <= rules.max_menu_words) & low.rlike(rules.menu)
    fails = bare | noisy | parted | menu
    for phrase in rules.boilerplate:
        fails = fails | low.contains(phrase)
    return fails


def word_chars(text: Column) -> Column:
    return F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))


def repeated_words(df: DataFrame, words: str, out: str, few: int = 32) -> DataFrame:
    """Add the number of words in windows of three that occur twice or more in the array `words`.

    Positions of repeated windows come from a short list of their hashes where there are at most
    `few` of them, and from sorted (hash, position) pairs otherwise; both are exact.
    """
    kept = df.columns
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(
        "_g",
        F.transform(
            F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("_h", i + 1), F.get("_h", i + 2)),
        ),
    )
    df = df.withColumn("_s", F.sort_array("_g"))
    df = df.withColumn(
        "_d", F.array_distinct(F.filter("_s", lambda x, i: x == F.get("_s", i - 1)))
    )
    many = F.size("_d") > few
    df = df.withColumn(
        "_e",
        F.when(
            many, F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        ),
    )
    listed = F.filter(
        F.transform("_g", lambda x, i: F.when(F.array_contains("_d", x), i)),
        lambda i: i.isNotNull(),
    )
    neighbours = F.sort_array(
        F.transform(
            F.filter(
                "_e",
                lambda e, k: e["x"].eqNullSafe(F.get("_e", k - 1)["x"])
                | e["x"].eqNullSafe(F.get("_e", k + 1)["x"]),
            ),
            lambda e: e["i"],
        )
    )
    none = F.array().cast("array<int>")
    df = df.withColumn(
        "_p", F.when(F.size("_d") == 0, none).when(many, neighbours).otherwise(listed)
    )
    total = F.aggregate(
        F.transform("_p", lambda p, k: F.coalesce(F.least(F.get("_p", k + 1) - p, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda a, b: a + b,
    )
    return df.select(*kept, total.cast("long").alias(out))


def clean_documents(df: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """doc_id, base figures, base_failed, kept, cleaned (the text without failed lines), lost_chars."""
    rules = rules or LineRules()
    df = df.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = df.withColumn("_words", word_list(F.col("_text")))
    df = df.withColumn("_lines", F.split("_text", "\n", -1))
    df = df.withColumn(
        "_full", F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    df = df.withColumn("_passed", F.filter("_full", lambda x: ~line_fails(x, rules)))
    df = df.withColumn("cleaned", F.array_join("_passed", "\n"))
    df = repeated_words(df, "_words", "n_repeat_words")
    df = df.select(
        "doc_id",
        "cleaned",
        F.size("_words").cast("long").alias("n_words"),
        word_chars(F.col("_text")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    df = df.withColumn("lost_chars", F.col("word_chars") - word_chars(F.col("cleaned")))
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    lost = 100 * F.col("lost_chars") > rules.max_lost_percent * F.col("word_chars")
    return df.select("*", base_failed.alias("base_failed"), (~base_failed & ~lost).alias("kept"))
