"""Benchmark decontamination by template windows.

A text becomes a template: words that hold a digit become numbers (5km counts as
5 km), unit words after a number become units, words with a capital first letter inside a sentence
become names; all else is lower-cased without
punctuation. In a second template the capitalised words that begin a sentence are names too.
Windows of `size` template words with at least `min_literal` literal words are hashed, and windows
of the plain lower-cased words whatever they hold; document windows meet benchmark windows by a
hash join. The slots of an alignment
(document, item, shift) are consistent if one value of the item always stands for one value of
the document, over all matched windows of one, two or all three kinds. Re-parameterised questions pass, texts that share
phrases around unrelated slots do not. A document is contaminated by an item if the windows of
a consistent alignment cover `percent` of the item's words or more, or `long` words in a row.
The windows whose slots hold the item's own values are measured alone too, so that a slot that
contradicts them elsewhere does not hide a copied passage.

All steps are DataFrame functions. The texts of documents are taken apart in place, a row a position, so that their
windows are hashed in generated code, and windows whose bit the benchmark's windows do not set (`keyfilter`) end
there; the others end at the join, unless a benchmark window is equal. The benchmark's windows are counted before: up to `broadcast_rows` they are broadcast, beyond that
both sides are shuffled by the hash and adaptive execution splits hot windows.

Cases: null and empty texts have no windows; items with fewer words than `size` are one window of
all their words; windows and items with fewer than `min_literal` literal words are only found as
copies, so an item of one word is in every document that has the word;
a null document or item id is kept as null; rows equal in id and text share their result, and
repeated items are found once; an empty benchmark finds nothing; other columns are kept by
`clean`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.llm.keyfilter import bit_table, that_may_hold
from flagstone.llm.text import fresh, word_list
from flagstone.sources.scratch import staged


@dataclass(frozen=True)
class TemplateRules:
    size: int = 8
    min_literal: int = 5
    percent: int = 50
    long: int = 13
    broadcast_rows: int = 500_000
    # Fixed: the unit words that may follow a number.
    units: tuple[str, ...] = (
        "mm", "cm", "m", "km", "g", "kg", "mg", "l", "ml", "s", "ms", "min", "h", "kmh", "mph",
        "meter", "meters", "metre", "metres", "mile", "miles", "foot", "feet", "inch", "inches",
        "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "litre", "litres", "liter",
        "liters", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days",
        "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros",
        "percent", "degrees", "watt", "watts", "volt", "volts",
    )


# One private character before a slot's value; a template has the character alone.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
# Before a capitalised word that begins a sentence: a literal in one template, a name in the other.
INITIAL = "\ue003"
# Kinds of windows, as bits: of the two templates and of plain words.
LITERAL, NAMED, PLAIN = 1, 2, 4
_SLOT = f"[{NUMBER}-{UNIT}]"
_BLANK = r"\x20\x09-\x0D"


def _has_slot(text: Column) -> Column:
    return text.contains(NUMBER) | text.contains(NAME) | text.contains(UNIT)


def _unmarked(text: Column) -> Column:
    for mark in (NUMBER, NAME, UNIT, INITIAL):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def with_slots(df: DataFrame, rules: TemplateRules) -> DataFrame:
    """Replace `text` by `slots`: in lower case, no punctuation, a mark before each slot's value.

    Patterns that need a mark or a digit are only tried on texts that have one.
    """
    units = "|".join(sorted(rules.units, key=len, reverse=True))
    out = F.coalesce("text", F.lit(""))
    out = F.when(_has_slot(out) | out.contains(INITIAL), _unmarked(out)).otherwise(out)
    out = F.regexp_replace(
        out, r"(\p{Lu})(?<=[\p{L}\p{N},;] \p{Lu})(\p{Ll}+)", f"{NAME}$1$2"
    )
    inside = rf"(?<![\p{{L}}\p{{M}}\p{{N}}{NAME}]\p{{Lu}})(?<![\p{{L}}\p{{M}}\p{{N}}][^{_BLANK}]\p{{Lu}})"
    out = F.regexp_replace(out, rf"(\p{{Lu}}){inside}(\p{{Ll}}+)", f"{INITIAL}$1$2")
    df = df.withColumn("_low", F.lower(out))
    low = F.col("_low")
    split = F.regexp_replace(
        low, rf"(?<![\p{{L}}\p{{N}}])([0-9][0-9.,]*)({units})(?![\p{{L}}\p{{N}}])", "$1 $2"
    )
    marked = F.regexp_replace(
        split, rf"(?<![^{_BLANK}])([^{_BLANK}0-9]*+[0-9][^{_BLANK}]*)", f"{NUMBER}$1"
    )
    marked = F.regexp_replace(
        marked, rf"({NUMBER}[^{_BLANK}]* )({units})(?![\p{{L}}\p{{N}}])", f"$1{UNIT}$2"
    )
    out = F.when(low.rlike("[0-9]"), marked).otherwise(low)
    bare = F.regexp_replace(out, rf"[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{INITIAL}{_BLANK}]+", "")
    return df.withColumn("slots", bare).drop("text", "_low")


def template(slots: Column) -> Column:
    short = F.regexp_replace(slots, rf"({_SLOT})[^{_BLANK}]*", "$1")
    return F.when(_has_slot(slots), short).otherwise(slots)


def with_kinds(df: DataFrame) -> DataFrame:
    """Replace `slots` by `_plain`, `_literal` and `_named`: the text of each kind, with no blank but space."""
    slots = F.col("slots")
    spaced = slots
    for blank in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return df.withColumn("slots", spaced).withColumns(
        {
            "_plain": _unmarked(slots),
            "_literal": template(F.replace(slots, F.lit(INITIAL), F.lit(""))),
            "_named": template(F.replace(slots, F.lit(INITIAL), F.lit(NAME))),
        }
    ).drop("slots")


def with_words(df: DataFrame) -> DataFrame:
    """Replace `slots` by `_plain`, `_literal` and `_named`: hashes of the words of each kind."""

    df = with_kinds(df)
    return df.withColumns({c: F.transform(word_list(F.col(c)), lambda w: F.xxhash64(w)) for c in _KINDS})


_KINDS = {"_literal": LITERAL, "_named": NAMED, "_plain": PLAIN}


def with_windows(df: DataFrame, size: int) -> DataFrame:
    """Replace the word hashes of each kind by hashes of each run of `size` words.

    A run is hashed from two runs of half its length, which may overlap: a few steps a position whatever the size.
    """
    width = 1
    while width < size:
        step = min(width, size - width)
        df = df.withColumns({c: _joined(F.col(c), step) for c in _KINDS})
        width += step
    return df


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each value of an array and the one `step` places on."""
    room = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(
        F.slice(hashes, F.lit(1), room), F.slice(hashes, F.lit(step + 1), room), lambda x, y: F.xxhash64(x, y)
    )


_U = np.uint64
_PRIMES = [
    _U(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _xxhash64(*columns: np.ndarray) -> np.ndarray:
    """The same as `F.xxhash64` of columns of long, over unsigned arrays."""
    one, two, three, four, five = _PRIMES
    out = _U(42)
    for values in columns:
        out = (out + (five + _U(8))) ^ (_turned(values * two, 31) * one)
        out = _turned(out, 27) * one + four
        out = (out ^ (out >> _U(33))) * two
        out = (out ^ (out >> _U(29))) * three
        out ^= out >> _U(32)
    return out


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of `size` words, as `with_windows` has them: a plain version for the tests."""
    width = 1
    while width < size:
        step = min(width, size - width)
        hashes = _xxhash64(hashes[:-step], hashes[step:])
        width += step
    return hashes


def _run(words: Column, at: Column, size: int) -> Column:
    """The hash that `with_windows` has of `size` words from `at`; null beyond the last word."""

    def run(low: int, width: int) -> Column:
        if width == 1:
            return F.xxhash64(F.get(words, at + low))
        half = 1 << ((width - 1).bit_length() - 1)
        return F.xxhash64(run(low, half), run(low + width - half, half))

    return F.when(at + size <= F.size(words), run(0, size))


def candidates(texts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """_key, length, pos, hash: windows of the texts of all kinds that `windows` may hold, equal ones once."""
    # Cut at the one blank that `with_kinds` leaves, which needs no pattern; a text of two equal kinds is cut once.
    new = {"_plain": F.lit(True), "_literal": F.col("_literal") != F.col("_plain"),
           "_named": (F.col("_named") != F.col("_plain")) & (F.col("_named") != F.col("_literal"))}
    cut = {c: F.when(new[c], F.array_remove(F.split(c, " "), "")).alias(c) for c in _KINDS}
    listed = texts.select("_key", *cut.values())
    n = F.greatest(*[F.size(c) for c in _KINDS])  # nulls are passed over
    rows = listed.select("_key", *_KINDS, F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("pos"))
    names = {(c, size): f"{c}{size}" for size in sizes for c in _KINDS}
    rows = rows.select("_key", "pos", *[_run(F.col(c), F.col("pos"), size).alias(a) for (c, size), a in names.items()])
    found = []
    for size in sizes:
        literal, named, plain = [F.col(names[c, size]) for c in _KINDS]
        for hashed, others in ((plain, []), (literal, [plain]), (named, [plain, literal])):
            new = hashed.isNotNull()
            for other in others:
                new = new & ~hashed.eqNullSafe(other)
            found.append(F.when(new, F.struct(F.lit(size).alias("length"), hashed.alias("hash"))))
    held = F.array(*found).cast("array<struct<length:int,hash:bigint>>")  # no sizes: an array of nothing
    rows = rows.select("_key", "pos", F.explode(held).alias("_w")).where(F.col("_w").isNotNull())
    rows = rows.select("_key", "_w.length", "pos", "_w.hash")
    return that_may_hold(rows, bit_table(windows, "hash"), "hash")


def _windows() -> Column:
    """The hashes of each kind, for every position."""
    return F.arrays_zip(*[F.col(c).alias(c) for c in _KINDS])


def item_windows(benchmark: DataFrame, rules: TemplateRules) -> DataFrame:
    """length, hash, kind, whole, item_id, item (hash of its slots), at, n, tokens, named: windows of the items.

    A window is listed once if its kinds agree; `whole` is a plain window of all words of a short item.
    """
    items = with_slots(benchmark.select("item_id", "text"), rules)
    slots = F.col("slots")
    items = items.withColumns(
        {
            "item": F.xxhash64("item_id", "slots"),
            "tokens": word_list(F.replace(slots, F.lit(INITIAL), F.lit(""))),
            "named": word_list(F.replace(slots, F.lit(INITIAL), F.lit(NAME))),
        }
    )
    items = with_words(items).withColumn("n", F.size("tokens"))

    def literals(tokens: str, size: int) -> Column:
        held = F.slice(tokens, F.col("at") + 1, F.lit(size))
        return F.size(F.filter(held, lambda w: ~w.rlike("^" + _SLOT)))

    parts = []
    for size in range(1, rules.size + 1):
        held = items.where(F.col("n") >= size) if size == rules.size else items.where(F.col("n") == size)
        held = with_windows(held, size)
        rows = held.select("item_id", "item", "tokens", "named", "n", F.posexplode(_windows()).alias("at", "_w"))
        whole = F.col("n") == size
        same = F.col("_w._plain") == F.col("_w._literal")
        enough = literals("tokens", size) >= rules.min_literal
        searched = {
            "_literal": enough & ~(whole & same),
            "_named": (F.col("_w._named") != F.col("_w._literal")) & (literals("named", size) >= rules.min_literal),
            "_plain": whole | ~same | ~enough,
        }
        kinds = [
            F.when(
                searched[c],
                F.struct(
                    F.col(f"_w.{c}").alias("hash"),
                    F.lit(kind).alias("kind"),
                    (whole & F.lit(kind == PLAIN)).alias("whole"),
                ),
            )
            for c, kind in _KINDS.items()
        ]
        rows = rows.withColumn("_k", F.explode(F.array_compact(F.array(*kinds))))
        parts.append(
            rows.select(F.lit(size).alias("length"), "_k.*", "item_id", "item", "at", "n", "tokens", "named")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.dropDuplicates(["item", "length", "at", "kind"])


def _matches(docs: DataFrame, windows: DataFrame, rules: TemplateRules) -> DataFrame:
    """_key, item, shift, at, length, kind, whole: windows of documents that are windows of items.

    Hashes of all kinds are compared with each other: only windows without slots have two equal ones.
    """
    counted = {r["length"]: r["count"] for r in windows.groupBy("length").count().collect()}
    sought = windows.select("length", "hash", "kind", "whole", "item", "at")
    if sum(counted.values()) <= rules.broadcast_rows:
        sought = F.broadcast(sought)
    texts = with_kinds(with_slots(docs.select("_key", "text"), rules))
    rows = candidates(texts, windows, sorted(counted))
    return rows.join(sought, ["length", "hash"]).select(
        "_key", "item", (F.col("pos") - F.col("at")).alias("shift"), "at", "length", "kind", "whole"
    )


def findings(documents: DataFrame, benchmark: DataFrame, rules: TemplateRules | None = None) -> DataFrame:
    """doc_id, item_id, covered_words, longest_run, item_words, n_slots, _key of contaminated documents."""
    rules = rules or TemplateRules()
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key"))
    windows = staged(item_windows(benchmark, rules), "item-windows")
    matches = _matches(docs, windows, rules)
    alignments = staged(
        matches.groupBy("_key", "item", F.when(~F.col("whole"), F.col("shift")).alias("_s"))
        .agg(
            F.min("shift").alias("shift"),  # one copy of a short item is enough
            F.sort_array(F.collect_set(F.struct("at", "length", "kind"))).alias("at"),  # at most 3 x its words
        )
        .drop("_s"),
        "alignments",
    )
    items = windows.groupBy("item").agg(
        F.first("item_id").alias("item_id"), F.first("n").alias("n"),
        F.first("tokens").alias("tokens"), F.first("named").alias("named"),
    )
    keys = alignments.select("_key").distinct()
    words = with_slots(docs.join(keys, "_key", "left_semi").dropDuplicates(["_key"]), rules)
    words = words.select("_key", "doc_id", word_list(_unmarked(F.col("slots"))).alias("words"))
    rows = alignments.join(words, "_key").join(items, "item")
    state = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(-1).alias("end"))

    def cover(s: Column, w: Column) -> Column:
        """Windows by position: words covered, the current and the longest run, where it ends."""
        stop = F.greatest(s["end"], w["at"] + w["length"])
        more = stop - F.greatest(s["end"], w["at"])
        run = F.when(w["at"] <= s["end"], s["run"] + more).otherwise(w["length"])
        return F.struct(
            (s["covered"] + more).alias("covered"),
            run.alias("run"),
            F.greatest(s["best"], run).alias("best"),
            stop.alias("end"),
        )

    def values(w: Column) -> Column:
        """(item value, document value) of the slots of one window."""
        token = lambda i: F.when(w["kind"] == NAMED, F.get("named", i)).otherwise(F.get("tokens", i))
        pairs = F.transform(
            F.sequence(w["at"], w["at"] + w["length"] - 1),
            lambda i: F.struct(
                F.substring(token(i), 1, 1).alias("mark"),
                _unmarked(token(i)).alias("item"),
                F.get("words", i + F.col("shift")).alias("doc"),
            ),
        )
        return F.filter(pairs, lambda p: p["mark"].rlike(_SLOT))

    copied = F.filter("at", lambda w: F.forall(values(w), lambda p: p["item"] == p["doc"]))

    def of(kinds: int) -> Column:
        return F.filter("at", lambda w: w["kind"].bitwiseAND(F.lit(kinds)) != 0)

    mixed = [of(kinds) for kinds in range(1, (LITERAL | NAMED | PLAIN) + 1)]
    rows = rows.withColumn("at", F.explode(F.array_distinct(F.array(*mixed, copied)))).where(F.size("at") > 0)
    rows = rows.withColumn("_slots", F.array_distinct(F.flatten(F.transform("at", values))))
    one = F.size(F.array_distinct(F.transform("_slots", lambda p: F.struct(p["mark"], p["item"])))) == F.size("_slots")
    rows = rows.where(one).withColumn("_c", F.aggregate("at", state, cover))
    good = (F.col("_c.covered") * 100 >= rules.percent * F.col("n")) | (F.col("_c.best") >= rules.long)
    return (
        rows.where(good)
        .groupBy("_key", "item")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("item_id").alias("item_id"),
            F.max("_c.covered").alias("covered_words"),
            F.max("_c.best").alias("longest_run"),
            F.first("n").alias("item_words"),
            F.max(F.size("_slots")).alias("n_slots"),
        )
        .drop("item")
    )


def clean(documents: DataFrame, benchmark: DataFrame, rules: TemplateRules | None = None) -> DataFrame:
    """The documents that no item contaminates."""
    bad = staged(findings(documents, benchmark, rules).select("_key").distinct(), "contaminated")
    name = fresh(documents, "_key")
    keyed = documents.withColumn(name, F.xxhash64("doc_id", "text"))
    return keyed.join(bad.toDF(name), name, "left_anti").drop(name)
