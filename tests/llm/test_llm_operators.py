"""The operators on awkward tables and planted cases, and their queries against SQL."""

import glob
import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from flagstone.llm import (
    bpe,
    chat,
    decontamination,
    jaccard_join,
    language_model,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from flagstone.llm.queries import ORACLES, QUERIES, tokenizer_path

ROOT = "/root/testdata/sf0.001"
CLASH = ["key", "runs", "kept", "_key", "set", "part", "hash", "n", "words", "score", "ids", "c0"]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"Word{i % 977}" for i in range(30_000))


def awkward(spark, clash=True):
    rows = [
        (None, None), (None, f"null id {PASSAGE}"), (1, ""), (2, None), (3, " \t\n "),
        (4, PASSAGE), (5, f"begin {PASSAGE} end"), (5, f"begin {PASSAGE} end"), (6, LONG),
        (7, LONG + " tail"), (8, "one two three"), (9, "One two THREE"), (4, "same id, other text"),
        (10, "x" * 70_000), (11, "</s><|turn|> \\ [INST]"),
    ]
    full = [(i, t, "en" if i else None, None, len(t) if t and i != 6 else None) for i, t in rows]
    df = spark.createDataFrame(full, DOCUMENT)
    if clash:
        for name in CLASH:
            df = df.withColumn(name, df["source"])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{ROOT}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


# ------------------------------------------------------------------ substring dedup


def brute_words(rows, n=50):
    parsed = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = lambda i: math.inf if i is None else i
    least = {}
    for i, ws in parsed:
        for p in range(len(ws) - n + 1):
            seq = tuple(ws[p : p + n])
            least[seq] = min(least.get(seq, math.inf), order(i))
    out = []
    for i, ws in parsed:
        gone = set()
        for p in range(len(ws) - n + 1):
            if least[tuple(ws[p : p + n])] < order(i):
                gone.update(range(p, p + n))
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_substring_dedup_on_awkward_rows(spark):
    df = awkward(spark)
    got = substring_dedup.remove_repeats(df, output="digest")
    rows = got.select("doc_id", "n_words", "n_removed", "kept").collect()
    expected = brute_words([(r.doc_id, r.text) for r in df.collect()])
    assert Counter(tuple(r) for r in rows) == expected
    assert set(CLASH) <= set(got.columns)
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_substring_dedup_where_the_graph_branches(spark):
    tail = lambda k: " ".join(f"t{k}x{j}" for j in range(30))
    rows = [(i, f"{tail(i)} {PASSAGE} {tail(i % 3)}") for i in range(12)]
    rows += [(20 + i, f"{PASSAGE[: 200 + 7 * i]} {tail(1)}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(df, output="digest").collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_words(rows)


# --------------------------------------------------------------------- suffix dedup


def brute_bytes(rows, n=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p : p + n] for _, b in data for p in range(len(b) - n + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        done = 0
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                for q in range(max(p, done), p + n):
                    gone[q] = 1
                done = p + n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for q in range(len(b)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("most", [20_000, 1])
def test_suffix_dedup_on_awkward_rows(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MAX_PATHS", most)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 5_000)
    source = awkward(spark)
    rows = [(r.doc_id, (r.text or "")[:3000]) for r in source.collect()]
    rows += [(30 + i, f"é{i} {PASSAGE} {i * 'z'}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, digest=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got) == brute_bytes(rows)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_dedup_keeps_columns(spark):
    got = suffix_dedup.remove_repeats(awkward(spark))
    assert set(CLASH) - {"kept"} <= set(got.columns) and got.count() == 15


# --------------------------------------------------------------------- jaccard join


def brute_classes(rows):
    sets = []
    for i, t in rows:
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        ws = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(ws[p : p + 5]) for p in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
        sets.append((i, grams))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, g) in enumerate(sets):
        if g and i is not None:
            low[find(k)] = min(low.get(find(k), math.inf), i)
    return Counter((i, len(g), low.get(find(k), i) if g else i) for k, (i, g) in enumerate(sets))


@pytest.mark.parametrize("small", [32, 1])
def test_jaccard_join_finds_every_link(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    base = [f"b{i}" for i in range(40)]
    for i in range(30):  # a chain: neighbours link, the ends do not
        rows.append((100 + i, " ".join(base[i // 6 :] + [f"c{j}" for j in range(i // 3)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.classes(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows)


def test_one_of_each_keeps_wordless_texts_and_columns(spark):
    df = awkward(spark)
    got = jaccard_join.one_of_each(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter([None, 1, 2, 3, 4, 4, 6, 8, 10, 11])
    assert jaccard_join.one_of_each(empty(spark)).count() == 0


# ------------------------------------------------------------------ decontamination

QUESTION = (
    "A farmer named Alice has 12 apples and 7 pears in her big basket, "
    "and she gives 5 apples to Bob; how many apples does she keep after 12 days of work?"
)
CHANGED = (
    "A farmer named Carol has 31 apples and 9 pears in her big basket, "
    "and she gives 4 apples to Dave; how many apples does she keep after 31 days of work?"
)
UNEVEN = CHANGED.replace("after 31 days", "after 8 days")  # 12 stands for two values


def test_reparameterised_questions_are_found(spark):
    docs = spark.createDataFrame(
        [
            (1, f"Intro words. {QUESTION} More."), (2, f"Other intro. {CHANGED}"),
            (3, "Entirely unrelated words about nothing much at all in this long clean text."),
            (4, f"x {UNEVEN}"), (None, QUESTION), (5, None), (6, ""), (7, QUESTION.upper()),
        ],
        "doc_id long, text string",
    )
    items = benchmark(spark, [(10, QUESTION), (11, None), (12, ""), (13, "too short"), (10, QUESTION)])
    found = {(r.doc_id, r.item_id) for r in decontamination.findings(docs, items).collect()}
    assert {(1, 10), (2, 10), (None, 10)} <= found
    assert not {d for d, _ in found} & {3, 4, 5, 6}
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns and {3, 4, 5, 6} <= {r.doc_id for r in kept.collect()}


def test_a_copied_passage_is_found_despite_a_contradicting_slot(spark):
    rows = [(1, QUESTION.replace("after 12 days", "after 8 days")), (2, UNEVEN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.findings(docs, benchmark(spark, [(10, QUESTION)])).collect()
    assert [(r.doc_id, r.item_words, r.covered_words, r.longest_run) for r in found] == [(1, 32, 28, 28)]


def test_short_items_are_searched_whole(spark):
    docs = spark.createDataFrame(
        [(1, "well then: the quick brown fox jumps high, they said"), (2, "the quick brown fox sleeps")],
        "doc_id long, text string",
    )
    found = decontamination.findings(docs, benchmark(spark, [(1, "The quick brown fox jumps high")]))
    assert [(r.doc_id, r.item_words, r.covered_words) for r in found.collect()] == [(1, 6, 6)]


COPIES = {
    1: "Paris", 2: "Never again, never!", 3: "12 km in 3 hours, 5 km in 2 hours",
    4: "What Is The Capital City Of Northern France Called Today", 5: "The quick brown fox jumps high",
    6: QUESTION, 7: "5km is 5000 m, or 3.1 miles",
}


@pytest.mark.parametrize("form", ["Answer {}", "answer ({}) now", "...{}!"])
@pytest.mark.parametrize("case", [str, str.lower, str.upper])
def test_copies_of_any_words_are_found(spark, form, case):
    docs = [(i, form.format(case(text))) for i, text in COPIES.items()] + [(0, "a clean text in 3 words")]
    found = decontamination.findings(
        spark.createDataFrame(docs, "doc_id long, text string"), benchmark(spark, COPIES.items())
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in COPIES}
    assert all(r.covered_words == r.longest_run == r.item_words for r in found)


def test_names_that_begin_a_sentence_may_change(spark):
    items = benchmark(spark, [(1, "Alice has 12 apples in her basket"), (2, "They ran away from home. Bob saw it all")])
    docs = [
        (1, "Say Carol has 31 apples in her basket"), (2, "Carol has 31 apples in her basket"),
        (3, "They ran away from home. Eve saw it all"),
    ]
    found = decontamination.findings(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 2)}


def test_a_word_that_is_an_item_gives_one_row_a_document(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog and the end"), (2, "cats")], "doc_id long, text string")
    found = decontamination.findings(docs, benchmark(spark, [(1, "The")])).collect()
    assert [(r.doc_id, r.item_words, r.covered_words, r.n_slots) for r in found] == [(1, 1, 1, 0)]


def test_decontamination_on_awkward_rows(spark):
    df = awkward(spark)
    items = benchmark(spark, [(1, PASSAGE)])
    assert decontamination.clean(df, items).columns == df.columns
    assert decontamination.clean(df, benchmark(spark)).count() == df.count()
    assert decontamination.findings(empty(spark), items).count() == 0


def test_joined_windows_equal_broadcast_windows(spark):
    docs, items = (spark.read.parquet(f"{ROOT}/{t}.parquet") for t in ("documents", "benchmark"))
    both = [
        Counter(map(tuple, decontamination.findings(docs, items, rules).collect()))
        for rules in (decontamination.TemplateRules(), decontamination.TemplateRules(broadcast_rows=0))
    ]
    assert both[0] == both[1] and both[0]
    holding = duckdb.sql(
        f"SELECT doc_id FROM '{ROOT}/documents.parquet' d, '{ROOT}/benchmark.parquet' b WHERE contains(d.text, b.text)"
    ).fetchall()
    assert {d for (d,) in holding} <= {r[1] if len(r) > 6 else r[0] for r in both[0]} | {r[1] for r in both[0]}


# ------------------------------------------------------------------- language model


def test_language_model_equals_its_formula(spark):
    rows = [(r.doc_id, (r.text or "")[:4000]) for r in awkward(spark).collect()]
    rows += [(100 + i, f"the {'a' * (i % 3 + 1)} of the end {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = language_model.score(df).collect()
    parsed = []
    for i, t in rows:
        low = t.translate({c: c + 32 for c in range(65, 91)})
        parsed.append((i, re.findall(r"[^\x20\x09-\x0D]+", low) + [None]))
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count, pairs, before = Counter(), Counter(), Counter()
    for i, ts in parsed:
        if not held(i):
            count.update(ts)
            pairs.update(zip(["<s>", *ts[:-1]], ts))
            before.update(["<s>", *ts[:-1]])
    total, distinct, mass = sum(count.values()), len(count), language_model.MASS
    share = lambda w: (count[w] + 0.1) / (total + 0.1 * (distinct + 1))
    expected = []
    for i, ts in parsed:
        base = sum(math.log10(share(w)) for w in ts)
        model = sum(
            math.log10((pairs[c, w] + mass * share(w)) / (before[c] + mass))
            for c, w in zip(["<s>", *ts[:-1]], ts)
        )
        expected.append((str(i), len(ts), sum(count[w] > 0 for w in ts), held(i), base, model))
    found = [(str(r.doc_id), r.n_tokens, r.n_known, r.held_out, r.base_score, r.score) for r in got]
    assert {r.train_tokens for r in got} == {total}
    for g, e in zip(sorted(found), sorted(expected), strict=True):
        assert g[:4] == e[:4]
        assert abs(g[4] - e[4]) < 1e-6 and abs(g[5] - e[5]) < 2e-3 * e[1]
    assert language_model.score(empty(spark)).count() == 0


def test_parts_do_not_change_the_scores(spark, monkeypatch):
    df = spark.read.parquet(f"{ROOT}/documents.parquet")
    one = {r.doc_id: r.score for r in language_model.score(df).collect()}
    monkeypatch.setattr(language_model, "PART_TOKENS", 5_000)
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 8_000)
    monkeypatch.setattr(language_model, "HOT_SHARE", 100)
    many = {r.doc_id: r for r in language_model.score(df).collect()}
    assert all(abs(one[i] - r.score) < 2e-3 * r.n_tokens for i, r in many.items())


# ----------------------------------------------------------- chat, rules, tokens, classifiers


def test_chat_reads_back(spark):
    rows = [
        (1, 1, "assistant", "b\\ <|next|> [INST]"), (1, 0, "user", None), (1, 2, "assistant", "<<s>\\\\s>"),
        (1, 3, None, "role <|end|>"), (None, 0, "user", "x"), (2, None, "assistant", "late"),
        (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "us<|body|>er", "</s>"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("formatted", df["role"]).withColumn("blocks", df["role"])
    out = chat.format_conversations(df)
    got = out.select(
        "conv_id", "formatted", chat.read_turns(out["formatted"]).alias("turns"),
        chat.read_loss(out["formatted"], out["loss_spans"]).alias("loss"),
    ).collect()
    by = {r.conv_id: r for r in got}
    assert [tuple(t) for t in by[1].turns] == [
        ("user", ""), ("assistant", rows[0][3]), ("assistant", rows[2][3]), ("", "role <|end|>")
    ]
    assert by[1].loss == [rows[0][3], rows[2][3]] and by[1].formatted.count("<|turn|>") == 3
    assert [tuple(t) for t in by[2].turns] == [("assistant", "late"), ("assistant", ""), ("assistant", "")]
    assert by[2].loss == ["late", "", ""] and by[None].loss == []
    assert [tuple(t) for t in by[3].turns] == [("us<|body|>er", "</s>")] and "</s>" not in by[3].formatted
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_rules_on_awkward_rows(spark):
    got = quality_rules.clean_documents(awkward(spark)).collect()
    assert len(got) == 15
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[2, 0].base_failed and not by[2, 0].kept
    assert by[6, 30_000].n_repeat_words == 30_000 and by[6, 30_000].base_failed
    assert quality_rules.clean_documents(empty(spark)).count() == 0


def test_lines_are_judged_one_by_one(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(10))
    bad = "Home\nAccept cookies to go on\nA | B | C | D\nBUY!! NOW!! HERE!!"
    menu = "\n".join(f"link{i} | page{i} | item{i} | thing{i}" for i in range(30))
    rows = [(1, good), (2, f"{bad}\n{good}"), (3, f"{menu}\nOne line stays, it is fine.")]
    got = quality_rules.clean_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].kept and by[1].cleaned == good
    assert by[2].kept and by[2].cleaned == good
    assert not by[3].kept and not by[3].base_failed and by[3].cleaned == "One line stays, it is fine."


def test_tokens_round_trip(spark):
    df = awkward(spark)
    out = bpe.decode_ids(bpe.encode(df, tokenizer_path()), tokenizer_path())
    assert set(out.columns) == {*df.columns, "decoded"}
    assert all(r.decoded == (r.text or "") for r in out.collect())
    assert bpe.digests(empty(spark), tokenizer_path()).count() == 0
    nothing = [r for r in bpe.digests(df, tokenizer_path()).collect() if r.doc_id == 2]
    assert nothing[0].n_tokens == 0 and nothing[0].ids_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("name", ["op5", "op10"])
def test_classifiers_on_awkward_rows(spark, name):
    classify = toxicity.classify if name == "op5" else quality_classifier.classify
    some = labels(spark, [(4, 1, 0), (5, 0, 1), (5, None, None), (None, 1, 1), (6, 1, 0), (9, 0, 1)])
    got = classify(awkward(spark), some).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)
    assert classify(empty(spark), some).count() == 0
    unlabelled = classify(awkward(spark), labels(spark)).collect()
    assert len(unlabelled) == 15
    if name == "op5":
        assert not any(r.toxic for r in unlabelled)


def test_classifiers_learn(spark):
    root = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    truth = {r.doc_id: r for r in marks.collect()}
    scored = {r.doc_id: r for r in quality_classifier.classify(docs, marks).collect()}
    rows = [(scored[i].score, t.quality) for i, t in truth.items() if held(i)]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in rows for b, y in rows if x == 1 and y == 0]
    assert sum(pairs) / len(pairs) > 0.9
    train = marks.where("crc32(cast(doc_id as string)) % 5 <> 0")
    chain = toxicity.fit(docs, train)
    found = {r.doc_id: r.p_toxic for r in toxicity.score(docs, chain).collect()}
    wrong = sum(found[i] >= 0.5 for i, t in truth.items() if held(i) and not t.toxic)
    assert wrong <= 2
    caught = [found[i] >= 0.5 for i, t in truth.items() if t.toxic]
    assert sum(caught) / len(caught) > 0.6


# -------------------------------------------------------------------------- queries


def value(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    frame = QUERIES[name](spark, ROOT)
    result = database.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    got = Counter(tuple(value(r[n]) for n in names) for r in frame.collect())
    assert got == Counter(tuple(map(value, r)) for r in result.fetchall())


def test_all_are_registered():
    names = set(contract.queries())
    assert {"pipeline", *QUERIES} <= names
    assert all(any(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 11))


def test_pipeline_stages(spark):
    """Each stage against a plain version of it."""
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substring_dedup", "decontamination", "bpe"
    ]
    frame = docs
    states = []
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.staged(stage(spark, frame, ROOT), name)
        if name != "bpe":
            assert frame.columns == docs.columns
            states.append({r.doc_id: r.text for r in frame.collect()})
    clean, single, cut, last = states
    chain = toxicity.fit(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, chain).collect() if r.p_toxic >= 0.5}
    assert set(clean) == set(before) - toxic
    groups = brute_classes(list(clean.items()))
    assert set(single) == {i for i, n, c in groups if i == c}
    removed = brute_words(list(single.items()))
    for i, _, n, digest in removed:
        if n:
            assert hashlib.sha256(cut[i].encode()).hexdigest() == digest
        else:
            assert cut[i] == single[i]
    assert set(last) <= set(cut)
    vocabulary = bpe.Vocabulary.load(tokenizer_path())
    encoder = bpe.Encoder(vocabulary)
    rows = {r.doc_id: r for r in frame.collect()}
    assert set(rows) == set(last)
    for i, text in last.items():
        ids, _, _ = encoder.encode([text])
        assert rows[i].ids == ids.tolist() and rows[i].n_tokens == len(ids)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    root = str(tmp_path)
    labels(spark, [(4, 1, 0)]).write.parquet(f"{root}/labels.parquet")
    benchmark(spark, [(1, "a b c d e f g h i j")]).write.parquet(f"{root}/benchmark.parquet")
    awkward(spark).write.parquet(f"{root}/documents.parquet")
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, root).collect())
    assert got == Counter([None, 1, 2, 3, 4, 4, 6, 8, 10, 11])
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
    assert docs.count() == 0


def test_windows_are_hashed_in_few_steps_and_tell_runs_apart(spark):
    from pyspark.sql import functions as F

    words = [[1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 4], [5] * 9, [7, 8], []]
    df = spark.createDataFrame([(w, w, w) for w in words], "_literal array<long>, _named array<long>, _plain array<long>")
    for size in range(1, 9):
        hashed = decontamination.with_windows(df.withColumn("w", F.col("_plain")), size)
        named = {}
        for row in hashed.collect():
            runs = [tuple(row.w[i : i + size]) for i in range(len(row.w) - size + 1)]
            assert len(row["_plain"]) == len(runs) and row["_plain"] == row["_named"] == row["_literal"]
            for run, value in zip(runs, row["_plain"]):
                assert named.setdefault(run, value) == value
        assert len(set(named.values())) == len(named)
    plan = decontamination.with_windows(df, 8)._jdf.queryExecution().analyzed().toString()
    assert plan.count("xxhash64") == 3 * 3  # three kinds, three steps


def test_windows_of_texts_are_searched_where_they_are(spark):
    from pyspark.sql import functions as F

    import numpy as np

    values = np.arange(-20, 20, dtype=np.int64) * 987_654_321_987
    arrays = spark.createDataFrame([(values.tolist(),) * 3], "_literal array<long>, _named array<long>, _plain array<long>")
    for size in (1, 2, 5, 8):
        runs = decontamination.runs(values.view(np.uint64), size).view(np.int64)
        assert decontamination.with_windows(arrays, size).first()["_plain"] == runs.tolist()
    assert len(decontamination.runs(values.view(np.uint64)[:3], 8)) == 0

    texts = [(1, "a b c d", "a b c d", "a  c d"), (2, "", "", ""), (3, "x b", "x b", "x b"), (4, "c d", "c d", "c d")]
    df = spark.createDataFrame(texts, "_key long, _plain string, _literal string, _named string").coalesce(1)
    one = lambda text: spark.createDataFrame([(text,) * 3], "_plain string, _literal string, _named string")
    items = [("b c", 2), (" c", 2), ("d x", 2), ("c", 1)]
    words = {t: decontamination.with_words(one(t).withColumn("slots", F.col("_plain"))).first()["_plain"] for t, _ in items[::3]}
    assert [len(w) for w in words.values()] == [2, 1]
    sought = [(decontamination.runs(np.array(w, np.int64).view(np.uint64), len(w)).view(np.int64).tolist()[0],) for w in words.values()]
    found = decontamination.candidates(df, spark.createDataFrame(sought, "hash long"), [1, 2]).collect()
    assert sorted((r["_key"], r.length, r.pos) for r in found) == [(1, 1, 2), (1, 2, 1), (4, 1, 0)]


def test_decontamination_runs_no_python(spark):
    """Items of several lengths, blanks of all kinds and windows without a slot; no Python node in any plan."""
    items = benchmark(spark, [(1, "red\tgreen\nblue"), (2, QUESTION), (3, "one two")])
    docs = [(1, "a red\x0bgreen\rblue one\x0ctwo"), (2, CHANGED.replace(" ", "\n")), (3, "red blue"), (4, None), (5, " \n")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.findings(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (1, 3), (2, 2)}
    rules = decontamination.TemplateRules()
    windows = decontamination.item_windows(items, rules)
    keyed = docs.withColumn("_key", docs.doc_id)
    for frame in (windows, decontamination._matches(keyed, windows, rules), found):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


def test_a_bit_table_as_rows_equals_the_array(spark):
    from pyspark.sql import functions as F

    import numpy as np
    from flagstone.llm import keyfilter

    keys = spark.range(300).select(F.xxhash64("id").alias("hash"))
    rows = spark.range(-400, 400).select(F.xxhash64("id").alias("hash"))
    values = np.array([r["hash"] for r in rows.collect()], np.int64)
    held = keyfilter.that_may_hold(rows, keyfilter.bit_table(keys, "hash"), "hash")
    assert held.columns == ["hash"]
    expected = values[keyfilter.may_hold(keyfilter.key_bits(keys, "hash"), values)].tolist()
    assert sorted(r["hash"] for r in held.collect()) == sorted(expected) and len(expected) >= 300
