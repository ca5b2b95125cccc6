"""Merkle manifest, packing and filter audit against plain versions, on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flagstone.llm import filter_audit, merkle, packing, ranks, term_matrix
from flagstone.llm.queries import tokenizer_path
from tests.llm.test_llm_operators import DOCUMENT, ROOT, awkward, empty, labels

# ---------------------------------------------------------------------------- ranks


def test_ranks_are_positions(spark):
    rows = [(None if i % 7 == 0 else f"g{i % 3}", i % 11) for i in range(500)] + [("g0", None)] * 40
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    got = ranks.ranked(df, ["g"], ["v"], "rank", "size").collect()
    expected = []
    for g in {g for g, _ in rows}:
        values = sorted((v for h, v in rows if h == g), key=lambda v: (v is not None, v))
        expected += [(g, v, i, len(values)) for i, v in enumerate(values)]
    assert Counter(map(tuple, got)) == Counter(expected)


# --------------------------------------------------------------------------- merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(hashes):
    """Root, and for each leaf its siblings level by level."""
    proofs = [[] for _ in hashes]
    at = list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i : i + 3] for i in range(0, len(hashes), 3)]
        for proof, i in zip(proofs, at):
            run = runs[i // 3]
            proof.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at = [i // 3 for i in at]
        hashes = [sha("".join(run)) for run in runs]
    return hashes[0], proofs


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, text, lang, source, n_chars)."""

    def write(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    sources = {}
    for i, text, lang, source, n in rows:
        leaf = sha("".join(map(write, (i, source, lang, n, text))))
        sources.setdefault(source, []).append((i, leaf))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        leaves = sorted(sources[name], key=lambda x: (x[0] is not None, x[0], x[1]))
        trees[name] = (leaves, *plain_tree([h for _, h in leaves]))
    root, above = plain_tree([trees[name][1] for name in names])
    out = []
    for name, over in zip(names, above):
        leaves, subroot, proofs = trees[name]
        out += [(i, h, subroot, root, tuple(p + over)) for (i, h), p in zip(leaves, proofs)]
    return Counter(out)


def proved(df):
    got = merkle.prove(df)
    found = got.withColumn("again", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert all(r.again == r.root for r in found)
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in found)


@pytest.mark.parametrize("band", [1, 2, 6])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    sizes = {None: 9, "": 1, "b": 3, "B": 28, "é": 2, "a": 82, "z": 27, "y": 4}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 1009, f"text {i}\n", "en" if i % 3 else None, source, i % 50))
    df = spark.createDataFrame(rows, DOCUMENT)
    assert proved(df) == plain_manifest(rows)


def test_manifest_on_awkward_rows(spark):
    df = awkward(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert proved(df) == plain_manifest(rows)
    one = df.where("doc_id = 6")
    assert [(r.leaf == r.root == r.subroot, r.path) for r in merkle.prove(one).collect()] == [(True, [])]
    assert merkle.prove(empty(spark)).count() == 0
    carried = merkle.prove(df, {"tree": F.col("lang"), "digest": F.col("n_chars")})
    assert carried.columns == ["tree", "digest", "leaf", "subroot", "root", "path"]
    with pytest.raises(ValueError, match="must not be named"):
        merkle.prove(df, {"Root": F.col("lang")})


def test_a_changed_row_does_not_fold_to_the_root(spark):
    df = spark.createDataFrame([(i, f"line\n{i}", "en", "s", 5) for i in range(50)], DOCUMENT)
    changed = merkle.leaf({"text": F.replace("text", F.lit("\n"), F.lit(""))})
    got = merkle.prove(df, {"changed": changed})
    bad = got.where(merkle.fold(F.col("changed"), F.col("path")) == F.col("root"))
    assert bad.count() == 0


# -------------------------------------------------------------------------- packing


def plain_best_fit(lengths, capacity):
    """Fill of every sequence when the pieces are placed one by one."""
    left = []
    for n in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(left) if room >= n]
        if fitting:
            left[min(fitting)[1]] -= n
        else:
            left.append(capacity - n)
    return Counter(left)


def test_plan_equals_placing_pieces_one_by_one():
    random.seed(7)
    for _ in range(400):
        capacity = random.choice([1, 5, 8, 31, 64])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(0, 80))]
        rows = packing.plan(dict(Counter(lengths)), capacity)
        seen, filled = Counter(), {}
        for n in lengths:
            rank = seen[n]
            seen[n] += 1
            _, first_rank, first, each, offset = [r for r in rows.tolist() if r[0] == n and r[1] <= rank][-1]
            over = rank - first_rank
            filled.setdefault(first + over // each, []).append((offset + over % each * n, n))
        for places in filled.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
            assert at <= capacity
        left = Counter(capacity - sum(n for _, n in p) for p in filled.values())
        assert left == plain_best_fit(lengths, capacity)


def test_plan_stays_small_whatever_the_counts():
    random.seed(8)
    rows = packing.plan({n: random.randint(1, 10**12) for n in range(1, 2049)})
    assert len(rows) < 4 * 2048 * 11 and rows[:, 1].max() < 1 << 48


def library_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_on_awkward_rows(spark, capacity):
    df = awkward(spark)
    got = packing.pack(df, tokenizer_path(), capacity, with_ids=True)
    rows = got.collect()
    documents = Counter((i, tuple(ids)) for i, ids in library_ids((r.doc_id, r.text) for r in df.collect()))
    # Pieces, put in order, are the documents again; only long ones are cut, and full but the first.
    expected = Counter()
    for (i, ids), times in documents.items():
        for k, (start, n) in enumerate(packing.cut(len(ids), capacity)):
            piece = ids[start : start + n]
            crc = zlib.crc32(np.array(piece, "<u4").tobytes())
            expected[i, k, start, n, crc, piece] += times
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == expected
    left = Counter()
    whole = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    for number in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == number), key=lambda r: r.offset):
            assert r.offset == at and whole[number][at : at + r.length] == r.ids
            at += r.length
        assert at == len(whole[number]) <= capacity
        left[capacity - at] += 1
    assert left == plain_best_fit([r.length for r in rows], capacity)
    assert packing.pack(empty(spark), tokenizer_path(), capacity).count() == 0


def test_packing_query_on_the_test_table(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path()).collect()
    expected = Counter()
    for i, ids in library_ids((r.doc_id, r.text) for r in docs.collect()):
        for k, (start, n) in enumerate(packing.cut(len(ids), 2048)):
            expected[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    filled = Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    assert Counter(2048 - n for n in filled.values()) == plain_best_fit([r.length for r in rows], 2048)


# ---------------------------------------------------------------------- term matrix, audit


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("hot", [0, 300, 1 << 18])
def test_matrix_equals_counted_words(spark, monkeypatch, hot):
    monkeypatch.setattr(term_matrix, "SHARD", 5_000)
    df = awkward(spark)
    words = term_matrix.dictionary(df)
    ids = {r.word: r.word_id for r in words.collect()}
    assert sorted(ids.values()) == list(range(len(ids)))
    counts = Counter(w for r in df.collect() for w in words_of(r.text))
    assert {r.word: r.n for r in words.collect()} == counts
    known = {r.word for r in term_matrix.frequent(words, hot).collect()}
    least = min((counts[w] for w in known), default=10**9)
    assert len(known) <= hot and all(n < least for w, n in counts.items() if w not in known)
    carry = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    shards = term_matrix.matrix(df, words, carry, hot=hot)
    found = Counter()
    for s in shards.collect():
        assert s.indptr[0] == 0 and s.indptr[-1] == len(s.indices) == len(s.data)
        for d, a, b in zip(s.docs, s.indptr, s.indptr[1:], strict=False):
            assert s.indices[a:b] == sorted({ids[w] for w in words_of(d.row.text)})
            row = dict(zip(s.indices[a:b], s.data[a:b]))
            assert row == {ids[w]: n for w, n in Counter(words_of(d.row.text)).items()}
            found[d.row.doc_id, d.row.text] += 1
    assert found == Counter((r.doc_id, r.text) for r in df.collect())
    assert term_matrix.matrix(empty(spark), term_matrix.dictionary(empty(spark)), carry).count() == 0


def plain_audit(rows, marks):
    """rows: (doc_id, part, text)."""
    parts = {}
    for i, part, text in rows:
        text = text or ""
        ws = words_of(text)
        fails = {
            "A": len(ws) < 50,
            "B": 100 * len(set(ws)) < 65 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in rows),
        }
        failed = frozenset(f for f, v in fails.items() if v)
        parts.setdefault(part or "", []).append((failed, *marks.get(i, (False, False))))
    out = []
    for part, docs in parts.items():
        total, mine = Counter(), []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [d for d in docs if f in d[0] and not d[0] & before]
                total[f] += len(here)
                mine.append((
                    part, "".join(order), k + 1, sum(not d[0] & {*before, f} for d in docs), len(here),
                    sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in here), sum(d[2] for d in here), f,
                ))
        out += [(*m[:-1], total[m[-1]]) for m in mine]
    return Counter(out)


@pytest.mark.parametrize("hot", [9, 1 << 18])
def test_audit_equals_a_plain_one(spark, hot):
    rows = [(r.doc_id, r.source, r.text) for r in awkward(spark).collect()]
    rows += [(20 + i, f"s{i % 2}", " ".join(f"W{j % (9 + i)}" for j in range(40 + 3 * i))) for i in range(12)]
    rows += [(40 + i, ["", None, "s0"][i % 3], ["same text", "a | b", "", None][i % 4]) for i in range(13)]
    full = [(i, t, "en", s, None) for i, s, t in rows]
    df = spark.createDataFrame(full, DOCUMENT).withColumn("part", F.lit(1)).withColumn("digest", F.lit(2))
    marks = labels(spark, [(4, 1, 0), (5, 0, 1), (5, None, None), (41, 1, 1), (None, 1, 1), (44, 0, 0), (45, 1, 0), (45, 0, 1)])
    got = filter_audit.audit(filter_audit.flags(df, hot=hot), marks).collect()
    known = {4: (True, False), 5: (False, True), 41: (True, True), 45: (True, True)}
    assert Counter(map(tuple, got)) == plain_audit(rows, known)
    assert filter_audit.audit(filter_audit.flags(empty(spark)), marks).count() == 0


# ----------------------------------------------------------------------------- chat


def test_a_conversation_of_very_many_turns_is_read_back(spark):
    from flagstone.llm import chat

    df = spark.range(100_000).selectExpr(
        "1L AS conv_id", "id AS turn", "if(pmod(xxhash64(id), 3) = 0, 'user', 'assistant') AS role",
        "concat('é', id, ' \U0001f600<s>') AS text",
    )
    out = chat.format_conversations(df)
    loss = F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "")
    row = out.select(F.size(chat.read_turns(F.col("formatted"))).alias("n"), loss.alias("loss")).first()
    said = df.where("role = 'assistant'").orderBy("turn").collect()
    assert row.n == 100_000 and row.loss == "".join(r.text for r in said)


def test_bytes_are_told_by_comparison_and_cells_ordered_by_one_key():
    import numpy as np
    import pyarrow as pa

    data = np.arange(256, dtype=np.uint8)
    assert np.flatnonzero(term_matrix._gaps(data)).tolist() == [*range(0x09, 0x0E), 0x20]
    assert bytes(data[term_matrix._marks(data)]) == b"#$%&*|"
    assert np.flatnonzero(term_matrix._between(data, 0x80, 0xBF)).tolist() == [*range(0x80, 0xC0)]
    assert term_matrix._sums(data % 2 == 0, np.array([0, 0, 3, 256, 256])).tolist() == [0, 2, 126, 0]

    packed = {"indptr": [0, 3, 3, 5], "indices": [0, 1, 2, 0, 2], "data": [1, 2, 3, 4, 5], "terms": [90, 0, 7]}
    cells = {n: pa.array([term_matrix._packed(np.array(v))]) for n, v in packed.items()}
    shard = pa.table({"shard": pa.array([1]), "docs": pa.array([[1, 2, 3]]), **cells})
    filled = term_matrix._fill(shard, pa.table({"slot": [1], "word_id": [40]})).to_pylist()[0]
    assert filled["indices"] == [7, 40, 90, 7, 90] and filled["data"] == [3, 2, 1, 5, 4] and filled["indptr"] == [0, 3, 3, 5]
    nothing = {n: pa.array([term_matrix._packed(np.array(v, np.int64))]) for n, v in {**dict.fromkeys(packed, []), "indptr": [0, 0]}.items()}
    empty_row = pa.table({"shard": pa.array([1]), "docs": pa.array([[1]]), **nothing})
    assert term_matrix._fill(empty_row, pa.table({"slot": pa.array([], pa.int64()), "word_id": pa.array([], pa.int64())})).num_rows == 1
