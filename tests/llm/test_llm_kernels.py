"""The numpy parts against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flagstone.llm import bpe, bwt, elias_fano, linear, substring_dedup, suffix_dedup
from flagstone.llm.keyfilter import BITS, may_hold
from flagstone.llm.queries import tokenizer_path
from flagstone.llm.text import buffers, grams, pieces, words

ODD = ["", " ", "a", "A  b\tc\x0bd", "é ü x", "\x1c x\x1c", "tail ", "x" * 5000, "ä " * 3000]


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def test_words_are_those_of_the_pattern():
    texts = ODD * 3 + [None]
    seen = {}
    for part, data, offsets in pieces(batch(texts), size=700):
        w = words(data, offsets, lower=True)
        for i, text in enumerate(part.column(0).to_pylist()):
            low = (text or "").translate({c: c + 32 for c in range(65, 91)})
            expected = re.findall(r"[^\x20\x09-\x0D]+", low)
            hashes = w.hash[w.first[i] : w.first[i + 1]].tolist()
            assert len(hashes) == len(expected)
            for word, h in zip(expected, hashes):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_take_short_texts_whole():
    data, offsets = buffers(pa.array(["a b c d e f", "", "a b", "a b", "a b c d e"]))
    hashes, text = grams(words(data, offsets), 5)
    assert text.tolist() == [0, 0, 2, 3, 4]
    assert hashes[0] == hashes[4] and hashes[2] == hashes[3] and len(set(hashes.tolist())) == 3


def test_sliced_columns_keep_their_texts():
    column = pa.array(["one", None, "two three", ""]).slice(1)
    data, offsets = buffers(column)
    assert data.tobytes() == b"two three" and offsets.tolist() == [0, 0, 9, 9]


def test_argmin_is_leftmost():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 39):
        x = rng.integers(0, 5, 200).astype(np.uint64)
        got = substring_dedup.sliding_argmin(x, width)
        assert got.tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(200 - width + 1)]


def test_least_positions_do_not_depend_on_the_piece_length():
    small = np.random.default_rng(2).integers(0, 2**63, (1 << 20) + 500).astype(np.uint64)
    long = suffix_dedup._least(small, 177)
    assert (long[:2000] == suffix_dedup._least(small[:2176], 177)).all()


def test_key_table_never_misses():
    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 1000)
    table = np.zeros(1 << (BITS - 6), np.uint64)
    for bit in (keys & ((1 << BITS) - 1)).tolist():
        table[bit >> 6] |= np.uint64(1 << (bit & 63))
    assert may_hold(table, keys).all()
    assert may_hold(table, keys + 1).mean() < 0.1


@pytest.mark.parametrize("seed", range(40))
def test_merged_transforms_find_what_occurs_twice(seed):
    rng = random.Random(seed)
    depth = rng.choice([2, 4, 8, 20])
    letters = rng.choice([b"ab", b"abcdefgh", bytes(range(256))])
    base = bytes(rng.choice(letters) for _ in range(200))
    strings = []
    for _ in range(rng.randint(1, 30)):
        low = rng.randint(0, 180)
        strings.append(base[low : low + rng.randint(0, 60)] + bytes(rng.choice(letters) for _ in range(5)))
    count = Counter(s[i : i + depth] for s in strings for i in range(len(s) - depth + 1))
    expected = [[i for i in range(len(s) - depth + 1) if count[s[i : i + depth]] > 1] for s in strings]
    for shard_bytes in (1, 100, 1 << 20):
        got = [x.tolist() for x in bwt.repeated_starts(strings, depth, shard_bytes)]
        assert got == expected


@pytest.mark.parametrize("n,top", [(0, 9), (1, 0), (1, 2**63), (500, 3), (500, 2**64 - 1), (5000, 9000)])
def test_monotone_sequences(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    sequence = elias_fano.EliasFano.build(values)
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([values[:200], rng.integers(0, top, 200, dtype=np.uint64, endpoint=True)])
    place, found = sequence.successor(asked)
    assert (found == np.isin(asked, values)).all()
    assert (values[place[found]] == asked[found]).all()


def test_trie_answers_child_word_or_unknown():
    rng = np.random.default_rng(5)
    names = np.unique(rng.integers(0, 2**64 - 1, 300, dtype=np.uint64))
    pairs = np.unique(np.stack([rng.integers(0, len(names), 2000), rng.integers(0, 400, 2000)], 1), axis=0)
    contexts = np.sort(rng.integers(0, 2**64 - 1, 400, dtype=np.uint64))
    word_values, values = rng.normal(size=len(names)), rng.normal(size=len(pairs))
    built = elias_fano.Trie.build(names, word_values, pairs[:, 0], contexts[pairs[:, 1]], values)
    trie = elias_fano.Trie.map(built.to_bytes())
    known = {(int(a), int(b)): v for (a, b), v in zip(pairs, values)}
    words_asked = np.append(names, [np.uint64(12345)])
    owner = rng.integers(0, len(words_asked), 3000)
    asked = rng.integers(0, 400, 3000)
    got = trie.query(words_asked, owner, contexts[asked], -9.0)
    for g, o, c in zip(got, owner.tolist(), asked.tolist()):
        expected = -9.0 if o == len(names) else known.get((o, c), word_values[o])
        assert abs(g - expected) < 2e-3


def test_bpe_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer_path()
    library = tokenizers.Tokenizer.from_file(path)
    vocabulary = bpe.Vocabulary.load(path)
    encoder = bpe.Encoder(vocabulary, max_words=2000)
    rng = random.Random(1)
    parts = [*" \n\t'.!", "\x1c", "\x85", " ", "​", "　", "s", "l", "re", "'ve", "'", "a", "Z",
             "é", "ß", "1", "²", "🙂", "中", "<|endoftext|>", "́", "   ", "aaaa", "the", "Ᲊ"]
    for _ in range(20):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
        texts += [*ODD, "word" * 3000]
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        ids, offsets, shown = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
        assert shown == [",".join(map(str, e)).encode() for e in expected]
        decoded = [library.decode(e, skip_special_tokens=False) for e in expected]
        assert bpe.decode(ids, offsets, vocabulary) == decoded


def test_decoding_replaces_broken_characters():
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    vocabulary = bpe.Vocabulary.load(tokenizer_path())
    ids = library.encode("é🙂", add_special_tokens=False).ids
    for cut in range(len(ids) + 1):
        part = np.array(ids[:cut], np.int64)
        got = bpe.decode(part, np.array([0, cut]), vocabulary)
        assert got == [library.decode(ids[:cut], skip_special_tokens=False)]


def test_factor_scores_equal_the_pairwise_sum():
    rng = np.random.default_rng(4)
    first = np.array([0, 3, 3, 8])
    columns, values = rng.permutation(20)[:8], rng.normal(size=8)
    model = linear.Factors(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    got = model.probability(linear.Rows(first, columns, values))
    for i, (a, b) in enumerate(zip(first, first[1:])):
        margin = 0.3 + sum(model.weights[columns[j]] * values[j] for j in range(a, b))
        for j in range(a, b):
            for k in range(j + 1, b):
                margin += model.factors[columns[j]] @ model.factors[columns[k]] * values[j] * values[k]
        assert abs(got[i] - 1 / (1 + np.exp(-margin))) < 1e-9


def test_pairs_are_looked_up_again_only_at_merges(monkeypatch):
    from flagstone.llm.queries import tokenizer_path

    vocabulary = bpe.Vocabulary.load(tokenizer_path())
    words = [b" straightforward", b"", b"aaaaaaaaa", b" internationalisation", b"\xff\xfe", b"x"] * 50
    assert vocabulary.byte_pairs.shape == (256, 256)
    looked, pairs = [], bpe.Vocabulary.pairs
    monkeypatch.setattr(bpe.Vocabulary, "pairs", lambda v, a, b: looked.append(len(a)) or pairs(v, a, b))
    ids, first = bpe.merge_rounds(words, vocabulary)
    merges = sum(map(len, words)) - len(ids)
    assert 0 < sum(looked) <= 2 * merges
    # Each word alone, lowest rank first, leftmost first.
    rank = {(k // vocabulary.size, k % vocabulary.size): (r, i) for k, r, i in zip(
        vocabulary.pair_keys.tolist(), vocabulary.pair_ranks.tolist(), vocabulary.pair_ids.tolist())}
    for n, word in enumerate(words[:6]):
        held = vocabulary.byte_ids[list(word)].tolist() if word else []
        while found := [(*rank[p], i) for i, p in enumerate(zip(held, held[1:])) if p in rank]:
            _, new, i = min(found, key=lambda f: (f[0], f[2]))
            held[i : i + 2] = [new]
        assert ids[first[n] : first[n + 1]].tolist() == held


def test_encoder_makes_decimal_ids_only_on_demand():
    from flagstone.llm.queries import tokenizer_path

    vocabulary = bpe.Vocabulary.load(tokenizer_path())
    texts = ["one two one", "", "</s> three two"]
    full, plain = bpe.Encoder(vocabulary), bpe.Encoder(vocabulary, decimal=False)
    for _ in range(2):  # the second time all words are known
        ids, offsets, shown = full.encode(texts)
        same, marks, none = plain.encode(texts)
        assert same.tolist() == ids.tolist() and marks.tolist() == offsets.tolist() and none == []
        assert shown == [",".join(map(str, ids[a:b])).encode() for a, b in zip(offsets, offsets[1:])]
    assert len(plain.shown) == 0
