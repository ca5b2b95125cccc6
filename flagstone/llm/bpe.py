"""Byte-level BPE: encoding by batched merge rounds in numpy, and exact decoding.

Texts are cut into pre-tokens by the published pattern. The distinct pre-tokens of a batch that
are not known yet are encoded together: their symbols stand in one flat array; in each round every
adjacent pair that is new is looked up by binary search over the sorted pair keys, each word takes its lowest
rank, and all its occurrences of that pair merge, leftmost first. A word leaves the array when
none of its pairs is known, so a batch takes as many rounds as its longest word has merges.

Documents are encoded where they are read: no shuffle, hence nothing to skew. The vocabulary (its
size is the file's) is read on the driver and broadcast. Known words are kept per Python worker, at
most `MAX_WORDS`; after that the store starts anew.

Cases: a null text is empty and has no ids; special tokens in a text get their id and come back
as text; long texts are handled whole (about 100 bytes of memory a character); repeated
rows give repeated results; an empty table gives an empty result; other columns are kept by
`encode` and `decode` unless they have the name of the new column, which replaces them.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.llm.text import PIECE, mix, pieces, rolling

MAX_WORDS = 300_000
# Fixed: the published pre-token pattern of byte-level BPE, which `token_starts` follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Classes of characters in that pattern.
LETTER, DIGIT, SPACE, WHITE, OTHER, MARK = range(6)
_EDGE = 0x110000  # stands between texts


# Fixed: letters and digits of Unicode 16, which Python's tables may not have yet.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
    (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
    (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEW_DIGITS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


@lru_cache
def character_classes() -> np.ndarray:
    """The class of every code point, by its general category."""
    table = np.full(_EDGE + 1, OTHER, np.uint8)
    for code in range(_EDGE):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = DIGIT
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_DIGITS, DIGIT)):
        for low, high in ranges:
            table[low : high + 1] = kind
    white = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    table[[*white, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    table[0x20] = SPACE
    table[_EDGE] = MARK
    return table


def token_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens begin. Marks (text ends, special tokens) end a text on both sides."""
    n = len(points)
    white = (kinds == SPACE) | (kinds == WHITE)
    start = np.ones(n, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) & ~(white[1:] & white[:-1])
    word = ~white & (kinds != MARK)
    before_word = np.zeros(n, bool)
    before_word[:-1] = white[:-1] & word[1:]
    start |= before_word  # the last white character before a word stands alone
    attached = before_word & (kinds == SPACE)  # or belongs to it
    start[1:] &= ~attached[:-1]
    # Contractions: a quote that begins a pre-token and one of the known endings.
    quotes = np.flatnonzero((points == 0x27) & start)
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    one, two = padded[quotes + 1], padded[np.minimum(quotes + 2, n + 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(quotes), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    for places, size in ((quotes[short], 2), (quotes[long], 3)):
        start[places + 1] = False
        after = places + size
        start[after[after < n]] = True
    return start


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


@lru_cache
def code_point_values() -> np.ndarray:
    return mix(np.arange(1, _EDGE + 2, dtype=np.uint64))


@dataclass
class Vocabulary:
    """Merge table and token bytes as arrays."""

    pair_keys: np.ndarray  # sorted left * size + right
    pair_ranks: np.ndarray
    pair_ids: np.ndarray  # the id a pair merges into
    byte_ids: np.ndarray  # id of each single byte
    token_bytes: np.ndarray
    token_first: np.ndarray  # token i has bytes [first[i], first[i+1])
    special: dict[str, int]
    size: int

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs of symbols in the merge table, -1 if they do not merge."""
        if not len(self.pair_keys):
            return np.full(len(left), -1)
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, at, -1)

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        """`pairs` of every two single bytes."""
        one = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        return self.pairs(*one).reshape(256, 256)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = byte_symbols()
        back = {c: b for b, c in enumerate(names)}
        size = 1 + max([*vocab.values(), *special.values()])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        ids = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        content = [b""] * size
        for token, i in vocab.items():
            content[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            content[i] = token.encode()
        first = np.zeros(size + 1, np.int64)
        np.cumsum([len(c) for c in content], out=first[1:])
        return cls(
            keys[order],
            order.astype(np.int64),
            ids[order],
            np.array([vocab[c] for c in names], np.int64),
            np.frombuffer(b"".join(content), np.uint8),
            first,
            special,
            size,
        )


NO_RANK = np.iinfo(np.int64).max


def merge_rounds(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where word i has [first[i], first[i+1]).

    Each symbol keeps the pair it begins; only pairs at a merge are looked up again.
    """
    v = vocabulary
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.byte_ids[data]
    owner = np.repeat(np.arange(len(words)), lengths)
    pair = np.full(len(symbols), -1)
    pair[:-1] = v.byte_pairs[data[:-1], data[1:]]
    pair[:-1][owner[1:] != owner[:-1]] = -1
    ranks = np.append(v.pair_ranks, NO_RANK)  # the last one for pair -1
    done_symbols, done_owner = [], []
    while len(symbols):
        same = owner[1:] == owner[:-1]
        rank = ranks[pair]
        begins = np.flatnonzero(np.concatenate([[True], ~same]))
        lowest = np.minimum.reduceat(rank, begins)
        sizes = np.diff(np.append(begins, len(symbols)))
        lowest = np.repeat(lowest, sizes)
        active = lowest != NO_RANK
        done_symbols.append(symbols[~active])
        done_owner.append(owner[~active])
        places = np.flatnonzero(active & (rank == lowest))
        # Of hits in a row (one symbol repeated) every second one merges, from the left.
        fresh = np.concatenate([[True], np.diff(places) > 1]) if len(places) else places > 0
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0)) if len(places) else places
        places = places[(np.arange(len(places)) - run) % 2 == 0]
        symbols[places] = v.pair_ids[pair[places]]
        active[places + 1] = False
        merged = np.zeros(len(symbols), bool)
        merged[places] = True
        symbols, owner, pair, merged = symbols[active], owner[active], pair[active], merged[active]
        merged[:-1] |= merged[1:]  # the pair before a new symbol is new as well
        pair[merged] = -1
        at = np.flatnonzero(merged[:-1] & (owner[1:] == owner[:-1]))
        pair[at] = v.pairs(symbols[at], symbols[at + 1])
    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
    owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    first = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(words)), out=first[1:])
    return symbols[order], first


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of many intervals, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Encodes texts; keeps the words it has seen, by their hash and length.

    Ids in decimal are only made with `decimal`.
    """

    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS, decimal: bool = True) -> None:
        self.vocabulary, self.max_words, self.decimal = vocabulary, max_words, decimal
        self.kinds = character_classes()
        self.values = code_point_values()
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted; number[i] is the word of hashes[i]
        self.number = np.zeros(0, np.int64)
        self.ids, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.shown, self.shown_first = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def _learn(self, joined: str, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Encode words that are not known yet; the number of each."""
        hashes, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        special = self.vocabulary.special
        ids, first = merge_rounds(
            [b"" if w in special else w.encode("utf-8", "replace") for w in words], self.vocabulary
        )
        for i in [i for i, w in enumerate(words) if w in special]:
            ids = np.insert(ids, first[i], special[words[i]])
            first[i + 1 :] += 1
        number = np.arange(len(words)) + len(self.first) - 1
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.number = np.insert(self.number, place, number)
        self.first = np.concatenate([self.first, first[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        if not self.decimal:
            return number[which]
        text = [f"{i}," for i in ids.tolist()]
        marks = first.tolist()
        shown = ["".join(text[a:b]) for a, b in zip(marks, marks[1:])]
        widths = np.cumsum([len(x) for x in shown])
        self.shown_first = np.concatenate([self.shown_first, widths + len(self.shown)])
        self.shown = np.concatenate([self.shown, np.frombuffer("".join(shown).encode(), np.uint8)])
        return number[which]

    def pretokens(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined texts, their code points, start and end of pre-tokens, and tokens per text."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        edges = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[edges] = _EDGE
        kinds = self.kinds[points]
        forced = edges
        for content in sorted(self.vocabulary.special, key=len, reverse=True):
            at = joined.find(content)
            while at >= 0:
                if not (kinds[at : at + len(content)] == MARK).any():
                    kinds[at : at + len(content)] = MARK
                    forced = np.append(forced, [at, at + len(content)])
                at = joined.find(content, at + len(content))
        start = token_starts(points, kinds)
        start[forced] = True
        start[edges[:-1] + 1] = True
        begins = np.flatnonzero(start)
        ends = np.append(begins[1:], len(points))
        inner = points[begins] != _EDGE
        begins, ends = begins[inner], ends[inner]
        return joined, points, begins, ends, np.searchsorted(begins, np.append(0, edges + 1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Flat ids, offsets per text, and, if wanted, each text's ids in decimal joined by commas."""
        if len(self.first) > self.max_words:
            self.forget()
        joined, points, begins, ends, per_text = self.pretokens(texts)
        hashes = rolling(self.values[points], begins, ends)
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        number = np.empty(len(hashes), np.int64)
        number[known] = self.number[at[known]]
        if not known.all():
            number[~known] = self._learn(joined, hashes[~known], begins[~known], ends[~known])

        def unpack(store: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            lengths = first[number + 1] - first[number]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            return store[_gather(first[number], lengths)], ends[per_text]

        ids, offsets = unpack(self.ids, self.first)
        if not self.decimal:
            return ids, offsets, []
        data, marks = unpack(self.shown, self.shown_first)
        data, marks = data.tobytes(), marks.tolist()
        return ids, offsets, [data[a : max(a, b - 1)] for a, b in zip(marks, marks[1:])]


def decode(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """Texts of runs of ids; bytes that are not UTF-8 become replacement characters."""
    v = vocabulary
    lengths = np.diff(v.token_first)[ids]
    data = v.token_bytes[_gather(v.token_first[ids], lengths)].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `size` values in their lists."""
    lists = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(lists):
        before = ends[row - 1] if row else 0
        upto = max(row + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(row, upto - row)
        row = upto


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name != name] + [T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    arrays = [batch.column(i) for i in keep]
    return pa.RecordBatch.from_arrays(
        [*arrays, values], names=[*[batch.schema.names[i] for i in keep], name]
    )


def encode(df: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of each text as an array of int."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, decimal=False)
        for batch in batches:
            for part, _, _ in pieces(batch, column):
                texts = part.column(part.schema.get_field_index(column)).to_pylist()
                ids, offsets, _ = encoder.encode([t or "" for t in texts])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield _replaced(part, out, lists)

    return df.mapInArrow(work, _with_column(df, out, T.ArrayType(T.IntegerType())))


def decode_ids(df: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of each array of ids; null ids give an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, column, PIECE):
                lists = part.column(part.schema.get_field_index(column))
                runs = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                offsets = np.append(0, np.cumsum(runs)).astype(np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield _replaced(part, out, pa.array(decode(flat, offsets, shared.value), pa.string()))

    return df.mapInArrow(work, _with_column(df, out, T.StringType()))


def digests(df: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    df = df.select("doc_id", F.col("text").cast("string").alias("text"))

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part, _, _ in pieces(batch):
                ids, offsets, shown = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                texts = decode(ids, offsets, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array(map(sha, shown), pa.string()),
                        pa.array((sha(t.encode()) for t in texts), pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = T.StructType(
        [
            df.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return df.mapInArrow(work, schema)
