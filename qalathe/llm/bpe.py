"""Byte-level BPE: encoding and decoding of whole texts by a table of ranks.

The tokenizers library does the merging, over Arrow batches. Its model wants characters, so each
byte has a stand-in character; the merges are derived from the ranks. Decoding goes through the
reversed byte table, so a character that is split over tokens comes back whole.

Defined cases. A null text is empty; an empty text has no tokens. Strings that look like special
tokens are ordinary text. Rows, order and other columns stay; columns of the output names are
replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .work import lean

# Bytes of text that are encoded at once; a longer text is a batch of its own.
CHUNK_BYTES = 2_000_000
# Units whose ids are looked up at once.
PLACED_AT_ONCE = 100_000
# Units in one string, and which go there: a space, then nothing that any table counts as white space.
JOINED = 500
# Texts that go to the library in one call.
ENCODED_AT_ONCE = 16
_ONE_SPACE = re.compile(r" [^\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2060\u3000\ufeff]+").fullmatch
# Units that a worker remembers between batches.
KNOWN_UNITS = 100_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one above 255."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that make a token, by its rank; the rank alone decides, not the pair."""
    out = []
    for token in sorted(ranks, key=ranks.get):
        splits = ((token[:k], token[k:]) for k in range(len(token) - 1, 0, -1))
        out += [(a, b) for a, b in splits if a in ranks and b in ranks]
    return out


@functools.lru_cache(maxsize=4)
def rank_tokenizer(path: str, pattern: str):
    """The library's tokenizer for a rank file; one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_characters()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    made = Tokenizer(models.BPE(
        vocab={shown[t]: r for t, r in ranks.items()},
        merges=[(shown[a], shown[b]) for a, b in _merges(ranks)],
        ignore_merges=True,
    ))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return made


@functools.lru_cache(maxsize=4)
def file_tokenizer(path: str):
    """The library's tokenizer as a JSON file describes it, special tokens as ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@functools.lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """Bytes of each id, by way of the characters as the model knows them."""
    chars = byte_characters()
    back = {c: b for b, c in enumerate(chars)}
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = bytes(back[chars[b]] for b in token)
    return table


def _word_ends(words: pa.Array, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which words are empty, and which end in white space; only ends beyond ASCII are looked at as text."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    empty = bounds[1:] == bounds[:-1]
    if data is None or not len(words):
        return empty, np.zeros(len(words), bool)
    byte = np.frombuffer(data, np.uint8)[np.maximum(bounds[1:] - 1, 0)]
    blank = ~empty & (byte <= 0x20)
    for k in np.flatnonzero(~empty & (byte >= 0x80)).tolist():
        blank[k] = texts[k][-1].isspace()
    return empty, blank


class UnitEncoder:
    """Encodes many texts by encoding each distinct unit of them once.

    A unit begins with a space or with line feeds that follow a character that is not white space.
    The patterns of these tokenizers never match across such a place, so the ids of a text are
    those of its units in turn. A text with other white space there is encoded as one unit.
    New units go to the library in strings of many; a token that begins with a space begins a unit.
    """

    def __init__(self, tokenizer) -> None:
        self._tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self._spaced = np.zeros(1 + max(vocabulary.values()), bool)
        space = byte_characters()[0x20]
        self._spaced[[k for token, k in vocabulary.items() if token.startswith(space)]] = True
        self._known: dict[str, int] = {}
        self._ids = np.zeros(0, np.int32)
        self._bounds = np.zeros(1, np.int64)

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        # The library's results are far larger than the ids, so they are held for a few texts only.
        for k in range(0, len(texts), ENCODED_AT_ONCE):
            some = texts[k:k + ENCODED_AT_ONCE]
            found = [e.ids for e in self._tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def _encoded(self, units: list[str]) -> list[str]:
        """Appends the ids of ``units`` and returns these in the order of their places."""
        alone = []
        joined = [u for u in units if _ONE_SPACE(u) or alone.append(u)]
        ids, _ = self._run(["".join(joined[k:k + JOINED]) for k in range(0, len(joined), JOINED)])
        sizes = np.diff(np.append(np.flatnonzero(self._spaced[ids]), len(ids)))
        more_ids, more_sizes = self._run(alone)
        self._ids = np.concatenate([self._ids, ids, more_ids])
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(np.append(sizes, more_sizes))])
        return joined + alone

    def _numbers(self, units: list[str]) -> np.ndarray:
        known = self._known
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            first = len(self._bounds) - 1
            known.update(zip(self._encoded(new), itertools.count(first)))
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _forget(self) -> None:
        if len(self._bounds) - 1 > KNOWN_UNITS:
            self._known = dict(itertools.islice(self._known.items(), KNOWN_UNITS))
            keep = 1 + max(self._known.values(), default=-1)
            self._bounds = self._bounds[:keep + 1]
            self._ids = self._ids[:self._bounds[-1]]

    def _placed(self, number: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ids of the units in a row; the places they come from are held for a few units only."""
        out = np.empty(int(ends[-1]), np.int32)
        for k in range(0, len(number), PLACED_AT_ONCE):
            here = slice(k, k + PLACED_AT_ONCE)
            n, base = sizes[here], int(ends[k] - sizes[k])
            stop = int(ends[here][-1])
            at = np.repeat(self._bounds[number[here]] - (ends[here] - n), n) + np.arange(base, stop)
            out[base:stop] = self._ids[at]
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text in them."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.split_pattern(pc.replace_substring_regex(texts, r"\n+", r" \0"), " ")
        bounds = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        place, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first, last = bounds[:-1], bounds[1:] - 1

        number = self._numbers([w if w[:1] == "\n" else " " + w for w in distinct])[place]
        number[first] = self._numbers([distinct[k] for k in place[first]])
        # A word that is empty or ends in white space makes the next place no safe one.
        empty, blank_end = _word_ends(coded.dictionary, distinct)
        unsafe = (empty | blank_end)[place]
        unsafe[last] = False
        unsafe[first] &= ~empty[place[first]]
        whole = np.flatnonzero(np.logical_or.reduceat(unsafe, first))
        used = np.ones(len(number), np.int64)
        if len(whole):
            base = len(self._bounds) - 1
            ids, counts = self._run(texts.take(pa.array(whole)).to_pylist())
            self._ids = np.concatenate([self._ids, ids])
            self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(counts)])
            for k, text in enumerate(whole):
                used[first[text]:last[text] + 1] = 0
                used[first[text]] = 1
                number[first[text]] = base + k
        sizes = (self._bounds[number + 1] - self._bounds[number]) * used
        ends = np.cumsum(sizes)
        ids = self._placed(number, sizes, ends)
        self._forget()
        return ids, np.concatenate([[0], ends[last]])


_ENCODERS: dict[tuple, UnitEncoder] = {}


def unit_encoder(make: Callable, *args: str) -> UnitEncoder:
    """The encoder of this Python worker for the tokenizer ``make(*args)``."""
    key = (make.__name__, *args)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(make(*args))
    return _ENCODERS[key]


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``CHUNK_BYTES`` of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` and, on request, ``starts`` and ``ends``: each token's characters in the text.

    A token that holds part of a character has that character's offsets.
    """
    names = ["ids", "starts", "ends"] if offsets else ["ids"]
    base = docs.drop(*names)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in itertools.chain.from_iterable(chunks(p, text) for p in lean(parts)):
            if offsets:
                found = rank_tokenizer(path, pattern).encode_batch(
                    [t or "" for t in part.column(text).to_pylist()], add_special_tokens=False)
                rows = [[e.ids for e in found], *([[o[k] for o in e.offsets] for e in found] for k in (0, 1))]
                added = [pa.array(r, pa.list_(pa.int32())) for r in rows]
            else:
                ids, bounds = unit_encoder(rank_tokenizer, path, pattern)(part.column(text))
                added = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *names])

    added = [T.StructField(name, T.ArrayType(T.IntegerType())) for name in names]
    return base.mapInArrow(batches, T.StructType([*base.schema.fields, *added]))


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``: the bytes of the ids. Null ids give null; an unknown id is an error."""
    base = tokens.drop("decoded")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for part in parts:
            rows = [None if r is None else b"".join([table[i] for i in r]) for r in part.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(rows, type=pa.binary())], [*part.schema.names, "decoded"])

    return base.mapInArrow(batches, T.StructType([*base.schema.fields, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each text, encoded and decoded in one pass.

    The ids are hashed as decimal numbers with commas between.
    """
    base = docs.select(doc_id, text)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, run = byte_table(path), unit_encoder(rank_tokenizer, path, pattern)
        decimal = [b"%d" % k for k in range(len(table))]
        for part in itertools.chain.from_iterable(chunks(p, text) for p in lean(parts)):
            ids, bounds = run(part.column(text))
            ids, bounds = ids.tolist(), bounds.tolist()
            rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
            written = [hashlib.sha256(b",".join([decimal[i] for i in r])).hexdigest() for r in rows]
            decoded = [hashlib.sha256(b"".join([table[i] for i in r])).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(map(len, rows), pa.int64()), pa.array(written), pa.array(decoded)],
                [doc_id, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = base.select(doc_id).schema.add("n_tokens", "long")
    return base.mapInArrow(batches, schema.add("ids_sha256", "string").add("decoded_sha256", "string"))
