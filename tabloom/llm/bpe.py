"""Byte-level BPE encoding and decoding with a pair occurrence index.

A text is cut at special tokens and split into pieces. The pieces of many texts that a task has not met yet are
laid out together, and every adjacent pair that the vocabulary can merge is mapped to the set of all its positions.
Pairs are then taken in ascending rank from a heap of the ranks that occur: all positions of a pair are merged at
once, and the lists of the new pairs to the left and right of each gain a position. A pair that a merge
creates always has a higher rank, since it contains the token just made; ``Vocabulary`` checks that. So one sweep
over the ranks encodes all pieces, and a piece of a million letters costs no more than as many short ones.

Pieces follow the vocabulary's split pattern. Texts whose characters were all assigned in Unicode 3.2 are split by the
``regex`` package; where younger characters occur, the installed tokenizer's own splitter says which class they have.

Edge cases: a null text is an empty one and has no tokens; a string of a special token in a text is that token; bytes
that are not UTF-8 become U+FFFD; repeated rows stay rows; null ids are kept; ids that the vocabulary lacks decode to
nothing; an empty table gives no rows. Only the columns that are named are read, so extra columns cannot clash.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how a byte-level vocabulary of this kind splits text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for ASCII texts, whose classes can be listed.
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
WINDOW = 1 << 20  # characters of a text that are split at once
GROUP = 1 << 18  # pieces whose new ones share an index
KNOWN = 300_000  # pieces whose tokens a task remembers


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class Vocabulary:
    """Merges, tokens and special tokens of a byte-level BPE file."""

    def __init__(self, source: str):
        data = json.loads(source)
        kind, split = data["model"]["type"], data["pre_tokenizer"]
        if kind != "BPE" or split["type"] != "ByteLevel" or split.get("add_prefix_space") or data.get("normalizer"):
            raise ValueError("not a plain byte-level BPE file")
        self.source = source
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        ids = data["model"]["vocab"]
        self.tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()}
        self.bytes = [ids[c] for c in byte_alphabet()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, token)
        made: dict[int, int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, token = ids[left], ids[right], ids[left + right]
            if made.get(a, -1) >= rank or made.get(b, -1) >= rank or token in made:
                raise ValueError(f"merge {rank} does not follow from those before it")
            made[token] = rank
            self.merges[a, b] = rank, token
        self.special: dict[str, int] = {}
        for t in data["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("special tokens must stand for themselves")
            self.special[t["content"]] = t["id"]
            self.tokens[t["id"]] = t["content"].encode()


def merged(pieces: Sequence[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The tokens of every piece as packed 32-bit numbers, found for all pieces together.

    Lists of positions only grow; a position whose pair has gone since is passed over when its list is taken.
    """
    if not pieces:
        return []
    merges, sizes = vocabulary.merges, np.array([len(p) for p in pieces])
    flat = np.array(vocabulary.bytes)[np.frombuffer(b"".join(pieces), np.uint8)]
    # -1 before every piece and at the end: no pair reaches over it
    laid = np.append(np.insert(flat, np.cumsum(sizes) - sizes, -1), -1)
    order = np.argsort(codes := laid[:-1] << 32 | laid[1:] & 0xFFFFFFFF, kind="stable")
    ends = np.flatnonzero(np.diff(codes[order])) + 1
    places: dict[tuple[int, int], list[int]] = {}
    for here in np.split(order, ends):
        pair = int(laid[here[0]]), int(laid[here[0] + 1])
        if pair in merges:
            places[pair] = here.tolist()
    symbols = laid.tolist()
    right, left = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    active = [(merges[pair][0], pair) for pair in places]
    heapq.heapify(active)
    while active:
        pair = heapq.heappop(active)[1]
        (a, b), token, here = pair, merges[pair][1], places.pop(pair)
        if a == b:
            here.sort()  # in a run of one letter the leftmost pair comes first
        for at in here:
            second = right[at]
            if symbols[at] != a or symbols[second] != b:
                continue
            before, after = left[at], right[second]
            symbols[at], symbols[second] = token, -2
            right[at], left[after] = after, at
            if (other := symbols[before]) >= 0:
                new = other, token
                if (held := places.get(new)) is not None:
                    held.append(before)
                elif new in merges:
                    places[new] = [before]
                    heapq.heappush(active, (merges[new][0], new))
            if (other := symbols[after]) >= 0:
                new = token, other
                if (held := places.get(new)) is not None:
                    held.append(at)
                elif new in merges:
                    places[new] = [at]
                    heapq.heappush(active, (merges[new][0], new))
    left_over = np.array(symbols, np.int32)
    alive = left_over >= 0
    packed = left_over[alive].tobytes()
    ends = 4 * np.cumsum(alive)[np.cumsum(sizes + 1) - 1]
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Encoder:
    """Encodes texts one after another and remembers the tokens of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}
        self.pattern, self.ascii_pattern = regex.compile(SPLIT), re.compile(ASCII_SPLIT)
        listed = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, listed)) + ")") if listed else None
        self.settled = settled_characters()
        self._library = None

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.vocabulary.source).pre_tokenizer
        return self._library

    def split(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, in lists of bounded length.

        A piece depends on the characters up to one after its end, so all but the last two of a window are final.
        """
        start, width = 0, WINDOW
        while start < len(text):
            part = text[start : start + width]
            last = start + width >= len(text)
            if part.isascii():
                pieces = self.ascii_pattern.findall(part)
            elif self.settled.issuperset(set(part)):
                pieces = self.pattern.findall(part)
            else:
                pieces = [part[a:b] for _, (a, b) in self.library().pre_tokenize_str(part)]
            if not last:
                if len(pieces) < 3:
                    width *= 2
                    continue
                pieces = pieces[:-2]
            yield pieces
            start, width = start + sum(map(len, pieces)), WINDOW

    def units(self, text: str) -> Iterator[list[str] | int]:
        """Lists of pieces and ids of special tokens, in order."""
        for part in self.special.split(text) if self.special else [text]:
            if part in self.vocabulary.special:
                yield self.vocabulary.special[part]
            elif part:
                yield from self.split(part)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The tokens of each text as packed 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[list[bytes], list[str] | int]] = []
        count = 0

        def flush() -> None:
            met = set().union(*(unit for _, unit in waiting if not isinstance(unit, int)))
            if len(self.known) + len(met) > KNOWN:
                self.known = {}
            new = sorted(met - self.known.keys())
            self.known.update(zip(new, merged([p.encode() for p in new], self.vocabulary)))
            for ids, unit in waiting:
                if isinstance(unit, int):
                    ids.append(np.int32(unit).tobytes())
                else:
                    ids.append(b"".join(map(self.known.__getitem__, unit)))
            waiting.clear()

        for ids, text in zip(out, texts):
            for unit in self.units(text):
                waiting.append((ids, unit))
                count += 1 if isinstance(unit, int) else len(unit)
                if count >= GROUP:
                    flush()
                    count = 0
        flush()
        return [b"".join(ids) for ids in out]


@lru_cache(maxsize=1)
def encoder_of(source: str) -> Encoder:
    """One encoder for each Python worker, so that tasks share what it has learnt."""
    return Encoder(Vocabulary(source))


def settled_characters() -> frozenset[str]:
    """The characters of Unicode 3.2, whose classes no longer differ between versions."""
    old = unicodedata.ucd_3_2_0
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if old.category(c) not in ("Cn", "Cs"))


def _lists(values: Sequence[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(values), np.int32)))


def _parts(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose last column holds about ``limit`` bytes at most, or single rows."""
    sizes = batch.column(batch.num_columns - 1)
    start = total = 0
    for at, value in enumerate(sizes):
        total += len(value.as_buffer()) if value.is_valid else 0
        if total >= limit:
            yield batch.slice(start, at + 1 - start)
            start, total = at + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encoded(docs: DataFrame, vocabulary: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids``, the tokens of the text. ``vocabulary`` is the content of the file, about a megabyte."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 4 * WINDOW):
                encoder = encoder_of(shared.value)
                texts = [(v.as_py() or b"").decode("utf-8", "replace") for v in part.column(part.num_columns - 1)]
                yield pa.record_batch([*part.columns[:-1], _lists(encoder.encode(texts))], names=[*part.schema.names[:-1], "ids"])

    rows = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in keep)
    return rows.mapInArrow(encode, f"{schema}, ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the text that its ``ids`` stand for; null ids stay null."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    place = tokens.columns.index("ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = encoder_of(shared.value).vocabulary.tokens
            texts = []
            for ids in batch.column(place):
                if ids.is_valid:
                    listed = ids.values.to_numpy(zero_copy_only=False).tolist()
                    texts.append(b"".join([known.get(i, b"") for i in listed]).decode("utf-8", "replace"))
                else:
                    texts.append(None)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{c}` {t}" for c, t in tokens.dtypes)
    return tokens.mapInArrow(decode, f"{schema}, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    vocabulary = read_vocabulary(path)
    both = decoded(encoded(docs, vocabulary), vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
