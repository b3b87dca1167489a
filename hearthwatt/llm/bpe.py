"""Byte-level BPE: encoding to ids with offsets, and decoding.

A rank file names a vocabulary of byte strings; two neighbouring pieces merge when their
concatenation is in it, lowest rank first, leftmost first among equals. The merges are done
by the tokenizers library, whose alphabet is not bytes but one printable character a byte.
"""

from __future__ import annotations

import base64
import codecs
import heapq
import os
import re
import unicodedata
from collections.abc import Iterable
from functools import cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.frames import map_rows, text_or_empty

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct words that one Python worker remembers before it starts anew.
WORDS_KEPT = 600_000
#: Words encoded in one call.
WORDS_JOINED = 5_000
#: Longer words are encoded without being remembered.
LONG_WORD = 64
#: Code points whose words are encoded together.
CHARS_AT_ONCE = 2_000_000

#: public_tokenizers.PATTERN in terms of the standard library. The two agree on texts
#: without the characters in _odd_characters().
QUICK_PATTERN = re.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
)
SPACED_WORD = re.compile(r" [^\W\d_]+")


@cache
def _odd_characters() -> re.Pattern:
    """Numbers that are not digits, control characters that only some engines call space,
    and all characters beyond U+FFFF, which would make this class slow."""
    odd = [chr(i) for i in range(0x10000) if unicodedata.category(chr(i)) in ("Nl", "No")]
    return re.compile("[" + "".join(["\x1c\x1d\x1e\x1f\x85", *odd]) + "\U00010000-\U0010ffff]")


@cache
def byte_characters() -> tuple[str, ...]:
    """The character that stands for each byte: itself if it is printable Latin-1, else the
    next unused one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b if b in printable else next(spare)) for b in range(256))


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def _splits(token: bytes, known: dict[bytes, int]) -> tuple[list[int], bool]:
    """Where two known pieces meet in ``token``, and whether no order of them is right.

    In x y z with x + y = y + z = token the leftmost pair, x + y, must come first; for that,
    splits whose right part also begins the token lead. If both orders occur (x and y repeat
    one unit), the library can't follow the rule.
    """
    size = len(token)
    at = [k for k in range(1, size) if token[:k] in known and token[k:] in known]
    leads = {k for k in at if size - k in at and 2 * k != size and token.endswith(token[: size - k])}
    leads = {k for k in leads if token[k:] == token[: size - k]}
    return sorted(at, key=lambda k: k not in leads), any(size - k in leads for k in leads)


@cache
def rank_tokenizer(path: str):
    """A tokenizers.Tokenizer with the merges of a rank file, and the tokens for which
    its order of merges can differ."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    known, letters = ranks(path), byte_characters()
    name = {token: "".join(letters[b] for b in token) for token in known}
    merges, unclear = [], []
    for token in sorted(known, key=known.get):
        splits, open_order = _splits(token, known)
        merges += [(name[token[:k]], name[token[k:]]) for k in splits]
        if open_order:
            unclear.append(token)
    model = models.BPE({name[t]: i for t, i in known.items()}, merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer, unclear


def merged(word: bytes, known: dict[bytes, int]) -> list[int]:
    """The merges of one word, with a heap of (rank, place): O(n log n)."""
    if word in known:
        return [known[word]]
    size = len(word)
    end, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and end[at] < size and (rank := known.get(word[at : end[end[at]]])) is not None:
            heapq.heappush(heap, (rank, at, end[end[at]]))

    for at in range(size):
        offer(at)
    while heap:
        _, at, stop = heapq.heappop(heap)
        if not alive[at] or end[at] >= size or end[end[at]] != stop:
            continue
        alive[end[at]] = False
        end[at] = stop
        if stop < size:
            before[stop] = at
        offer(at)
        offer(before[at])
    return [known[word[at : end[at]]] for at in range(size) if alive[at]]


class WordEncoder:
    """Encodes texts word by word and remembers words; ids are little-endian 32-bit bytes.

    Merges never cross the words of the pattern, so a word has the same ids in any text.
    Texts on which the two patterns could differ go to the library in whole.
    """

    def __init__(self, tokenizer, known: dict[bytes, int], unclear: list[bytes]):
        self.tokenizer, self.known, self.unclear = tokenizer, known, unclear
        vocabulary = tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.lengths[list(vocabulary.values())] = list(map(len, vocabulary))
        self.words: dict[str, bytes] = {}

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _joined(self, words: list[str]) -> Iterable[bytes]:
        """Words that begin with a space and go on with letters stay words when joined, so one
        call encodes thousands; the ids' byte lengths tell where each ends."""
        ids = self._batch(["".join(words)])[0]
        stops = np.cumsum(self.lengths[ids])
        last = np.searchsorted(stops, np.cumsum([len(w.encode()) for w in words])) + 1
        raw, ends = ids.tobytes(), (last * 4).tolist()
        return (raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True))

    def _new(self, words: list[str]) -> dict[str, bytes]:
        new, plain, spaced = {}, [], []
        everything = "\n".join(words).encode()
        unclear = [t for t in self.unclear if t in everything]
        for word in words:
            if unclear and any(t in word.encode() for t in unclear):
                new[word] = np.array(merged(word.encode(), self.known), "<u4").tobytes()
            else:
                (spaced if SPACED_WORD.fullmatch(word) else plain).append(word)
        new |= zip(plain, (ids.tobytes() for ids in self._batch(plain)), strict=True)
        for start in range(0, len(spaced), WORDS_JOINED):
            some = spaced[start : start + WORDS_JOINED]
            new |= zip(some, self._joined(some), strict=True)
        return new

    def _whole(self, text: str) -> bytes:
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        words = [text[a:b] for _, (a, b) in parts]
        table = self._new(list(set(words)))
        return b"".join(map(table.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars < CHARS_AT_ONCE):
                chars += len(texts[stop])
                stop += 1
            out += self._some(texts[start:stop])
            start = stop
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        split = [None if _odd_characters().search(t) else QUICK_PATTERN.findall(t) for t in texts]
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        found = [words and list(map(self.words.get, words)) for words in split]
        unknown = list(
            {
                word
                for words, ids in zip(split, found, strict=True)
                if words and None in ids
                for word, x in zip(words, ids, strict=True)
                if x is None
            }
        )
        new = self._new(unknown)
        self.words.update((w, ids) for w, ids in new.items() if len(w) <= LONG_WORD)
        return [
            self._whole(text)
            if words is None
            else b"".join([new[w] if x is None else x for w, x in zip(words, ids, strict=True)])
            for text, words, ids in zip(texts, split, found, strict=True)
        ]


@cache
def rank_encoder(path: str) -> WordEncoder:
    tokenizer, unclear = rank_tokenizer(path)
    return WordEncoder(tokenizer, ranks(path), unclear)


@cache
def _bytes_by_id(path: str) -> dict[int, bytes]:
    """The byte table reversed: from the library's token strings back to bytes."""
    back = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = rank_tokenizer(path)[0].get_vocab()
    return {i: bytes(back[c] for c in token) for token, i in vocabulary.items()}


def decoded(ids: Iterable[int], path: str) -> bytes:
    return b"".join(map(_bytes_by_id(path).__getitem__, ids))


def decoded_parts(parts: Iterable[Iterable[int]], path: str) -> Iterable[str]:
    """Text of consecutive lists of ids; a character split between two of them is held back
    until it is whole, and bytes that never form one become U+FFFD."""
    held = codecs.getincrementaldecoder("utf-8")("replace")
    for ids in parts:
        yield held.decode(decoded(ids, path))
    yield held.decode(b"", final=True)


def offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First code point and first one after it, for each id. Ids that share the bytes of one
    character all cover that character."""
    raw = np.frombuffer(text.encode(), np.uint8)
    table = _bytes_by_id(path)
    stop = np.cumsum([len(table[i]) for i in ids.tolist()], dtype=np.int64)
    start = np.concatenate([[0], stop[:-1]]).astype(np.int64) if len(stop) else stop
    place = np.cumsum((raw & 0xC0) != 0x80) - 1
    return (place[start], place[stop - 1] + 1) if len(stop) else (start, stop)


def bpe_encode(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``ids``, ``starts`` and ``ends`` (code points) of every text.

    A null text counts as empty and gives empty arrays; each row, also a repeated one, gives
    one row. Other columns are not read, so their names can't clash.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def encode(rows):
        all_ids = [np.frombuffer(x, "<u4") for x in rank_encoder(path).encode(rows[text_col])]
        spans = [offsets(t, i, path) for t, i in zip(rows[text_col], all_ids, strict=True)]
        return {
            id_col: rows[id_col],
            "ids": [i.astype(np.int32) for i in all_ids],
            "starts": [a.astype(np.int32) for a, _ in spans],
            "ends": [b.astype(np.int32) for _, b in spans],
        }

    schema = f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>"
    return map_rows(df.select(id_col, text_or_empty(text_col)), encode, schema)


def bpe_decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``bytes`` and ``text`` of every list of ids.

    A null list, and a null inside one, stand for nothing. ``text`` has U+FFFD where the bytes
    are no UTF-8, as where a list ends within a character. An unknown id is an error.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def decode(rows):
        raw = [decoded([i for i in ids if i is not None], path) for ids in rows[ids_col]]
        return {id_col: rows[id_col], "bytes": raw, "text": [r.decode("utf-8", "replace") for r in raw]}

    filled = df.select(id_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(ids_col))
    return map_rows(filled, decode, f"`{id_col}` {kind}, bytes binary, text string")


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number and SHA-256 of the ids of every text, and SHA-256 of what they decode to."""
    from hashlib import sha256

    kind = df.schema[id_col].dataType.simpleString()

    def digest(rows):
        lists = [np.frombuffer(x, "<u4").tolist() for x in rank_encoder(path).encode(rows[text_col])]
        return {
            id_col: rows[id_col],
            "n_tokens": [len(ids) for ids in lists],
            "ids_sha256": [sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in lists],
            "decoded_sha256": [sha256(decoded(ids, path)).hexdigest() for ids in lists],
        }

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(df.select(id_col, text_or_empty(text_col)), digest, schema)
