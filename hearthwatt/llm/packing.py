"""Packing documents into sequences of a fixed length by best-two-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.bpe import ranks
from hearthwatt.llm.frames import map_rows, stored, text_or_empty

#: Documents packed together. A group leaves at most about one sequence unfilled, so larger
#: groups gain nothing, and one is a few hundred kilobytes.
DOCUMENTS_AT_ONCE = 8192


class Shelf:
    """Unpacked lengths: how many there are of each, and the distinct ones in order."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1)
        self.distinct = np.flatnonzero(self.count).tolist()

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.distinct[bisect_right(self.distinct, length) - 1]

    def put(self, length: int) -> None:
        if not self.count[length]:
            self.distinct.insert(bisect_right(self.distinct, length), length)
        self.count[length] += 1

    def largest(self, room: int) -> int:
        """The largest length of at most ``room``, 0 if there is none."""
        at = bisect_right(self.distinct, room)
        return self.distinct[at - 1] if at else 0

    def two(self, room: int) -> tuple[int, int]:
        """The two lengths with the largest sum of at most ``room``; zeros if there are none."""
        sizes = np.array(self.distinct[: bisect_right(self.distinct, room - 1)], np.int64)
        partner = np.searchsorted(sizes, room - sizes, "right") - 1
        # A length can be its own partner only if there are two of it.
        partner -= (partner == np.arange(len(sizes))) & (self.count[sizes] < 2)
        total = np.where(partner >= 0, sizes + sizes[partner], 0)
        if not len(total) or not total.max():
            return 0, 0
        best = int(total.argmax())
        return int(sizes[best]), int(sizes[partner[best]])


def bins(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of lengths: each is filled with the largest length that still fits, then its
    smallest one gives way to two that fill the bin better, as long as there are such."""
    shelf = Shelf(lengths, capacity)
    out = []
    while shelf.distinct:
        held, room = [], capacity
        while length := shelf.largest(room):
            shelf.take(length)
            held.append(length)
            room -= length
        while room:
            smallest = held[-1]
            one, other = shelf.two(room + smallest)
            if one + other <= smallest:
                break
            held.pop()
            for length in (one, other):
                shelf.take(length)
                held.append(length)
            shelf.put(smallest)
            held.sort(reverse=True)
            room -= one + other - smallest
        out.append(held)
    return out


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length; equal lengths are dealt in their order."""
    waiting: dict[int, list[int]] = {}
    for row in range(len(lengths) - 1, -1, -1):
        waiting.setdefault(int(lengths[row]), []).append(row)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, held in enumerate(bins(lengths, capacity)):
        place = 0
        for length in held:
            row = waiting[length].pop()
            number[row], offset[row] = k, place
            place += length
    return number, offset


def piece_lengths(total: int, capacity: int) -> list[int]:
    """A document longer than a sequence is cut so that only its first piece can be shorter."""
    first = (total - 1) % capacity + 1
    return [first] + [capacity] * ((total - first) // capacity)


class Encoder:
    """The ids that the tokenizer file's library gives. It finds added tokens in texts; a text
    without any gets the same ids, several times as fast, from the vocabulary's ranks."""

    def __init__(self, tokenizer_path: str, rank_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.encoding = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(rank_path), special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)


@cache
def encoder(tokenizer_path: str, rank_path: str) -> Encoder:
    """One for each pair of files, in a worker."""
    return Encoder(tokenizer_path, rank_path)


def document_pieces(
    df: DataFrame, tokenizer_path: str, rank_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each document its pieces' lengths and the CRC-32 of their ids, id 0 at the end."""
    kind = df.schema[id_col].dataType.simpleString()

    def cut(rows):
        lengths, sums = [], []
        for text in rows[text_col]:
            ids = np.array([*encoder(tokenizer_path, rank_path).ids(text), 0], "<u4")
            lengths.append(piece_lengths(len(ids), capacity))
            stops = np.cumsum(lengths[-1])
            sums.append([zlib.crc32(ids[b - n : b].tobytes()) for n, b in zip(lengths[-1], stops, strict=True)])
        return {id_col: rows[id_col], "lengths": lengths, "sums": sums}

    schema = f"`{id_col}` {kind}, lengths array<long>, sums array<long>"
    return map_rows(df.select(id_col, text_or_empty(text_col)), cut, schema)


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    rank_path: str,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_size: int = DOCUMENTS_AT_ONCE,
) -> DataFrame:
    """Place all documents in sequences of at most ``capacity`` tokens; one row per piece.

    Ids are those of the library and file ``tokenizer_path``, added tokens included; ``rank_path``
    has the same vocabulary. A null or empty text is a document of one token, the closing 0; a row is a document, also
    a repeated one or one with a null id. Pieces of full length are a sequence by themselves.
    The one shorter piece of each document is packed with those of other documents, dealt
    evenly, whatever their ids, into groups of about ``group_size`` rows. A row has a few
    numbers, so no group grows with texts. An empty table gives no rows.
    """
    pieces = stored(document_pieces(df, tokenizer_path, rank_path, capacity, id_col, text_col), "pieces")
    groups = -(-pieces.count() // group_size) or 1
    kind = df.schema[id_col].dataType.simpleString()
    dealt = pieces.withColumn("pack_group", F.monotonically_increasing_id() % groups)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        docs, lengths, sums = (table[c].to_pylist() for c in (id_col, "lengths", "sums"))
        number, offset = pack_group(np.array([x[0] for x in lengths], np.int64), capacity)
        sequence = int(number.max()) + 1
        out: dict[str, list] = {name: [] for name in target.names}
        for row, sizes in enumerate(lengths):
            start = 0
            for piece, size in enumerate(sizes):
                place = (sequence, 0) if piece else (int(number[row]), int(offset[row]))
                sequence += piece > 0
                found = (docs[row], piece, start, size, sums[row][piece], (key[0].as_py() << 40) + place[0], place[1])
                for values, value in zip(out.values(), found, strict=True):
                    values.append(value)
                start += size
        return pa.Table.from_pydict(out, schema=target)

    schema = (
        f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )
    target = to_arrow_schema(StructType.fromDDL(schema))
    return dealt.groupBy("pack_group").applyInArrow(pack, schema)
