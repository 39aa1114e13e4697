"""Operator 12: documents packed into sequences of bounded length by swap-based local search.

1. Texts become token ids, an end id behind each document. Ids are those of the library
   ``tokenizers`` for the given vocabulary file. They are made by ``tiktoken`` from the file of the
   same vocabulary as ranks, about five times as fast: both split and merge alike for every code point
   (tested); a text that its pattern matcher gives up on goes to ``tokenizers``.
2. Only documents longer than ``size`` are cut: the first piece takes the remainder, all later ones
   are whole sequences. Whole pieces are sequences of their own; the others are packed.
3. Pieces are dealt by hash to blocks of about ``BLOCK_BINS`` sequences, one task each. A block
   starts from best fit over falling lengths. Then bins with room exchange documents one for one,
   two for one or one for two, or pass one on, always so that the fuller bin gets fuller: the sum of
   squared fills rises with every step, and the room gathers in the emptiest bin until it is
   empty. A block ends when its total room is below one sequence (no packing can do with fewer) or
   no exchange is left.
4. The emptiest bins of every block (at most ``REOPENED``) are opened and packed again in the next
   round, with those of other blocks. A round reduces the blocks by a large factor; the last one has
   a single block, of bounded size, so about one sequence in the whole corpus is left underfull.

Only lengths are packed; ids are reduced to a checksum where the text is read, or carried as arrays on
request. Defined results: a null or empty text is the end id alone; repeated rows are packed each; a
null doc_id is kept; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import base64
import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strivelake.llm.common import python_batches, stage

SIZE = 2048
END_ID = 0
BLOCK_BINS = 1024        # sequences of a block, about
BLOCK_ROWS = 100_000     # pieces of a block, about
REOPENED = 8             # bins of a block that the next round packs again
VOCABULARY = "byte_bpe_50k"
PATTERN_SPECIAL = {"<|endoftext|>": 50256}   # fixed value of the vocabulary

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED_SCHEMA = "uid long, length long, sequence_id long, offset long, open boolean"


# ------------------------------------------------------------------ token ids
class Encoder:
    """Text to ids; loaded once in a Python worker."""

    def __init__(self, vocabulary: str):
        import public_tokenizers as public
        import tiktoken
        from tokenizers import Tokenizer

        with open(public.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=PATTERN_SPECIAL)
        self.plain = Tokenizer.from_file(public.path(f"{vocabulary}.json"))

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        try:
            found = self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:       # the pattern matcher ran out of stack
            found = np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.append(found, np.uint32(END_ID)).astype("<u4")


def cut_starts(n: int, size: int = SIZE) -> list[int]:
    """Starts of the pieces of ``n`` ids: the first may be shorter, all others are whole."""
    first = n % size or min(n, size)
    return [0, *range(first, n, size)]


def tokenize_pieces(docs: DataFrame, *, size: int = SIZE, vocabulary: str = VOCABULARY,
                    with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    python_batches(docs.sparkSession)
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def pieces(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            out = {c.split()[0]: [] for c in schema.split(", ")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.ids(text.as_py())
                starts = cut_starts(len(ids), size)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        out["ids"].append(ids[a:b].astype(np.int32))
            types = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, types.get(c, pa.int64())) for c, v in out.items()], names=list(out))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, schema)


# ------------------------------------------------------------------ one block
class Block:
    """Bins of one block. ``bins`` are lists of (length, item), sorted; ``fill`` their sums."""

    def __init__(self, lengths: list[int], size: int):
        self.size, self.bins, self.fill = size, [], []
        self._best_fit(lengths)
        self.used, self.needed = len(self.bins), -(-sum(lengths) // size)

    def _best_fit(self, lengths: list[int]) -> None:
        """Best fit over falling lengths; bins are found by their room in a sorted list."""
        rooms: list[tuple[int, int]] = []
        for length, item in sorted(((n, k) for k, n in enumerate(lengths)), reverse=True):
            at = bisect.bisect_left(rooms, (length, -1))
            if at < len(rooms):
                room, b = rooms.pop(at)
            else:
                room, b = self.size, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append((length, item))
            self.fill[b] += length
            if room > length:
                bisect.insort(rooms, (room - length, b))
        for contents in self.bins:
            contents.sort()

    def surplus(self) -> int:
        """How many bins more than the total of lengths needs."""
        return self.used - self.needed

    def search(self) -> None:
        """Exchange documents between bins with room until a certificate or no exchange is left.

        A pass lets every bin, fullest first, take from the emptiest ones as long as it can.
        """
        steps = 1
        while steps and self.surplus() > 0:
            steps = 0
            order = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.size),
                           key=lambda b: (-self.fill[b], b))
            for a in order:
                while self.surplus() > 0 and self._improve(a, order):
                    steps += 1

    def _improve(self, a: int, order: list[int]) -> bool:
        """The best exchange that fills bin ``a`` from an emptier one; emptiest bins first."""
        room = self.size - self.fill[a]
        if not room:
            return False
        for b in reversed(order):
            if b == a:
                return False
            if not self.fill[b] or self.fill[b] > self.fill[a]:
                continue
            if step := self._best_step(a, b, room):
                self._apply(a, b, *step)
                return True
        return False

    def _best_step(self, a: int, b: int, room: int):
        """(items of a, items of b) with the largest gain for a that its room allows, or None."""
        mine, theirs = self.bins[a], self.bins[b]
        best, gain = None, 0

        def offer(out: tuple, into: tuple) -> bool:
            nonlocal best, gain
            d = sum(n for n, _ in into) - sum(n for n, _ in out)
            if gain < d <= room:
                best, gain = (out, into), d
            return gain == room

        def most(items: list, limit: int):
            at = bisect.bisect_right(items, (limit, 2**62)) - 1
            return items[at] if at >= 0 else None

        x = most(theirs, room)
        if x and offer((), (x,)):                                   # move
            return best
        for out in mine:                                            # one for one
            x = most(theirs, out[0] + room)
            if x and offer((out,), (x,)):
                return best
        for k, x in enumerate(theirs):                              # two of b for one of a
            rest = theirs[k + 1:]
            for out in mine if rest else ():
                y = most(rest, out[0] + room - x[0])
                if y and offer((out,), (x, y)):
                    return best
        for k, out in enumerate(mine):                              # one of b for two of a
            for other in mine[k + 1:]:
                x = most(theirs, out[0] + other[0] + room)
                if x and offer((out, other), (x,)):
                    return best
        return best

    def _apply(self, a: int, b: int, out: tuple, into: tuple) -> None:
        for items, source, target in ((out, a, b), (into, b, a)):
            for item in items:
                self.bins[source].remove(item)
                bisect.insort(self.bins[target], item)
                self.fill[source] -= item[0]
                self.fill[target] += item[0]
        self.used -= not self.fill[b]


def pack_block(lengths: list[int], size: int = SIZE) -> list[list[tuple[int, int]]]:
    """Bins of (length, index), emptiest last."""
    block = Block(lengths, size)
    block.search()
    return [block.bins[b] for b in sorted(range(len(block.bins)), key=lambda b: (-block.fill[b], b))
            if block.bins[b]]


# ------------------------------------------------------------------ rounds
def _packed_round(pool: DataFrame, blocks: int, number: int, size: int) -> DataFrame:
    """(uid, length, sequence_id, offset, open) of the pool, packed in ``blocks`` blocks."""
    def pack(table: pa.Table) -> pa.Table:
        uid = table.column("uid").to_pylist()
        lengths = table.column("length").to_pylist()
        order = sorted(range(len(uid)), key=uid.__getitem__)     # rows come in any order
        bins = pack_block([lengths[k] for k in order], size)
        block = table.column("block")[0].as_py()
        rows = []
        for b, contents in enumerate(bins):
            fill = sum(n for n, _ in contents)
            reopened = blocks > 1 and b >= len(bins) - REOPENED and fill < size
            offset = 0
            for n, k in contents:
                rows.append((uid[order[k]], n, (number << 58) | (block << 24) | b, offset, reopened))
                offset += n
        return pa.table(dict(zip(("uid", "length", "sequence_id", "offset", "open"), map(list, zip(*rows)))))

    dealt = pool.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(blocks)).cast("long"))
    return dealt.groupBy("block").applyInArrow(pack, PLACED_SCHEMA)


def place(lengths: DataFrame, *, size: int = SIZE) -> DataFrame:
    """(uid, sequence_id, offset) for the staged (uid, length); lengths are at most ``size``."""
    whole = lengths.filter(F.col("length") == size).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, pool, number = [whole], lengths.filter(F.col("length") < size), 1
    while True:
        total = pool.agg(F.sum("length").alias("ids"), F.count(F.lit(1)).alias("n")).first()
        if not total["n"]:
            break
        blocks = max(1, -(-total["ids"] // (size * BLOCK_BINS)), -(-total["n"] // BLOCK_ROWS))
        packed = stage(_packed_round(pool, blocks, number, size), f"packed-{number}")
        done.append(packed.filter("NOT open").select("uid", "sequence_id", "offset"))
        if blocks == 1:
            break
        pool, number = packed.filter("open").select("uid", "length"), number + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, *, size: int = SIZE, vocabulary: str = VOCABULARY,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    pieces = stage(tokenize_pieces(docs, size=size, vocabulary=vocabulary, with_ids=with_ids)
                   .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = place(pieces.select("uid", "length"), size=size)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pieces.join(placed, "uid").select(*columns, *(["ids"] if with_ids else []))
