"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each at a cost: a fixed part, its tokens, and a part that grows
with their square, as attention does. Pieces are dealt by a hash over shards of about ``SHARD`` pieces and
each shard packs its own, largest first: a piece goes to the open bin where it leaves the least room; if
none has room, a bin opens, of the length that costs least per token that it can still be filled with. At the
end every bin shrinks to the shortest permitted length that holds its contents. Which lengths bins open
at is chosen jointly: a shard is packed with each range of neighbouring lengths, and the packing that
costs least in all counts. A shard is bounded whatever the table's size, and only its last few bins
stay part empty.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stage, stored, word_count

#: Permitted sequence lengths in tokens; a sequence's fixed cost, and the length at which attention costs as much
#: as everything else per token, both in tokens.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD, ATTENTION = 64, 8192
#: Pieces of a shard, about.
SHARD = 16_384


def cost(length: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """What a sequence of a length costs, in tokens."""
    return overhead + length + length * length / attention


def best_fit(
    sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, opened_at: Sequence[int] | None = None, price: Callable[[int], float] = cost
) -> tuple[list[int], list[int], list[int]]:
    """For sizes in descending order: each one's bin and start in it, and each bin's final length.

    Bins open at lengths of ``opened_at``, by default at all; a size that fits none of these opens the
    shortest permitted one. Open bins are kept by room left. No size may exceed the longest length. Among
    bins with equal room the last one opened is used.
    """
    lengths, openings = sorted(capacities), sorted(capacities if opened_at is None else opened_at)
    upward = [-s for s in sizes]  # ascending, to search in
    until = [0, *accumulate(sizes)]
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    with_room: dict[int, list[int]] = {}
    held: list[int] = []
    bins, starts = [], []

    def filled(length: int, at: int) -> int:
        """Tokens that a bin opened for a size can hold at most: it and smaller ones to come that fit."""
        left = length - sizes[at]
        first = max(at + 1, bisect_left(upward, -left))
        return sizes[at] + min(left, until[-1] - until[first])

    for at, size in enumerate(sizes):
        place = bisect_left(rooms, size)
        if place < len(rooms):
            room = rooms[place]
            which = with_room[room].pop()
            if not with_room[room]:
                del with_room[room], rooms[place]
        else:
            fit = [c for c in openings if c >= size] or lengths[bisect_left(lengths, size) :][:1]
            room = min(fit, key=lambda c: (price(c) / filled(c, at), c))
            which = len(held)
            held.append(0)
        bins.append(which)
        starts.append(held[which])
        held[which] += size
        if room > size:
            if room - size not in with_room:
                insort(rooms, room - size)
                with_room[room - size] = []
            with_room[room - size].append(which)
    return bins, starts, [lengths[bisect_left(lengths, x)] for x in held]


def joint_fit(sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, price: Callable[[int], float] = cost) -> tuple[list[int], list[int], list[int]]:
    """The :func:`best_fit` of least cost over all ranges of neighbouring lengths to open bins at, the first at a tie."""
    lengths = sorted(capacities)
    ranges = [lengths[i:j] for i in range(len(lengths)) for j in range(len(lengths), i, -1)]
    return min((best_fit(sizes, lengths, some, price) for some in ranges), key=lambda found: sum(map(price, found[2])))


def pieces(docs: DataFrame, longest: int) -> DataFrame:
    """``doc_id, key, copy, piece, n_tokens``: documents cut into pieces of at most ``longest`` tokens; none if empty.

    Tokens are words here. ``copy`` tells rows with the same doc_id and text apart.
    """
    rows = docs.select("doc_id", word_count(F.col("text")).alias("n"), F.xxhash64("doc_id", "text").alias("key"))
    same = rows.groupBy("doc_id", "key", "n").agg(F.count("*").alias("copies"))
    cut = same.where("n > 0").select("*", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    cut = cut.select("*", F.explode(F.expr(f"sequence(0, (n - 1) div {longest})")).alias("piece"))
    return cut.select("doc_id", "key", "copy", "piece", F.expr(f"least({longest}, n - {longest} * piece)").alias("n_tokens"))


def packed(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION, shard: int = SHARD) -> DataFrame:
    """``doc_id, copy, piece, n_tokens, bin_id, bin_start, bin_capacity, bin_tokens`` for each piece of ``docs(doc_id, text)``.

    Sizes are in words, of which a tokenizer makes two or three tokens each; lengths and costs are in
    the same unit. ``bin_start`` is the piece's place in its bin. Documents longer than the longest permitted
    length are cut; no token is lost. Null and empty texts have no piece. A null doc_id is kept.
    Repeated rows are packed as often as they come, numbered by ``copy`` from 1. Ties are settled
    by the row's content, so reruns agree. An empty table gives an empty result.
    """
    cut = stored(pieces(docs, max(capacities)))
    shards = max(1, -(-cut.count() // shard))
    lengths = tuple(capacities)

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["n_tokens", "key", "copy", "piece"], ascending=[False, True, True, True], kind="stable")
        bins, starts, final = joint_fit(own["n_tokens"].tolist(), lengths, lambda c: cost(c, overhead, attention))
        bins = np.array(bins, np.int64)
        own["bin_start"] = np.array(starts, np.int64)
        own["bin_capacity"] = np.array(final, np.int64)[bins]
        own["bin_tokens"] = own["n_tokens"].groupby(bins).transform("sum")
        own["bin_id"] = (own["shard"].to_numpy(np.int64) << 32) + bins
        return own[["doc_id", "copy", "piece", "n_tokens", "bin_id", "bin_start", "bin_capacity", "bin_tokens"]]

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("key", "copy", "piece"), F.lit(shards)))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, copy long, piece long, n_tokens long, bin_id long, bin_start long, bin_capacity long, bin_tokens long"
    return dealt.groupBy("shard").applyInPandas(pack, schema)


@stage
def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sequences' contents."""
    return packed(docs)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
