"""Codes that meet in a bucket of one of several tables, found without listing pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.common import gathered
from lexmill.llm.tiles import TILE, tiles
from lexmill.runtime import shuffle_partitions

TASK_ROWS = 1 << 20
#: Pairs looked at at once, and pairs of two buckets from which on these are compared as a block of their own.
PAIRS, BLOCK = 1 << 16, 1 << 11
KEYS = [("t", pa.int32()), ("bucket", pa.int64()), ("tile", pa.int64()), ("own", pa.int64()), ("node", pa.int64()), ("code", pa.int64())]
COLUMNS = [name for name, _ in KEYS]
MEETING = pa.schema([*KEYS, ("long_a", pa.int64()), ("long_b", pa.int64())])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def first_table(a: np.ndarray, b: np.ndarray, masks: list[int], slack: int) -> np.ndarray:
    """The first table in which two codes meet: they differ in at most ``slack`` of its bits."""
    differ = a.view(np.uint64) ^ b.view(np.uint64)
    first = np.full(len(a), len(masks))
    for t in reversed(range(len(masks))):
        first[np.bitwise_count(differ & np.uint64(masks[t])) <= slack] = t
    return first


def sorted_groups(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by table, bucket and tile, and the number of the group of each in this order."""
    keys = [rows[c].to_numpy() for c in ("t", "bucket", "tile")]
    order = np.lexsort((rows["node"].to_numpy(), *reversed(keys)))
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.cumsum(new)


def near_pairs(codes: np.ndarray, mask: int, home: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of codes that differ in at most one bit of ``mask`` and ``radius`` bits in all, in chunks, each pair once.

    Codes of one part are all at ``home`` or not, and one of a pair is. Of the part of i and that of j the first is not the larger one.
    """
    part = codes & np.uint64(mask)
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
    values, sizes, hosts = part[order][starts], np.diff(np.append(starts, len(codes))), home[order][starts]
    for flip in (0, *[1 << b for b in range(64) if mask >> b & 1]):
        other = values ^ np.uint64(flip)
        to = np.minimum(np.searchsorted(values, other), len(values) - 1)
        a = np.flatnonzero((values[to] == other) & (values <= other) & (hosts | hosts[to]))
        b = to[a]
        work = sizes[a] * sizes[b]
        large = work >= BLOCK
        for x, y in zip(a[large], b[large], strict=True):
            there = order[starts[y] : starts[y] + sizes[y]]
            step = max(1, PAIRS // len(there))
            for s in range(0, sizes[x], step):
                here = order[starts[x] + s : starts[x] + min(s + step, sizes[x])]
                r, c = np.nonzero(np.bitwise_count(codes[here][:, None] ^ codes[there]) <= radius)
                once = slice(None) if flip else r + s < c
                yield here[r[once]], there[c[once]]
        a, b, work = a[~large], b[~large], work[~large]
        ends, begin = np.cumsum(work), 0
        while begin < len(a):
            base = ends[begin] - work[begin]
            end = max(begin + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            k = np.repeat(np.arange(begin, end), work[begin:end])
            r, c = np.divmod(np.arange(len(k)) - (ends - work)[k] + base, sizes[b[k]])
            i, j = order[starts[a[k]] + r], order[starts[b[k]] + c]
            good = np.bitwise_count(codes[i] ^ codes[j]) <= radius
            if not flip:
                good &= r < c
            yield i[good], j[good]
            begin = end


def _each_once(rows: list[np.ndarray], keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))[: len(row)]
    return row[new], key[new]


def met_rows(rows: DataFrame, count: int, radius: int, long_radius: int, masks: list[int], first: int, tile: int = TILE) -> DataFrame:
    """(t, bucket, node, code) of the ``rows`` (t, bucket, node, code, long_a, long_b; about ``count``) that meet another for the first time.

    The bucket of ``rows`` is the ``first`` bits of the part of table t; a row is at home where it has them itself. Two rows of a bucket meet if
    one is at home there, their parts differ in at most one bit, their codes in ``radius`` and their long codes in ``long_radius`` bits, and no
    earlier table brings them together. A row comes back with the smaller part of the two as its bucket, once per tile and
    such part, however many it meets. A bucket of any size is compared in tiles.
    """
    blocks = [sum([1 << b for b in range(64) if m >> b & 1][:first]) for m in masks]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(batches, MEETING)
        order, group = sorted_groups(table)
        if len(order) == 0:
            return
        t_of, bucket_of, own_of, tile_of, node_of = (table[c].to_numpy()[order] for c in ("t", "bucket", "own", "tile", "node"))
        code_of, a_of, b_of = (table[c].to_numpy()[order].view(np.uint64) for c in ("code", "long_a", "long_b"))
        edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(order))
        for lo, hi in zip(edges, edges[1:], strict=False):
            t, block, own, node, code, a, b = t_of[lo], bucket_of[lo], own_of[lo:hi], node_of[lo:hi], code_of[lo:hi], a_of[lo:hi], b_of[lo:hi]
            split = tile_of[lo] >> 31 != tile_of[lo] & ((1 << 31) - 1)  # two chunks: pairs within one meet elsewhere
            home, mask = (code & np.uint64(blocks[t])).view(np.int64) == block, np.uint64(masks[t])
            hit, buckets, held = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
            for i, j in near_pairs(code, masks[t], home, radius):
                near = np.bitwise_count(a[i] ^ a[j]) + np.bitwise_count(b[i] ^ b[j]) <= long_radius
                near &= node[i] != node[j]
                if split:
                    near &= own[i] != own[j]
                i, j = i[near], j[near]
                good = first_table(code[i], code[j], masks, 1) == t
                i, j = i[good], j[good]
                if len(i):
                    hit, buckets, held = [*hit, i, j], [*buckets, code[i] & mask, code[i] & mask], held + 2 * len(i)
                if held > TASK_ROWS:
                    (row, key), held = _each_once(hit, buckets), 0
                    hit, buckets = [row], [key]
            row, key = _each_once(hit, buckets)
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), t, np.int32)), pa.array(key.view(np.int64)), pa.array(node[row]), pa.array(code[row].view(np.int64))], ["t", "bucket", "node", "code"])

    tasks = max(shuffle_partitions(rows.sparkSession), -(-count // TASK_ROWS))
    rows = tiles(rows, tile).select(*MEETING.names).repartition(tasks, "t", "bucket", "tile")
    return rows.mapInArrow(meet, "t int, bucket bigint, node bigint, code bigint")
