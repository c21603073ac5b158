"""SimHash near-duplicates through an index of byte positions with count filtering.

A fingerprint's 64 bits are 8 bytes. Two fingerprints that differ in at most ``d`` bits differ in at
most ``d`` bytes, so they share at least ``8 - d`` positional bytes. The index posts every distinct
fingerprint under each choice of three (position, byte) entries; where two meet, the positional bytes
that they share are tallied, pairs below the guaranteed minimum are dropped, and only the others are
verified bit by bit. A pair that meets under several choices counts under the first of them only.
Links leave a posting as a forest (links that connect the same fingerprints), never as all pairs.
A posting longer than BLOCK is set aside and compared block against block in tasks of their own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows
from .components import connected

#: Entries of a posting that one task compares at once; longer postings go block by block.
BLOCK = 4096
#: Byte positions posted together.
TOGETHER = 3
CHOICES = list(combinations(range(8), TOGETHER))
#: For the set of shared positions (a bit each): the first choice that lies in it, and how many they are.
FIRST = np.array(
    [next((i for i, c in enumerate(CHOICES) if all(s >> p & 1 for p in c)), -1) for s in range(256)], np.int16
)
TALLY = np.bitwise_count(np.arange(256, dtype=np.uint8))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text; 0 if it has no word."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    lasts = ends[min(shingle, len(words)) - 1 :].tolist()
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    pairs = list(zip(starts[:n].tolist(), lasts, strict=True))
    for at in range(0, n, 65536):  # bounded memory for very long texts
        h = np.array([digest(view[s:e], 42) for s, e in pairs[at : at + 65536]], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp long) of every row."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b[text_col]], np.uint64).view(np.int64)
            yield {id_col: b[id_col], "fp": fp}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, fp long", run)


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The set of positional bytes that fingerprints share, a bit each (position 0 is the lowest byte)."""
    a, b = np.broadcast_arrays(a, b)
    same = np.ascontiguousarray(a, "<u8").view(np.uint8) == np.ascontiguousarray(b, "<u8").view(np.uint8)
    return np.packbits(same.reshape(-1, 8), axis=1, bitorder="little").ravel()


def retained(a: np.ndarray, b: np.ndarray, choice, bits: int) -> np.ndarray:
    """Numbers of the pairs that count under this choice and reach the guaranteed minimum of shared bytes."""
    shared = shared_bytes(a, b)
    return np.flatnonzero((TALLY[shared] >= 8 - bits) & (FIRST[shared] == choice))


def _linked(a: np.ndarray, b: np.ndarray, choice, bits: int) -> np.ndarray:
    """Which pairs are links that count under this choice: the tally first, the bits of what it retains after it."""
    a, b = np.broadcast_arrays(a, b)
    ok = np.zeros(a.shape, bool)
    kept = retained(a, b, choice, bits)
    ok[kept] = np.bitwise_count(a[kept] ^ b[kept]) <= bits
    return ok


def _forest(fp: np.ndarray, choice: int, bits: int) -> tuple[list, list]:
    """Links of one posting that connect what all its links connect, by breadth-first search."""
    left, right = [], []
    rest = fp
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            p = front.pop()
            hit = _linked(rest, p, choice, bits)
            if hit.any():
                near = rest[hit]
                left += [p] * len(near)
                right += near.tolist()
                front += list(near)
                rest = rest[~hit]
    return left, right


def _between(a: np.ndarray, b: np.ndarray, choice: int, bits: int) -> tuple[list, list]:
    """Links between two blocks of a posting, as a forest over both."""
    left, right = [], []
    rest = {0: a, 1: b}
    while len(rest[0]) and len(rest[1]):
        front = [(rest[0][0], 0)]
        rest[0] = rest[0][1:]
        while front:
            p, side = front.pop()
            other = rest[1 - side]
            hit = _linked(other, p, choice, bits)
            if hit.any():
                near = other[hit]
                left += [p] * len(near)
                right += near.tolist()
                front += [(x, 1 - side) for x in near]
                rest[1 - side] = other[~hit]
    return left, right


def _out(left, right, **more) -> dict:
    a, b = np.array(left, np.uint64).view(np.int64), np.array(right, np.uint64).view(np.int64)
    return {"key": more.get("key", np.full(len(a), -1, np.int32)), "block": more.get("block", np.full(len(a), -1, np.int32)), "a": a, "b": b}


def _postings(bits: int):
    """Rows (key, fp), sorted by key, to links; rows of long postings come out as they are, with a block."""

    def run(batches):
        # a posting can go on in the next batch: its key, what is held of it, blocks set aside so far
        key, held, blocks = None, [], 0

        def close():
            fp = np.concatenate(held) if held else np.empty(0, np.uint64)
            if blocks:
                return _out(fp, fp, key=np.full(len(fp), key, np.int32), block=np.full(len(fp), blocks, np.int32))
            return _out(*_forest(fp, key >> 24, bits)) if len(fp) > 1 else None

        for b in batches:
            keys = np.array(b["key"], np.int64)
            fps = np.array(b["fp"], np.int64).view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            bounds = np.concatenate(([0], cuts, [len(keys)]))
            if not len(keys):
                continue
            # postings wholly inside of this batch with few entries are compared together, by distance
            head, tail = bounds[1], bounds[-2]
            small_k, small_f = keys[head:tail], fps[head:tail]
            long = np.repeat(np.diff(bounds), np.diff(bounds))[head:tail] > 8
            at = np.flatnonzero(~long)
            step, left, right = 1, [], []
            while len(at):
                at = at[at + step < len(small_k)]
                at = at[small_k[at] == small_k[at + step]]
                ok = _linked(small_f[at], small_f[at + step], small_k[at] >> 24, bits) if len(at) else at
                left.append(small_f[at[ok]] if len(at) else small_f[:0])
                right.append(small_f[at[ok] + step] if len(at) else small_f[:0])
                step += 1
            if left:
                yield _out(np.concatenate(left), np.concatenate(right))
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                if head <= s < tail and e - s <= 8:
                    continue
                if keys[s] != key:
                    if key is not None and (out := close()):
                        yield out
                    key, held, blocks = int(keys[s]), [], 0
                held.append(fps[s:e])
                while sum(map(len, held)) >= BLOCK + (0 if blocks else 1):
                    fp = np.concatenate(held)
                    yield _out(fp[:BLOCK], fp[:BLOCK], key=np.full(BLOCK, key, np.int32), block=np.full(BLOCK, blocks, np.int32))
                    held, blocks = [fp[BLOCK:]], blocks + 1
        if key is not None and (out := close()):
            yield out

    return run


def _tiles(bits: int):
    """Rows (key, low, high, block, fp), sorted, to links between two blocks or inside of one."""

    def run(batches):
        tile, sides = None, {0: [], 1: []}

        def close():
            a, b = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in sides.values())
            return _out(*(_forest(a, tile[0] >> 24, bits) if tile[1] == tile[2] else _between(a, b, tile[0] >> 24, bits)))

        for b in batches:
            rows = np.array([b["key"], b["low"], b["high"], b["block"]], np.int64)
            fps = np.array(b["fp"], np.int64).view(np.uint64)
            cuts = np.flatnonzero((np.diff(rows, axis=1) != 0).any(axis=0)) + 1
            for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)])), strict=True):
                if s == e:
                    continue
                k, low, high, block = rows[:, s].tolist()
                if (k, low, high) != tile:
                    if tile:
                        yield close()
                    tile, sides = (k, low, high), {0: [], 1: []}
                sides[int(block != low)].append(fps[s:e])
        if tile:
            yield close()

    return run


def links(fps: DataFrame, bits: int = 4) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``bits`` bits; ``fps`` has distinct ``fp``.

    Exact for ``bits`` <= 5 (a pair then shares three bytes at least).
    """
    if bits > 8 - TOGETHER:
        raise ValueError(f"at most {8 - TOGETHER} bits")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [
        (F.lit(i << 24) + byte[c[0]] * 65536 + byte[c[1]] * 256 + byte[c[2]]).cast("int")
        for i, c in enumerate(CHOICES)
    ]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "key").sortWithinPartitions("key")
    schema = "key int, block int, a long, b long"
    met = cut(map_rows(dealt, ["key", "fp"], schema, _postings(bits), batch_rows=1 << 20))
    found = met.where("block < 0").select("a", "b")
    aside = met.where("block >= 0").select("key", "block", F.col("a").alias("fp"))
    sizes = cut(aside.groupBy("key").agg(F.max("block").alias("last")))
    if sizes.isEmpty():
        return found
    tiles = (
        aside.join(sizes, "key")
        .select("key", "block", "fp", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp")
    )
    dealt = tiles.repartition(n, "key", "low", "high").sortWithinPartitions("key", "low", "high", "block")
    more = map_rows(dealt, ["key", "low", "high", "block", "fp"], schema, _tiles(bits), batch_rows=1 << 16)
    return found.unionByName(more.select("a", "b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 4, shingle: int = 4
) -> DataFrame:
    """id, fingerprint (hex) and component_id (least id reachable over links) of every row.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Rows with a
    repeated id keep one result each; a null id is never a component's id unless all its ids are
    null. Other columns are not read. An empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = cut(prints.groupBy("fp").agg(F.min(id_col).alias("first")))
    roots = connected(links(nodes.select("fp"), bits))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = cut(joined.groupBy("root").agg(F.min("first").alias("component_id")))
    named = cut(cut(joined.select("fp", "root")).join(least, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
