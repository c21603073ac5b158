"""Near copies of a given similarity by wide SimHash fingerprints and the byte-position index.

At a similarity of 0.8 two 64-bit fingerprints differ in about ten bits, so no number of shared bytes
is guaranteed. Here a fingerprint has WORDS times 64 bits. The index posts a document under KEYS fixed
choices of three (position, byte) entries out of its 8 * WORDS bytes; of synthetic pairs of similarity
0.8 about 94 in 100 share one at least of KEYS (0.834: 98), and others are lost. What meets in a
posting and may be alike by the first 64 bits is a cluster. In it the positions that two fingerprints share are
counted: of the two halves of each byte, 16 * WORDS positions in all, a pair within ``most`` bits shares 16 * WORDS - most at
least (of whole bytes none need be shared, as such a pair may differ in each). Pairs below that guaranteed minimum
are dropped, and only the others are looked at bit by bit. What they connect is a family.
The first FIRST choices find families already; the other choices then look only for what is not yet in one
family, so a large family does not come out of each of its postings again.
All pairs of a family that pass the count and are near by bits are compared in place, and a pair is a link only if the sets
of shingle hashes of both whole texts have the similarity. A set of more than SKETCH hashes is there by its
least SKETCH ones, which tell the similarity of pairs that are clearly above or below it; pairs that they leave
open are compared by both whole sets, pair by pair. So what a task holds is bounded, however long texts are.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows, release
from .components import connected

WORDS = 8
KEYS = 256
#: Choices that are posted first; clusters of the others that lie in one family of these add nothing.
FIRST = 16
#: Differing bits of the first 64 that a pair may have to be looked at: three deviations above the mean at 0.8.
SKETCH_BITS = 18
#: A pair is verified on its shingles if it differs in no more bits than this many deviations above the mean.
DEVIATIONS = 4
#: Positions that are counted, half a byte each, and a word's lowest bit of each.
POSITIONS, LOWEST = 16 * WORDS, np.uint64(0x1111111111111111)
#: The distance of a pair that the count drops: more than any has.
FAR = 64 * WORDS + 1
BLOCK = 4096
#: Nodes of a block of a family, and the hashes that each brings there at most: two blocks hold 128 MB.
FAMILY_BLOCK, SKETCH = 4096, 2048
#: A sketch decides if its estimate lies this many standard deviations beside the similarity: an error in 50 million.
SURE = 5.6
#: Pairs left open that are broadcast, 50 bytes each.
FEW_PAIRS = 50_000


def shingle_hashes(text: str | None, shingle: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles, sorted; ASCII-lower-cased, none for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    lasts = ends[min(shingle, len(words)) - 1 :].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    pairs = zip(starts[:n].tolist(), lasts, strict=True)
    return np.unique(np.fromiter((digest(view[s:e], 42) for s, e in pairs), np.uint64, n))


def fingerprint_of(hashes: np.ndarray) -> bytes:
    """512 bits over distinct shingle hashes; zeros for none."""
    n = len(hashes)
    votes = np.zeros(64 * WORDS, np.int64)
    for at in range(0, n, 16384):
        h = hashes[at : at + 16384]
        for w in range(WORDS):
            x = h + np.uint64((w * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = (x ^ (x >> np.uint64(31))).astype(">u8")
            votes[64 * w : 64 * w + 64] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > n).tobytes()


def wide_fingerprint(text: str | None, shingle: int = 5) -> bytes:
    """512 bits over the set of word shingles (repeats count once); zeros for a text without words."""
    return fingerprint_of(shingle_hashes(text, shingle))


def node_of(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingle hashes."""
    import xxhash

    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes()), np.uint64).view(np.int64))


def allowed_bits(similarity: float, deviations: float = 2) -> int:
    """Differing bits that pairs of this similarity have at most, but for one in forty (at two deviations)."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    n = 64 * WORDS
    return int(n * p + deviations * math.sqrt(n * p * (1 - p)))


def _choices() -> np.ndarray:
    rng = np.random.default_rng(11)
    return np.stack([np.sort(rng.choice(8 * WORDS, 3, replace=False)) for _ in range(KEYS)])


def _clusters(ids: list, sketch: list, kin: list):
    """(key, ids) of the groups of two or more families that the sketch test joins in one posting; the key is of the ids."""
    import xxhash

    if len(ids) == 2 and (sketch[0] ^ sketch[1]).bit_count() > SKETCH_BITS:
        return
    if kin[0] == kin[-1] and len(set(kin)) == 1:
        return
    names = np.array(ids, np.int64)
    rest, bits, family = np.arange(len(ids)), np.array(sketch, np.uint64), np.array(kin, np.int64)
    while len(rest) > 1:
        front, found = [bits[0]], [rest[:1]]
        rest, bits = rest[1:], bits[1:]
        while front and len(rest):
            hit = np.bitwise_count(bits ^ front.pop()) <= SKETCH_BITS
            if hit.any():
                found.append(rest[hit])
                front += list(bits[hit])
                rest, bits = rest[~hit], bits[~hit]
        group = np.concatenate(found)
        if (family[group] != family[group[0]]).any():
            group = np.sort(names[group])
            yield int(np.array(xxhash.xxh64_intdigest(group.tobytes()), np.uint64).view(np.int64)), group.tolist()


def _postings(batches):
    """Sorted (key, id, sketch, kin) to clusters (block -1, key of the cluster) of entries that may be links.

    Entries of equal ``kin`` are in one family already. A posting of more than BLOCK entries comes out
    whole, under its own key and in blocks, to be compared block against block.
    """
    key, ids, sketch, kin, blocks = None, [], [], [], 0
    names = ["cluster", "block", "id", "kin"]
    out: dict[str, list] = {c: [] for c in names}

    def put(cluster: int, block: int, members: list, kin: list):
        out["cluster"] += [cluster] * len(members)
        out["block"] += [block] * len(members)
        out["id"] += members
        out["kin"] += kin

    def close():
        if blocks:
            put(key, blocks, ids, kin)
        elif len(ids) > 1:
            for cluster, members in _clusters(ids, sketch, kin):
                put(cluster, -1, members, [0] * len(members))

    for batch in batches:
        keys = batch["key"]
        same = keys[1:] == keys[:-1]
        # postings of one entry are passed over, but for the batch's ends, which may go on
        some = np.concatenate(([True], same)) | np.concatenate((same, [True]))
        columns = (keys, batch["id"], batch["sketch"].view(np.uint64), batch["kin"])
        for k, i, s, f in zip(*(x[some].tolist() for x in columns), strict=True):
            if k != key:
                close()
                key, ids, sketch, kin, blocks = k, [], [], [], 0
            elif len(ids) == BLOCK:
                put(key, blocks, ids, kin)
                ids, sketch, kin, blocks = [], [], [], blocks + 1
            ids.append(i)
            sketch.append(s)
            kin.append(f)
        if out["id"]:
            yield out
            out = {c: [] for c in names}
    close()
    if out["id"]:
        yield out


def shared_positions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of their POSITIONS half bytes fingerprints share."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return POSITIONS - np.bitwise_count(x & LOWEST).sum(axis=1, dtype=np.int64)


def retained(fp: np.ndarray, p: np.ndarray, most: int) -> np.ndarray:
    """Numbers of the fingerprints that share as many positions with ``p`` as a pair within ``most`` bits must."""
    return np.flatnonzero(shared_positions(fp, p) >= POSITIONS - most)


def _distances(fp: np.ndarray, p: np.ndarray, most: int) -> np.ndarray:
    """Differing bits from ``p``, counted for retained fingerprints alone; FAR for others."""
    out = np.full(len(fp), FAR, np.int64)
    kept = retained(fp, p, most)
    out[kept] = np.bitwise_count(fp[kept] ^ p).sum(axis=1, dtype=np.int64)
    return out


def _spanning(ids: np.ndarray, fp: np.ndarray, most: int) -> tuple[list, list]:
    """The minimum spanning forest of a cluster by differing bits, of links with at most ``most``.

    It connects what the links within any number of bits connect, so no far pair hides a near one.
    """
    left, right = [], []
    ids, fp = ids.copy(), fp.copy()
    n = len(ids) - 1  # those not reached yet are the first n
    at, near = ids[n], _distances(fp[:n], fp[n], most)
    via = np.full(n, at)
    while n:
        j = int(near[:n].argmin())
        if near[j] <= most:
            left.append(int(via[j]))
            right.append(int(ids[j]))
        at, point, n = ids[j], fp[j].copy(), n - 1
        for x in (ids, fp, near, via):
            x[j] = x[n]
        d = _distances(fp[:n], point, most)
        less = d < near[:n]
        near[:n][less], via[:n][less] = d[less], at
    return left, right


def _candidates(members: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of clusters (cluster, id): a spanning forest of each by the bits of ``nodes`` (id, fp); a pair of two clusters comes out of both."""
    columns = ["cluster", "id", "fp"]

    def run(batches):
        held = None  # a cluster can go on in the next batch

        def forest(ids, fp):
            if len(ids) < 2:
                return [], []
            order = np.argsort(ids)
            return _spanning(ids[order], fp[order], most)

        def closed():
            nonlocal held
            for b in batches:
                cluster, ids = (b[c] for c in ("cluster", "id"))
                fp = np.frombuffer(b"".join(b["fp"]), np.uint64).reshape(-1, WORDS)
                if held is not None:
                    cluster, ids, fp = (np.concatenate(x) for x in zip(held, (cluster, ids, fp), strict=True))
                bounds = np.concatenate(([0], np.flatnonzero(np.diff(cluster)) + 1, [len(ids)]))
                for s, e in zip(bounds[:-2], bounds[1:-1], strict=True):
                    yield forest(ids[s:e], fp[s:e])
                held = tuple(x[bounds[-2] :] for x in (cluster, ids, fp))
            if held is not None:
                yield forest(*held[1:])

        for left, right in closed():
            if left:
                yield {"a": np.minimum(left, right), "b": np.maximum(left, right)}

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.join(nodes.select("id", "fp"), "id").select(columns).repartition(n, "cluster").sortWithinPartitions("cluster")
    return map_rows(rows, columns, "a long, b long", run, batch_rows=1 << 14, arrays=("cluster", "id"))


def similar(p: np.ndarray, q: np.ndarray, sizes: tuple[int, int], similarity: float) -> bool | None:
    """Whether two sets have this Jaccard similarity, by their sizes and sorted hashes, or the least SKETCH of them; None if these leave it open."""
    least, largest = sorted(sizes)
    if least < similarity * largest:
        return False
    if (len(p), len(q)) == sizes:
        both = len(np.intersect1d(p, q, assume_unique=True))
        return both >= similarity * (len(p) + len(q) - both)
    union, n = np.unique(np.concatenate((p, q)), return_counts=True)
    share = float((n[:SKETCH] == 2).mean())  # of the union's least hashes, those in both
    margin = SURE * math.sqrt(similarity * (1 - similarity) / SKETCH)
    return None if abs(share - similarity) < margin else share > similarity


def _links_of(ids: list, fp: np.ndarray, side: np.ndarray, sets: list, sizes: list, most: int, similarity: float) -> tuple[list, list]:
    """Links that connect all pairs with this similarity, of those within ``most`` bits, and pairs that sketches leave open.

    ``side``: 0 for all if pairs are within a block, else 0 or 1 and pairs are between the two. Pairs are
    taken nearest first, and one that is connected already is not compared.
    """
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    near: tuple[list, list, list] = ([], [], [])
    links, doubtful = [], []

    def settle():
        if not near[0]:
            return
        i, j, d = (np.concatenate(x) for x in near)
        for x in near:
            x.clear()
        for k in np.argsort(d, kind="stable").tolist():
            x, y = int(i[k]), int(j[k])
            u, v = find(x), find(y)
            if u == v:
                continue
            alike = similar(sets[x], sets[y], (sizes[x], sizes[y]), similarity)
            if alike:
                root[max(u, v)] = min(u, v)
                links.append((ids[x], ids[y]))
            elif alike is None:
                doubtful.append((x, y))

    between = side.any()
    held = 0
    for k in range(len(ids) - 1):
        rest = np.arange(k + 1, len(ids))
        if between:
            rest = rest[side[rest] != side[k]]
        d = _distances(fp[rest], fp[k], most)
        hit = np.flatnonzero(d <= most)
        if len(hit):
            near[0].append(np.full(len(hit), k))
            near[1].append(rest[hit])
            near[2].append(d[hit])
            held += len(hit)
            if held > 1 << 20:  # bounded memory; what is connected by then is not compared again
                settle()
                held = 0
    settle()
    return links, [(ids[x], ids[y]) for x, y in doubtful if find(x) != find(y)]


def _verified(families: DataFrame, nodes: DataFrame, docs: DataFrame, most: int, similarity: float, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Links (a, b) of families (id, family) whose sets of shingle hashes over the whole texts have this Jaccard similarity.

    Each node of a family is read again and dealt, with its sketch, to the task of its family, where pairs
    are compared in place. A family of more than FAMILY_BLOCK nodes is compared block against block.
    """
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / FAMILY_BLOCK).cast("int").alias("blocks"))
    dealt = families.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    texts = docs.select(id_col, text_col, F.xxhash64(text_col).alias("h"))

    def with_text(wanted: DataFrame, few: bool = False) -> DataFrame:
        """Rows of ``wanted`` (id, ...) with the text of the row that stands for the node; rows equal in id and text are one."""
        named = nodes.select("id", F.col("rep.doc").alias("_doc"), F.col("rep.h").alias("_h")).join(F.broadcast(wanted) if few else wanted, "id")
        return texts.join(F.broadcast(named) if few else named, F.col(id_col).eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h")))

    rows = with_text(dealt.join(nodes.select("id", "fp"), "id")).dropDuplicates(["id"])
    columns = [text_col, "id", "fp", "family", "block", "blocks"]

    def hashed(batches):
        for b in batches:
            sets = [shingle_hashes(t, shingle) for t in b[text_col]]
            yield {c: b[c] for c in columns[1:]} | {"size": [len(x) for x in sets], "hashes": [x[:SKETCH].tobytes() for x in sets]}

    sets = cut(map_rows(rows, columns, "id long, fp binary, family long, block int, blocks int, size long, hashes binary", hashed, batch_rows=64))
    tiles = sets.select("id", "fp", "size", "hashes", "family", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = tiles.select("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "fp", "size", "hashes")
    tiles = tiles.repartition(n, "family", "low", "high").sortWithinPartitions("family", "low", "high", "id")
    names = ["family", "low", "high", "block", "id", "fp", "size", "hashes"]

    def compare(batches):
        tile, held = None, []

        def close():
            ids = [x[1] for x in held]
            fp = np.frombuffer(b"".join(x[2] for x in held), np.uint64).reshape(-1, WORDS)
            side = np.array([x[0] != tile[1] for x in held], np.int8)
            found = _links_of(ids, fp, side, [np.frombuffer(x[4], np.uint64) for x in held], [x[3] for x in held], most, similarity)
            pairs = np.array(found[0] + found[1], np.int64).reshape(-1, 2)
            return {"a": pairs.min(axis=1), "b": pairs.max(axis=1), "sure": [True] * len(found[0]) + [False] * len(found[1])}

        for b in batches:
            for family, low, high, *row in zip(*(b[c] for c in names), strict=True):
                if (family, low, high) != tile:
                    if len(held) > 1:
                        yield close()
                    tile, held = (family, low, high), []
                held.append(row)
        if len(held) > 1:
            yield close()

    links = cut(map_rows(tiles, names, "a long, b long, sure boolean", compare))
    doubtful = cut(links.where("not sure").select("a", "b").distinct())
    sure = links.where("sure").select("a", "b")
    count = doubtful.count()
    if not count:
        return sure

    def whole(batches):
        """Sorted (a, b, id, text), two rows a pair, one set held at a time."""
        first = None
        for b in batches:
            left, right = [], []
            for x, y, text in zip(b["a"], b["b"], b[text_col], strict=True):
                mine = shingle_hashes(text, shingle)
                if first is not None and first[0] == (x, y):
                    if similar(first[1], mine, (len(first[1]), len(mine)), similarity):
                        left.append(x)
                        right.append(y)
                    first = None
                else:
                    first = (x, y), mine
            if left:
                yield {"a": left, "b": right}

    ends = doubtful.select("a", "b", F.explode(F.array("a", "b")).alias("id"))
    # few pairs are sent to the texts; the texts are dealt only where there are many
    both = with_text(ends, count <= FEW_PAIRS).dropDuplicates(["a", "b", "id"]).select("a", "b", "id", text_col)
    both = both.repartition(n, "a", "b").sortWithinPartitions("a", "b", "id")
    return sure.unionByName(cut(map_rows(both, ["a", "b", text_col], "a long, b long", whole, batch_rows=16)))


def _members(nodes: DataFrame, first: int, last: int) -> DataFrame:
    """(cluster, id) of what may be links of two families of ``nodes`` (id, fp, kin) by the choices ``first`` to ``last``."""
    choices = _choices()[first:last]

    def post(batches):
        for b in batches:
            fp = np.frombuffer(b"".join(b["fp"]), np.uint8).reshape(-1, 8 * WORDS).astype(np.int64)
            part = fp[:, choices]  # documents, choices, 3
            key = (np.arange(first, last)[None] << 24) | (part[..., 0] << 16) | (part[..., 1] << 8) | part[..., 2]
            sketch = np.frombuffer(b"".join(x[:8] for x in b["fp"]), np.int64)
            each = {"id": b["id"], "sketch": sketch, "kin": b["kin"]}
            yield {"key": key.ravel()} | {c: np.repeat(x, last - first) for c, x in each.items()}

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = map_rows(nodes, ["id", "fp", "kin"], "key long, id long, sketch long, kin long", post, arrays=("id", "kin"))
    dealt = posted.repartition(n, "key").sortWithinPartitions("key")
    met = cut(map_rows(dealt, ["key", "id", "sketch", "kin"], "cluster long, block int, id long, kin long", _postings, batch_rows=1 << 16, arrays=("key", "id", "sketch", "kin")))
    release(nodes.sparkSession)
    members = met.where("block < 0").select("cluster", "id").distinct()
    aside = met.where("block >= 0")
    # long postings of one family add nothing
    sizes = cut(aside.groupBy("cluster").agg(F.max("block").alias("last"), F.min("kin").alias("low"), F.max("kin").alias("high")).where("low < high"))
    if not sizes.isEmpty():
        tiles = aside.join(sizes, "cluster").select("cluster", "block", "id", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        tile = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))
        members = members.unionByName(tiles.select(tile.alias("cluster"), "id"))
    return cut(members)


def _grouped(docs: DataFrame, similarity: float, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id_col, h, id) with the node ``id`` of each, and (id, root, first) with the group's first row."""

    def prints(batches):
        for b in batches:
            sets = [shingle_hashes(t, shingle) for t in b[text_col]]
            yield {id_col: b[id_col], "h": b["h"], "id": [node_of(x) for x in sets], "fp": [fingerprint_of(x) for x in sets]}

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(id_col, text_col, F.xxhash64(text_col).alias("h"))
    rows = cut(map_rows(given, [id_col, text_col, "h"], f"{id_col} {kind}, h long, id long, fp binary", prints))
    # the row that stands for a node: ordered by id, null last, then by text
    rep = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("doc"), "fp", "h")
    nodes = cut(rows.select("id", rep.alias("rep")).groupBy("id").agg(F.min("rep").alias("rep")).select("id", "rep", F.col("rep.fp").alias("fp")))
    most = allowed_bits(similarity, DEVIATIONS)
    # what is near by bits, directly or through others, is a family; its pairs are compared in full
    alone = nodes.select("id", "fp", F.col("id").alias("kin"))
    early = connected(_candidates(_members(alone, 0, FIRST), alone, most))
    known = cut(nodes.select("id", "fp").join(early, nodes["id"] == early["node"], "left").select("id", "fp", F.coalesce("root", "id").alias("kin")))
    late = _candidates(_members(known, FIRST, KEYS), known, most)
    links = late.unionByName(early.select(F.col("root").alias("a"), F.col("node").alias("b")))
    families = connected(links).select(F.col("node").alias("id"), F.col("root").alias("family"))
    release(docs.sparkSession)
    roots = connected(_verified(families, nodes, docs, most, similarity, id_col, text_col, shingle))
    joined = cut(nodes.join(roots, nodes["id"] == roots["node"], "left").select("id", "rep", F.coalesce("root", "id").alias("root")))
    least = cut(joined.groupBy("root").agg(F.min("rep").alias("first")))
    return rows, cut(joined.select("id", "root").join(least, "root").select("id", "root", "first"))


def groups(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(id, component_id) of every row: the least id of its group of near copies.

    Texts with equal sets of shingles are one node, named by a 64-bit hash of it. Texts without words
    are one group. Null ids come after others; repeated ids share what their texts are given. Other
    columns are not read; an empty table gives an empty result.
    """
    rows, named = _grouped(docs, similarity, id_col, text_col, shingle)
    return rows.select(id_col, "id").join(named, "id").select(id_col, F.col("first.doc").alias("component_id"))


def firsts(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(id, h) of one row of each group: the least by id (null last), fingerprint and h, the xxhash64 of its text."""
    _, named = _grouped(docs, similarity, id_col, text_col, shingle)
    each = named.groupBy("root").agg(F.min("first").alias("first"))
    return each.select(F.col("first.doc").alias(id_col), F.col("first.h").alias("h"))
