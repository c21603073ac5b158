"""Hierarchical multi-length packing of documents into training sequences.

A document's ids are cut into whole windows and one rest. The rest is routed to the shortest context
tier that holds it; every tier is packed on its own, gaps of long windows are filled from shorter
tiers (best fit first, at last by cutting a short rest), and full windows of all tiers are dealt into
step groups of equal token counts. All of it happens in the task that tokenised the documents, so no
text or id is shuffled; a task keeps at most POOL_TOKENS ids of rests between flushes.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import map_rows

#: Rests a task holds before it packs them, in ids.
POOL_TOKENS = 4_000_000
#: Tokens of a step group.
STEP_TOKENS = 65_536
SPACES = re.compile(r"\s+")
#: The word pattern of byte-level vocabularies (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class DocTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, as ``tokenizers`` gives them.

    A plain byte-level vocabulary (no normaliser, the usual word pattern, ids in the order of
    merges) is run by ``tiktoken``, which gives the same ids four times as fast; any other by
    ``tokenizers`` itself. Texts with a run of white space that the pattern of ``tiktoken`` can't
    go back over (its limit is near 998,000 characters; LONG_RUN stays far below) and texts that it
    fails on for any other reason are encoded by ``tokenizers`` too.
    """

    #: Longest run of white space that ``tiktoken`` is given.
    LONG_RUN = 50_000

    PROBE = "It's 12 o'clock,  caf\u00e9\t\u65e5\u672c \U0001f600\r\n x<|endoftext|> y \x85 don't"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            self.fast = self._fast(json.load(f))
        if self.fast and self.fast.encode(self.PROBE, allowed_special="all") != self.slow.encode(self.PROBE, add_special_tokens=False).ids:
            self.fast = None

    @staticmethod
    def _fast(spec: dict):
        import tiktoken

        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        odd = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if spec["normalizer"] or not plain or odd or model["type"] != "BPE" or model.get("ignore_merges"):
            return None
        # byte-level vocabularies write printable bytes as themselves and the others from U+0100 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [vocab[t] for t in pairs]
        if order != sorted(order) or len(vocab) != len(order) + 256:
            return None
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        import numpy as np

        def by_library(texts):
            return [np.array(e.ids, "<u4").tobytes() for e in self.slow.encode_batch_fast(texts, add_special_tokens=False)]

        if not self.fast:
            return by_library([t or "" for t in texts])
        out = []
        for t in texts:
            t = t or ""
            if len(t) > self.LONG_RUN and max(map(len, SPACES.findall(t)), default=0) > self.LONG_RUN:
                out += by_library([t])
                continue
            try:
                out.append(self.fast.encode_to_numpy(t, allowed_special="all").astype("<u4").tobytes())
            except ValueError:  # a limit of its pattern engine
                out += by_library([t])
        return out


class _Pool:
    """Rests by length: takes the longest that fits."""

    def __init__(self):
        self.lengths: list[int] = []
        self.rests: list[tuple] = []

    def add(self, rest: tuple) -> None:
        at = bisect.bisect_right(self.lengths, rest[2])
        self.lengths.insert(at, rest[2])
        self.rests.insert(at, rest)

    def extend(self, rests: list[tuple]) -> None:
        self.rests = sorted(self.rests + rests, key=lambda r: r[2])
        self.lengths = [r[2] for r in self.rests]

    def pop(self, at: int = -1) -> tuple:
        self.lengths.pop(at)
        return self.rests.pop(at)

    def fit(self, room: int) -> tuple | None:
        at = bisect.bisect_right(self.lengths, room)
        return self.pop(at - 1) if at else None

    def __len__(self):
        return len(self.lengths)


class Packer:
    """Packs rests (document, start, length, ids as bytes, document's ids) of one task."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.pools = {t: _Pool() for t in self.tiers}
        self.fresh: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self.held = 0

    def route(self, length: int) -> int:
        return min(t for t in self.tiers if t >= length)

    def add(self, rest: tuple) -> None:
        self.fresh[self.route(rest[2])].append(rest)
        self.held += rest[2]

    def _fill(self, window: list[tuple], room: int, shorter: list[int]) -> int:
        """Fill a window's gap: whole rests first, then the head of one that is too long."""
        for t in shorter:
            while room and (rest := self.pools[t].fit(room)):
                window.append(rest)
                room -= rest[2]
        if room:
            for t in reversed(shorter):
                if len(self.pools[t]):
                    doc, start, length, ids, total = self.pools[t].pop(0)
                    window.append((doc, start, room, ids[: 4 * room], total))
                    tail = (doc, start + room, length - room, ids[4 * room :], total)
                    self.pools[self.route(tail[2])].add(tail)
                    return 0
        return room

    def flush(self, last: bool = False) -> list[tuple[int, list[tuple]]]:
        """Full windows as (tier, pieces); with ``last`` all that is held goes out."""
        for t, rests in self.fresh.items():
            self.pools[t].extend(rests)
            rests.clear()
        out, unfilled = [], []
        for k, t in enumerate(self.tiers):
            while len(self.pools[t]):
                window = [self.pools[t].pop()]
                room = self._fill(window, t - window[0][2], list(self.tiers[k:]))
                if room:
                    unfilled += window
                else:
                    out.append((t, window))
        if last and unfilled:
            out += self._close(unfilled)
        elif unfilled:
            for rest in unfilled:
                self.pools[self.route(rest[2])].add(rest)
        self.held = sum(r[2] for p in self.pools.values() for r in p.rests)
        return out

    def _close(self, rests: list[tuple]) -> list[tuple[int, list[tuple]]]:
        """The last windows of a task: what is left, cut at powers of two, so nothing is padded."""
        left = sum(r[2] for r in rests)
        sizes = [self.tiers[0]] * (left // self.tiers[0])
        sizes += [1 << b for b in range(self.tiers[0].bit_length(), -1, -1) if left % self.tiers[0] >> b & 1]
        queue, out = list(reversed(rests)), []
        for size in sizes:
            window, room = [], size
            while room:
                doc, start, length, ids, total = queue.pop()
                take = min(room, length)
                window.append((doc, start, take, ids[: 4 * take], total))
                if take < length:
                    queue.append((doc, start + take, length - take, ids[4 * take :], total))
                room -= take
            out.append((size, window))
        return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = (1024, 512, 256, 128),
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    with_ids: bool = False,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    Tiers are powers of two. Every sequence is exactly full (a tier's length, or a smaller power of
    two for a task's last ones), so there is no padding. Null text counts as empty: its document is
    the end id alone. Rows with a null or repeated id are packed like others. Other columns are not
    read; an empty table gives an empty result. ``with_ids`` adds each piece's ids.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    window = max(tiers)
    end = end_id.to_bytes(4, "little")
    kept: dict[str, DocTokenizer] = {}

    def run(batches):
        import numpy as np

        tokenize = kept.get(tokenizer_path) or kept.setdefault(tokenizer_path, DocTokenizer(tokenizer_path))
        part = TaskContext.get().partitionId() << 40
        packer = Packer(tiers)
        made = {"sequence": 0, "step": 0, "tokens": 0}

        def rows(windows):
            out = {n: [] for n in names}
            # long windows first: lengths are powers of two, so steps come out exactly full
            for tier, pieces in sorted(windows, key=lambda w: -w[0]):
                size = sum(p[2] for p in pieces)
                if made["tokens"] + size > step_tokens:
                    made["step"] += 1
                    made["tokens"] = 0
                made["tokens"] += size
                at = 0
                for doc, start, length, ids, total in pieces:
                    row = (doc, start, length, zlib.crc32(ids), total, part + made["sequence"], at, size, tier, part + made["step"])
                    for n, v in zip(names, row, strict=False):
                        out[n].append(v)
                    if with_ids:
                        out["ids"].append(np.frombuffer(ids, "<u4").astype(np.int32).tolist())
                    at += length
                made["sequence"] += 1
            return out

        for b in batches:
            windows = []
            for doc, ids in zip(b[id_col], tokenize(b[text_col]), strict=True):
                ids += end
                total = len(ids) // 4
                whole = total // window
                for k in range(whole):
                    windows.append((window, [(doc, k * window, window, ids[4 * k * window : 4 * (k + 1) * window], total)]))
                if total % window:
                    packer.add((doc, whole * window, total % window, ids[4 * whole * window :], total))
            if packer.held > POOL_TOKENS:
                windows += packer.flush()
            yield rows(windows)
        yield rows(packer.flush(last=True))

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "tier", "step_group"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    if with_ids:
        schema += ", ids array<int>"
        names.append("ids")
    return map_rows(docs, [id_col, text_col], schema, run)
