"""Token counts of a piece vocabulary by rank-synchronous array merging.

The vocabulary's text rules: the text gets one space in front, spaces become the mark U+2581, a
character that is no piece counts one token for each UTF-8 byte, and no other normalisation is done.
No piece has a mark after another character, so a text falls into independent pre-tokens at each
mark that follows something else, and counts of pre-tokens add up. New pre-tokens of a batch are
merged together as one ragged array; their counts are remembered in a dictionary of bounded size.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from .bpe import PairTable, merge_all
from .common import map_rows

MARK = "▁"
#: Remembered pre-tokens of a worker; beyond it the memory is cleared, which costs time only.
MEMO_WORDS = 1_000_000
CHUNK = re.compile(r" *[^ ]+| +")


def _cut_run(n: int, sizes: set[int]) -> int:
    """Pieces of a run of n marks: the leftmost pair whose joined length is a piece is joined, again and again."""
    parts = [1] * n
    while (at := next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in sizes), None)) is not None:
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return len(parts)


class PieceCounter:
    """Counts tokens as the vocabulary's library does; see the module."""

    def __init__(self, model_path: str, memo_words: int = MEMO_WORDS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.piece = {}
        score = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.piece[sp.id_to_piece(i)] = i
                score[sp.id_to_piece(i)] = sp.get_score(i)
        levels = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        runs = [p for p in self.piece if len(p) > 1 and not p.strip(MARK)]
        #: Longest piece of marks alone. These pieces share the last rank, so a run is joined from the left.
        self.run = max((len(p) for p in runs), default=1)
        plain = set(levels[score[p]] for p in runs) <= {len(levels) - 1}
        mixed = [p for p in self.piece if re.search(f"[^{MARK}]{MARK}|^{MARK}{MARK}+[^{MARK}]", p)]
        if mixed or not plain:
            raise ValueError("this vocabulary has pieces that cross pre-tokens")
        self.run_counts = np.array([_cut_run(n, {len(p) for p in runs}) for n in range(self.run)])
        left, right, merged, rank = [], [], [], []
        for p, i in self.piece.items():
            if p.strip(MARK):
                for k in range(1, len(p)):
                    a, b = self.piece.get(p[:k]), self.piece.get(p[k:])
                    if a is not None and b is not None:
                        left.append(a), right.append(b), merged.append(i), rank.append(levels[score[p]])
        self.table = PairTable(left, right, merged, rank)
        self.mark = self.piece[MARK]
        self.by_char = np.full(0x110000, -1, np.int64)
        for p, i in self.piece.items():
            if len(p) == 1:
                self.by_char[ord(p)] = i
        self.by_char[ord(" ")] = self.mark
        self.memo: dict[str, int] = {}
        self.memo_words = memo_words

    def _learn(self, words: list[str]) -> None:
        """Count pre-tokens not seen yet. A word stands for itself, a space in front included."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.by_char[code]
        width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(lengths)
        more = np.add.reduceat(np.where(sym < 0, width - 1, 0), ends - lengths)
        left, n = merge_all(sym, lengths, self.table)
        at = np.cumsum(n) - n
        # runs of marks in front are joined by rule
        other = np.flatnonzero(left != self.mark)
        nearest = np.append(other, len(left))[np.searchsorted(other, at)]
        run = np.minimum(nearest - at, n)
        joined = run // self.run + self.run_counts[run % self.run]
        self.memo.update(zip(words, (n - run + joined + more).tolist(), strict=True))

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null and empty texts have none."""
        chunks = []
        for text in texts:
            if not text:
                chunks.append([])
                continue
            text = " " + text.replace(MARK, " ")
            parts = []
            for line in text.split("\n") if self.piece.get("\n") is None else [text]:
                parts += CHUNK.findall(line)
            chunks.append(parts)
        memo = self.memo
        new = set().union(*chunks).difference(memo) if chunks else set()
        if len(memo) + len(new) > self.memo_words:
            memo.clear()
            new = set().union(*chunks)
        if new:
            ordered = sorted(new, key=len)
            at = 0
            while at < len(ordered):  # about a million symbols at once
                n = max(1, min(50_000, 1_000_000 // max(1, len(ordered[min(at + 50_000, len(ordered) - 1)]))))
                self._learn(ordered[at : at + n])
                at += n
        newline = self.piece.get("\n") is None
        return [
            sum(map(memo.__getitem__, parts)) + (text.count("\n") if newline and text else 0)
            for parts, text in zip(chunks, texts, strict=True)
        ]


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null text counts as empty (0 bytes, 0 tokens, not over). Rows with a null or repeated id are
    kept, one result each. Other columns are not read. An empty table gives an empty result.
    """
    kept: dict[str, PieceCounter] = {}

    def run(batches):
        for b in batches:
            counter = kept.get(model_path) or kept.setdefault(model_path, PieceCounter(model_path))
            n = counter.counts(b[text_col])
            yield {
                id_col: b[id_col],
                "n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in b[text_col]],
                "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs, [id_col, text_col], f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean", run
    )
