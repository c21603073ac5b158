"""Development and test split of files, without a file in both."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_id
from .ordering import running_total
from .sampling import order_key


def file_stats(gold: DataFrame, types: list[str]) -> DataFrame:
    """(file, type, n) of allowed types and, with type null, the number of records; ids without a file are left out."""
    rows = gold.select(file_id(F.col("id")).alias("file"), "entities").where("file is not null")
    each = rows.select("file", F.explode("entities.type").alias("type")).where(F.col("type").isin(*types))
    return each.groupBy("file", "type").agg(F.count("*").alias("n")).unionByName(
        rows.groupBy("file").agg(F.count("*").alias("n")).select("file", F.lit(None).cast("string").alias("type"), "n")
    )


def random_split(files: DataFrame, dev_ratio: float, seed: int = 0) -> DataFrame:
    """(file, n, split): in md5 order files go to dev while the files before hold less than the ratio of records.

    The running total is a prefix sum over ranges of the order, so no task holds all files.
    """
    summed = running_total(files.select("file", "n"), "n", [order_key("file", seed=seed), F.col("file")], "_before", "_total")
    return summed.select("file", "n", F.when(F.col("_before") < F.col("_total") * dev_ratio, "dev").otherwise("test").alias("split"))


def rarity(stats: DataFrame, rare: list[str]) -> DataFrame:
    """(file, rarity): counts weighted by 1 / (global count + 1), five times for rare types."""
    typed = stats.where("type is not null")
    weight = typed.groupBy("type").agg((1.0 / (F.sum("n") + 1)).alias("w")).withColumn("w", F.when(F.col("type").isin(*rare), F.col("w") * 5).otherwise(F.col("w")))
    scored = typed.join(F.broadcast(weight), "type").groupBy("file").agg(F.sum(F.col("n") * F.col("w")).alias("rarity"))
    return stats.select("file").distinct().join(scored, "file", "left").select("file", F.coalesce("rarity", F.lit(0.0)).alias("rarity"))


@dataclass
class _State:
    ratio: float
    rare: list[str]
    least: int
    dev: dict[str, int] = field(default_factory=dict)
    test: dict[str, int] = field(default_factory=dict)
    dev_n: int = 0
    test_n: int = 0

    def cost(self, stats: dict[str, int], n: int, to_dev: bool) -> float:
        dev_n, test_n = self.dev_n + n * to_dev, self.test_n + n * (not to_dev)
        if dev_n + test_n == 0:
            return 0.0
        out = 100 * abs(dev_n / (dev_n + test_n) - self.ratio)
        for t in self.rare:
            d = self.dev.get(t, 0) + stats.get(t, 0) * to_dev
            e = self.test.get(t, 0) + stats.get(t, 0) * (not to_dev)
            out += 50 * (e < self.least)
            if d + e:
                out += 10 * abs(d / (d + e) - self.ratio)
        return out

    def add(self, stats: dict[str, int], n: int, to_dev: bool, sign: int = 1) -> None:
        counts = self.dev if to_dev else self.test
        for t, c in stats.items():
            counts[t] = counts.get(t, 0) + sign * c
        if to_dev:
            self.dev_n += sign * n
        else:
            self.test_n += sign * n


def balanced_split(files: list[tuple[str, int, dict[str, int], float]], ratio: float, rare: list[str], least: int = 1):
    """(dev, test, warnings) of (file, records, counts by type, rarity).

    Each file, rarest first, goes where the cost is lower; then a rare type that test lacks is
    mended with the smallest dev file that has it. A sequential rule, so it runs on the driver over
    one row for each file; records themselves stay distributed.
    """
    state, place = _State(ratio, rare, least), {}
    by_name = {f[0]: f for f in files}
    for name, n, stats, _ in sorted(files, key=lambda f: (f[3], f[0]), reverse=True):
        to_dev = state.cost(stats, n, True) <= state.cost(stats, n, False)
        state.add(stats, n, to_dev)
        place[name] = to_dev
    warnings = []
    for t in rare:
        if state.test.get(t, 0) >= least:
            continue
        having = [name for name, dev in place.items() if dev and by_name[name][2].get(t, 0) > 0]
        if not having:
            warnings.append(f"Cannot satisfy min_positives for {t}")
            continue
        best = min(having, key=lambda name: by_name[name][1])
        _, n, stats, _ = by_name[best]
        state.add(stats, n, True, -1)
        state.add(stats, n, False)
        del place[best]
        place[best] = False
        if state.test.get(t, 0) < least:
            warnings.append(f"Repair of {t} with {best} is not enough")
    return [f for f, d in place.items() if d], [f for f, d in place.items() if not d], warnings


def coverage(stats: DataFrame, splits: DataFrame) -> DataFrame:
    """(split, type, n): type counts, records ("_records") and files ("_files") of each split."""
    rows = stats.join(splits.select("file", "split"), "file")
    counts = rows.groupBy("split", F.coalesce("type", F.lit("_records")).alias("type")).agg(F.sum("n").alias("n"))
    return counts.unionByName(splits.groupBy("split").agg(F.count("*").alias("n")).select("split", F.lit("_files").alias("type"), "n"))
