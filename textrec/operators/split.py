"""Train/test split.

The default split is a per-row hash predicate: no shuffle, deterministic under
recomputation and executor loss, and the test part is the exact complement of
the train part (D7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.operators.positions import with_group_position

HASH_RANGE = 1 << 32


def hash_draw(*cols, seed: int = 42):
    """A whole number in [0, HASH_RANGE): the first 8 hex digits of md5(cols|seed)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def split_hash(df: DataFrame, frac: float = 0.1, cols=("id", "tweet_line"), seed: int = 42):
    """R2 (hash variant): returns (test, train); test has ~frac of each song."""
    cut = int(round(frac * HASH_RANGE))
    draw = hash_draw(*cols, seed=seed)
    return df.where(draw < cut), df.where(draw >= cut)


def label_split_hash(df: DataFrame, frac: float = 0.1, cols=("id", "tweet_line"), seed: int = 42) -> DataFrame:
    cut = int(round(frac * HASH_RANGE))
    return df.withColumn("part", F.when(hash_draw(*cols, seed=seed) < cut, "test").otherwise("train"))


def split_exact(df: DataFrame, frac: float = 0.1, label: str = "id", line_col: str = "tweet_line",
                seed: int = 42):
    """R2 (exact variant): per label, the ceil(frac * n) rows with the smallest
    hash are test, the rest train; with frac <= 0.5 both parts are non-empty
    whenever n >= 2.  Positions are computed skew-safely (a hot label is spread
    over several range partitions), never by gathering a label in one task."""
    keyed = df.withColumn("_h", F.substring(F.md5(F.concat_ws("|", F.col(label).cast("string"),
                                                               F.col(line_col), F.lit(str(seed)))), 1, 16))
    pos = with_group_position(keyed, [label], ["_h", line_col], name="_pos", count_name="_n")
    # round first: 0.1 * 30 is 3.0000000000000004 in binary floating point
    test_mask = F.col("_pos") < F.ceil(F.round(F.lit(frac) * F.col("_n"), 9))
    labelled = pos.withColumn("part", F.when(test_mask, "test").otherwise("train")).drop("_h", "_pos", "_n")
    return labelled


def split_sample_by(df: DataFrame, frac: float = 0.1, seed: int = 42, key_cols=("id", "tweet_line"),
                    label: str = "id") -> DataFrame:
    """Bernoulli sample per label with one fraction for every label.

    Each row draws from the hash of its label, its key and the seed, so the
    draw doesn't depend on partitions, order or recomputation, and SQL can
    repeat it."""
    keys = [label, *(c for c in key_cols if c != label)]
    draw = hash_draw(*keys, seed=f"sample{seed}")
    return df.withColumn("part", F.when(draw < int(round(frac * HASH_RANGE)), "test").otherwise("train"))
