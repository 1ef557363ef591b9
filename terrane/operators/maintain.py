"""Keeping tables up to date: upserts, self-contained subsets, delimited memberships, tree digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], replace: bool = True) -> DataFrame:
    """Rows of both; of a key that both have, the new rows replace the old ones, or are left out if not `replace`. A key
    with a null equals no other, so its rows stay."""
    first, second = (new, old) if replace else (old, new)
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def referenced(facts: DataFrame, dimensions: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """kind and key of the rows of dimensions (kind, table, its key, the facts' key) that the facts use: what an export of
    the facts has to take along."""
    out = None
    for kind, table, key, of_fact in dimensions:
        used = table.join(facts.select(F.col(of_fact).alias("_used")), F.col(key) == F.col("_used"), "left_semi").select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("key"))
        out = used if out is None else out.unionByName(used)
    return out


def union_members(a: Column, b: Column, sep: str = "|") -> Column:
    """The members of two delimited lists, sorted and told once; null and empty lists have none."""
    one = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), f"\\Q{sep}\\E"), lambda m: m != "")
    return F.array_join(F.array_sort(F.array_union(one(a), one(b))), sep)


def keep_members(c: Column, keep: list[str], sep: str = "|") -> Column:
    """The list without the members that aren't to be kept, in its own order; null stays null."""
    return F.array_join(F.filter(F.split(c, f"\\Q{sep}\\E"), lambda m: m.isin(*keep)), sep)


def tree_digest(df: DataFrame, group: list[str], path: str, digest: str, out: str) -> DataFrame:
    """A digest of the (path, digest) pairs of each group, whatever their order: pairs are spread over 256 buckets by the
    MD5 of the path, sorted and hashed there, and the buckets' digests are hashed. No task holds more than a bucket."""
    pair = F.concat_ws("=", F.coalesce(F.col(path), F.lit("")), F.coalesce(F.col(digest), F.lit("")))
    bucket = F.substring(F.md5(F.coalesce(F.col(path), F.lit(""))), 1, 2)
    leaves = df.groupBy(*group, bucket.alias("_b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(pair)), "\n"), 256).alias("_d"))
    return leaves.groupBy(*group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("_b", "_d"))), ""), 256).alias(out))
