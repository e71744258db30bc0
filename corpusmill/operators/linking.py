"""Pairs of question and answer files, found by their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def folders_of(files: DataFrame) -> DataFrame:
    """(folder) of every file and every folder above it, each once; the root, whose path is empty, is one of them."""
    own = files.select(X.parent(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return own.select(F.explode(F.array_append(above, F.lit(""))).alias("folder")).distinct()


def folder_pairs(files: DataFrame) -> DataFrame:
    """(a, b, role_a, role_b): two folders in one folder whose names are alike but for role words, and no third.

    Folders that hold only folders count as well. Nothing stands beside the root.
    """
    named = folders_of(files).where("folder <> ''").select("folder", X.parent(F.col("folder")).alias("above"), X.signature(X.base_name(F.col("folder"))).alias("sig"), X.role(X.base_name(F.col("folder"))).alias("role"))
    groups = named.groupBy("above", "sig").agg(F.count("*").alias("n"), F.min(F.struct("folder", "role")).alias("a"), F.max(F.struct("folder", "role")).alias("b"))
    two = groups.where("n = 2").select(F.col("a.folder").alias("a"), F.col("b.folder").alias("b"), F.col("a.role").alias("role_a"), F.col("b.role").alias("role_b"))
    return two.where("role_a <> role_b")


def _match(files: DataFrame, key: str, name: str) -> DataFrame:
    """`files` with the one file on each side of a folder pair whose key is the same, as `name`_0 and `name`_1, and how
    many there are; rows without a key stand alone. A row's key and pair tell the group, so a large folder is dealt over
    its keys."""
    group = Window.partitionBy("pair", key)
    side = lambda n: F.when((F.col("side") == n) & F.col(key).isNotNull(), F.col("path"))
    return files.withColumns({f"{name}_{n}": F.max(side(n)).over(group) for n in (0, 1)} | {f"n_{name}_{n}": F.count(side(n)).over(group) for n in (0, 1)})


def all_links(files: DataFrame) -> DataFrame:
    """(path, role, linked_to, match_type): links between question and answer files, both directions, out of (path), which
    is distinct.

    Files of paired folders are linked where they have the same name, else the same signature (spaces apart last) that is
    the only one on both sides. Files of one folder are linked where two, and no third, have names that are alike but for
    role words, and neither is linked by its folder. A file's role comes from its folder in the first case, from its own
    name in the second; a is an answer where marked so, a question otherwise, and b the other; where both have one role
    there is no link. Each file goes through four groupings; nothing is joined with itself.
    """
    pairs = folder_pairs(files)
    sides = pairs.select(F.explode(F.array(*[F.struct(F.col(c).alias("folder"), F.lit(n).alias("side")) for n, c in ((0, "a"), (1, "b"))])).alias("s"), F.col("a").alias("pair"), "role_a")
    sides = sides.select("s.*", "pair", F.when(F.col("role_a") == "answer", 0).otherwise(1).alias("answers"))
    stem = X.stem(F.col("path"))
    base = files.select("path", X.parent(F.col("path")).alias("folder"), X.base_name(F.col("path")).alias("name"), X.signature(stem).alias("sig"), X.role(stem).alias("own_role"))
    base = base.join(sides, "folder", "left").withColumn("paired", F.col("pair").isNotNull()).withColumn("pair", F.coalesce("pair", F.concat(F.lit("/"), F.col("folder"))))

    told = _match(base, "name", "exact")
    told = told.withColumn("exact", F.col("paired") & (F.col("n_exact_0") > 0) & (F.col("n_exact_1") > 0))
    # keys of files that are out are their own paths, so that they do not meet in one group
    told = told.withColumn("open", F.col("paired") & ~F.col("exact")).withColumn("key", F.when(F.col("open"), F.col("sig")).otherwise(F.concat(F.lit("/"), F.col("path"))))
    told = _match(told, "key", "strict")
    told = told.withColumn("strict", F.col("open") & (F.col("sig") != "") & (F.col("n_strict_0") == 1) & (F.col("n_strict_1") == 1))
    other = F.when(F.col("side") == 0, F.col("n_strict_1")).otherwise(F.col("n_strict_0"))
    told = told.withColumn("open", F.col("open") & (other == 0) & (F.col("sig") != ""))
    told = told.withColumn("key", F.when(F.col("open"), F.replace("sig", F.lit(" "), F.lit(""))).otherwise(F.concat(F.lit("/"), F.col("path"))))
    told = _match(told, "key", "loose")
    told = told.withColumn("loose", F.col("open") & (F.col("n_loose_0") == 1) & (F.col("n_loose_1") == 1))

    told = told.withColumn("linked", F.col("exact") | F.col("strict") | F.col("loose")).withColumn("key", F.when(F.col("sig") != "", F.col("sig")).otherwise(F.concat(F.lit("/"), F.col("path"))))
    group, me = Window.partitionBy("folder", "key"), F.struct("path", "own_role")
    told = told.withColumns({"n": F.count("*").over(group), "first": F.min(me).over(group), "last": F.max(me).over(group), "any_linked": F.max("linked").over(group)})
    beside = ~F.col("any_linked") & (F.col("n") == 2) & (F.col("first.own_role") != F.col("last.own_role"))
    is_first = F.col("path") == F.col("first.path")

    def partner(name: str):
        return F.when(F.col("side") == 0, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    linked_to = F.when(F.col("exact"), partner("exact")).when(F.col("strict"), partner("strict")).when(F.col("loose"), partner("loose")).when(beside, F.when(is_first, F.col("last.path")).otherwise(F.col("first.path")))
    answer = F.when(F.col("linked"), F.col("side") == F.col("answers")).otherwise(is_first == (F.col("first.own_role") == "answer"))
    kind = F.when(F.col("exact"), "folder_pair+exact_filename").when(F.col("strict"), "folder_pair+fuzzy_filename").when(F.col("loose"), "folder_pair+fuzzy_filename+loose").otherwise("same_folder_filename")
    return told.select("path", F.when(answer, "answer").otherwise("question").alias("role"), linked_to.alias("linked_to"), kind.alias("match_type")).where("linked_to IS NOT NULL")


def link_stats(links: DataFrame) -> DataFrame:
    """Pairs of each match type."""
    return links.groupBy("match_type").agg((F.count("*") / 2).cast("long").alias("pairs"), F.countDistinct("path").alias("files"))


def link_coverage(files: DataFrame, links: DataFrame) -> DataFrame:
    """One row: all files, those with a link, pairs, and the share of files that are linked in per cent."""
    linked = links.agg(F.countDistinct("path").alias("linked_files"), F.count("*").alias("n"))
    every = files.agg(F.count("*").alias("files"))
    share = F.when(F.col("files") > 0, F.round(100 * F.col("linked_files") / F.col("files"), 1)).otherwise(0.0)
    return every.crossJoin(linked).select("files", "linked_files", (F.col("n") / 2).cast("long").alias("pairs"), share.alias("linked_pct"))  # one row each


def asymmetric(links: DataFrame) -> DataFrame:
    """Links whose opposite is missing; there should be none."""
    back = links.select(F.col("linked_to").alias("path"), F.col("path").alias("linked_to"))
    return links.select("path", "linked_to").join(back, ["path", "linked_to"], "left_anti")
