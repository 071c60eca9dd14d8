"""Exact and fuzzy de-duplication inside a batch and against production.

Spark tables have no row order, so "first wins" is always told by ``order_col``:
a unique integer column (position in the source).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import dedup_key, normalize_name, same_district, sort_tokens, squash_name
from ..session import cut_lineage
from .components import connected_components
from .grouping import first_per_group, first_row_of_key, null_safe_join, shuffled, sorted_positions
from .similarity import similar_pairs

DEFAULT_THRESHOLD = 85
FIRST_BATCH = 2_000
BATCH_GROWTH = 4
#: A group with up to this many rows to settle, and links between them (32 MB), is settled by one fold.
FOLD_ROWS, FOLD_LINKS = 20_000, 4_000_000


# ---------------------------------------------------------------- exact


def dedup_exact(df: DataFrame, order_col: str = "ord", by: list[str] | None = None) -> DataFrame:
    """One row per normalised name and district (within ``by``): the first."""
    by = by or []
    keyed = df.withColumn("__dk", dedup_key())
    return first_row_of_key(keyed, [*by, "__dk"], order_col).drop("__dk")


def dedup_by_name(df: DataFrame, order_col: str = "ord") -> DataFrame:
    """First row per lower-cased, space-collapsed name (accents count)."""
    return first_row_of_key(df.withColumn("__nk", squash_name("nombre")), ["__nk"], order_col).drop("__nk")


def dedup_by_url(df: DataFrame, order_col: str = "ord", url_col: str = "sitio_web") -> DataFrame:
    """First row per address; all rows without one share a slot."""
    keyed = df.withColumn("__u", F.coalesce(F.col(url_col), F.lit("")))
    return first_row_of_key(keyed, ["__u"], order_col).drop("__u")


def dedup_by_place_id(df: DataFrame, order_col: str = "ord") -> DataFrame:
    """First row per place id; rows without one are dropped."""
    keyed = df.withColumn("__p", F.col("raw_data")["place_id"]).filter(F.coalesce("__p", F.lit("")) != "")
    return first_per_group(keyed, ["__p"], [order_col]).drop("__p")


def count_duplicates(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows minus distinct keys (per ``by`` group)."""
    by = by or []
    per_key = df.groupBy(*by, dedup_key().alias("__dk")).agg(F.count(F.lit(1)).alias("__n"))
    out = per_key.groupBy(*by).agg((F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"))
    return out


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows of every key that occurs more than once, with ``group_key`` and ``group_size``.

    Members stay rows: a group of copies may be a third of the table.
    """
    keyed = df.withColumn("group_key", dedup_key())
    sizes = keyed.groupBy("group_key").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return keyed.join(sizes, "group_key")


def exact_new(new: DataFrame, production: DataFrame) -> DataFrame:
    """Rows whose normalised name and district are not in production."""
    keys = production.select(dedup_key().alias("__dk")).distinct()
    return new.withColumn("__dk", dedup_key()).join(shuffled(keys), "__dk", "left_anti").drop("__dk")


# ---------------------------------------------------------------- similarity


def with_name_keys(df: DataFrame) -> DataFrame:
    """Add ``__s`` (sorted-token name) and ``__d`` (normalised district)."""
    return df.withColumn("__s", sort_tokens(normalize_name("nombre"))).withColumn("__d", normalize_name("partido"))


def name_pairs(df: DataFrame, order_col: str = "ord", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """All pairs of rows with ratio >= threshold, as one row per pair of *names*.

    ``first_a < first_b`` are the orders of the first row of each name, ``pairs`` the
    number of row pairs the line stands for and ``pairs_same_district`` those of
    match type ``nombre+partido``. A name with copies pairs with itself. So a
    name held by a third of the table is one line, not its square.
    """
    rows = with_name_keys(df.select("nombre", "partido", order_col))
    groups = rows.groupBy("__s", "__d").agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first"))
    groups = cut_lineage(groups)
    names = groups.groupBy("__s").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"),
        F.sum(F.when(F.col("__d") != "", F.col("n") * (F.col("n") - 1) / 2).otherwise(0)).cast("long").alias("own"),
    )
    names = cut_lineage(names)
    edges = cut_lineage(similar_pairs(names.select(F.col("first").alias("id"), F.col("__s").alias("s")), threshold=threshold))
    a = names.select(F.col("first").alias("id_a"), F.col("n").alias("n_a"), F.col("__s").alias("s_a"))
    b = names.select(F.col("first").alias("id_b"), F.col("n").alias("n_b"), F.col("__s").alias("s_b"))
    pairs = edges.join(shuffled(a), "id_a").join(shuffled(b), "id_b")
    ga = groups.filter("__d <> ''").select(F.col("__s").alias("s_a"), "__d", F.col("n").alias("m_a"))
    gb = groups.filter("__d <> ''").select(F.col("__s").alias("s_b"), "__d", F.col("n").alias("m_b"))
    shared = (
        pairs.select("s_a", "s_b").join(shuffled(ga), "s_a").join(shuffled(gb), ["s_b", "__d"])
        .groupBy("s_a", "s_b").agg(F.sum(F.col("m_a") * F.col("m_b")).alias("same"))
    )
    two_names = pairs.join(shuffled(shared), ["s_a", "s_b"], "left").select(
        F.least("id_a", "id_b").alias("first_a"), F.greatest("id_a", "id_b").alias("first_b"), "score",
        (F.col("n_a") * F.col("n_b")).alias("pairs"), F.coalesce("same", F.lit(0)).cast("long").alias("pairs_same_district"),
    )
    one_name = names.filter("n > 1").select(
        F.col("first").alias("first_a"), F.col("first").alias("first_b"), F.lit(100.0).alias("score"),
        (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"), F.col("own").alias("pairs_same_district"),
    )
    return two_names.unionByName(one_name)


def _members(df: DataFrame, order_col: str) -> DataFrame:
    return with_name_keys(df.select("nombre", "partido", F.col(order_col).alias("o")))


def _pair_rows(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Row pairs of name pairs ``(s_a, s_b, score)`` from the given member rows."""
    a = members.select(*[F.col(c).alias(f"{c}_a") for c in members.columns])
    b = members.select(*[F.col(c).alias(f"{c}_b") for c in members.columns])
    both = pairs.join(a, F.col("s_a") == F.col("__s_a")).join(b, F.col("s_b") == F.col("__s_b"))
    both = both.filter((F.col("s_a") != F.col("s_b")) | (F.col("o_a") < F.col("o_b")))
    swap = F.col("o_a") > F.col("o_b")

    def pick(name: str, first: bool):
        x, y = (f"{name}_a", f"{name}_b") if first else (f"{name}_b", f"{name}_a")
        return F.when(swap, F.col(y)).otherwise(F.col(x))

    same = (F.col("__d_a") != "") & (F.col("__d_a") == F.col("__d_b"))
    return both.select(
        pick("o", True).alias("ord_a"), pick("nombre", True).alias("nombre_a"), pick("partido", True).alias("partido_a"),
        pick("o", False).alias("ord_b"), pick("nombre", False).alias("nombre_b"), pick("partido", False).alias("partido_b"),
        "score", F.when(same, "nombre+partido").otherwise("nombre").alias("match_type"),
    )


def _named(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Replace first orders by the names they stand for."""
    a = members.select(F.col("o").alias("first_a"), F.col("__s").alias("s_a"))
    b = members.select(F.col("o").alias("first_b"), F.col("__s").alias("s_b"))
    return pairs.join(a, "first_a").join(b, "first_b").select("s_a", "s_b", "score")


def find_fuzzy_matches(df: DataFrame, order_col: str = "ord", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Every row pair with ratio >= threshold, best first.

    The output is as large as the number of pairs; ``name_pairs`` says the same in
    one line per pair of names and ``top_matches`` lists the best k.
    """
    members = shuffled(_members(df, order_col))
    pairs = _named(name_pairs(df, order_col, threshold), members)
    return _pair_rows(pairs, members).orderBy(F.desc("score"), "ord_a", "ord_b")


def match_positions(matches: DataFrame, name: str = "n") -> DataFrame:
    """Matches (``ord_a, ord_b, score``) with their place from the best score down, ties by their rows."""
    return sorted_positions(matches, [F.desc("score"), F.asc("ord_a"), F.asc("ord_b")], name)


def _falling_thresholds(longest: int, threshold: float) -> list[float]:
    """Thresholds that let names of the longest length differ in 1, 2, 4 ... characters, the given one last."""
    edits = [2 ** i for i in range(max(1, longest).bit_length())]
    steps = [math.floor(10_000 * (1 - n / max(1, longest))) / 100 for n in edits]
    return [*[t for t in steps if t > threshold], threshold]


def top_matches(df: DataFrame, k: int = 20, order_col: str = "ord", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The first ``k`` rows of ``find_fuzzy_matches`` without listing the others.

    The k best row pairs lie in the k best name pairs, and use only the first k+1
    rows of each name. Copies come first, then pairs are sought from a high threshold down until
    there are k, so not all pairs of a table of like names are made.
    """
    members = _members(df, order_col)
    names = cut_lineage(members.groupBy("__s").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("first")))
    copies = names.filter("n > 1").select(
        F.col("first").alias("first_a"), F.col("first").alias("first_b"), F.lit(100.0).alias("score"), (F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    longest = names.agg(F.coalesce(F.max(F.length("__s")), F.lit(0))).first()[0]
    for least in [100, *_falling_thresholds(longest, threshold)]:
        best = copies
        if least < 100 or threshold >= 100:
            like = similar_pairs(names.select(F.col("first").alias("id"), F.col("__s").alias("s")), threshold=least)
            held = [shuffled(names.select(F.col("first").alias(f"id_{side}"), F.col("n").alias(f"n_{side}"))) for side in "ab"]
            best = best.unionByName(like.join(held[0], "id_a").join(held[1], "id_b").select(
                F.least("id_a", "id_b").alias("first_a"), F.greatest("id_a", "id_b").alias("first_b"), "score",
                (F.col("n_a") * F.col("n_b")).cast("double").alias("pairs")))
        best = cut_lineage(best)
        if best.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0] >= k:
            break
    # Where a name pairs with itself its best pair starts at its first row as well.
    best = best.orderBy(F.desc("score"), "first_a", F.col("first_a") != F.col("first_b"), "first_b").limit(2 * k)
    best = _named(best, members)
    wanted = best.select(F.explode(F.array("s_a", "s_b")).alias("__s")).distinct()
    position = F.row_number().over(W.partitionBy("__s").orderBy("o"))
    heads = members.withColumn("__rn", position).filter(F.col("__rn") <= k + 1).drop("__rn").join(
        F.broadcast(wanted), "__s", "left_semi"
    )
    return _pair_rows(F.broadcast(best), heads).orderBy(F.desc("score"), "ord_a", "ord_b").limit(k)


# ---------------------------------------------------------------- greedy de-duplication


def _names(nodes: DataFrame, by: list[str]) -> DataFrame:
    """Distinct names within ``by``, each with the least id of its nodes."""
    return cut_lineage(nodes.groupBy(*by, F.col("__s").alias("s")).agg(F.min("id").alias("id")))


def _held(nodes: DataFrame, names: DataFrame, by: list[str]) -> DataFrame:
    """Nodes as (name, id, d): the id of their name, their own id and their district."""
    of = names.select(*by, F.col("s").alias("__s"), F.col("id").alias("name"))
    return null_safe_join(nodes, shuffled(of), [*by, "__s"]).select("name", "id", F.col("__d").alias("d"))


def _compatible(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of names (a, b) spread to their nodes with compatible districts, as (id_a, id_b).

    An unknown district is compatible with all.
    """
    left, right = (shuffled(df.select(*[F.col(c).alias(f"{c}_{side}") for c in ("name", "id", "d")])) for df, side in ((left, "a"), (right, "b")))
    both = cut_lineage(pairs.select(F.col("a").alias("name_a"), F.col("b").alias("name_b")).join(left, "name_a"))
    same = both.filter("d_a <> ''").withColumn("d_b", F.col("d_a")).join(right, ["name_b", "d_b"])
    either = both.filter("d_a = ''").join(right, "name_b")
    unknown = both.filter("d_a <> ''").join(right.filter("d_b = ''"), "name_b")
    return reduce(DataFrame.unionByName, [df.select("id_a", "id_b") for df in (same, either, unknown)])


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _fold_survivors(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids that the in-order scan keeps, one fold a component.

    ``rows`` are (root, id), ``edges`` (lo, hi): a row goes if a kept one below it is linked to it.
    """
    below = edges.groupBy(F.col("hi").alias("id")).agg(F.collect_list(F.col("lo").cast("long")).alias("below"))
    scans = rows.join(shuffled(below), "id", "left").groupBy("root").agg(F.sort_array(F.collect_list(F.struct(F.col("id").cast("long").alias("id"), "below"))).alias("scan"))
    none = F.array().cast("array<bigint>")

    def step(kept, row):
        return F.when(F.coalesce(F.arrays_overlap(kept, row["below"]), F.lit(False)), kept).otherwise(F.array_append(kept, row["id"]))

    return scans.select(F.explode(F.aggregate("scan", none, step)).alias("id"))


def _folded(rows: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(ids kept in the groups that one fold can settle, rows and edges of the other groups)."""
    weights = edges.groupBy(F.col("hi").alias("id")).agg(F.count(F.lit(1)).alias("links"))
    sizes = rows.join(shuffled(weights), "id", "left").groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("links").alias("links"))
    large = cut_lineage(sizes.filter((F.col("n") > FOLD_ROWS) | (F.col("links") > FOLD_LINKS)).select("root"))
    if large.isEmpty():
        return _fold_survivors(rows, edges), None, None
    big = cut_lineage(rows.join(large, "root", "left_semi").select("id"))
    kept = _fold_survivors(rows.join(large, "root", "left_anti"), edges.join(shuffled(big), F.col("hi") == F.col("id"), "left_anti"))
    return kept, big, cut_lineage(edges.join(shuffled(big), F.col("hi") == F.col("id"), "left_semi"))


def _settle(nodes: DataFrame, threshold: float, by: list[str]) -> DataFrame:
    """Ids that the in-order scan keeps among all ``nodes``.

    Rows influence each other only along similar names within ``by``. A fold over its rows settles such a
    group, or each connected component of one that is too large for that; components that are too large are settled
    by rounds over their edges.
    """
    names = _names(nodes, by)
    pairs = cut_lineage(similar_pairs(names, None, threshold, on=by, scored=False).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    held = cut_lineage(_held(nodes, names, by))
    shared = held.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    linked = _both_ways(pairs).unionByName(shared.select(F.col("name").alias("a"), F.col("name").alias("b")))
    edges = cut_lineage(_compatible(linked, held, held).filter("id_a < id_b").toDF("lo", "hi"))
    kept, rows, edges = _folded(nodes.select("id", (F.xxhash64(*by) if by else F.lit(0)).alias("root")), edges)
    if rows is None:
        return kept
    roots = connected_components(edges.select(F.col("lo").alias("a"), F.col("hi").alias("b"))).withColumnRenamed("node", "id")
    more, rows, edges = _folded(cut_lineage(rows.join(shuffled(roots), "id", "left").select("id", F.coalesce("root", "id").alias("root"))), edges)
    kept = kept.unionByName(more)
    return kept if rows is None else kept.unionByName(rows.join(shuffled(_greedy_removed(edges)), "id", "left_anti"))


def _struck(kept: DataFrame, rest: DataFrame, threshold: float, by: list[str]) -> DataFrame:
    """Ids of ``rest`` that a node of ``kept`` removes."""
    own, far = _names(kept, by), _names(rest, by)
    pairs = similar_pairs(own, far, threshold, on=by, scored=False).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    return _compatible(pairs, _held(kept, own, by), _held(rest, far, by)).select(F.col("id_b").alias("id")).distinct()


def _greedy_removed(edges: DataFrame) -> DataFrame:
    """Nodes the in-order greedy scan removes, given all edges ``lo < hi``.

    Rounds: a node without undecided lower neighbour stays, its higher
    neighbours go; decided nodes leave the edge table.
    """
    spark = edges.sparkSession
    edges = cut_lineage(edges)
    removed = spark.createDataFrame([], edges.select(F.col("hi").alias("id")).schema)
    while not edges.isEmpty():
        kept = shuffled(edges.select("lo").distinct().join(shuffled(edges.select(F.col("hi").alias("lo")).distinct()), "lo", "left_anti"))
        gone = cut_lineage(edges.join(kept, "lo", "left_semi").select("hi").distinct())
        removed = removed.unionByName(gone.withColumnRenamed("hi", "id"))
        edges = cut_lineage(
            edges.join(kept, "lo", "left_anti")
            .join(shuffled(gone), "hi", "left_anti")
            .join(shuffled(gone.withColumnRenamed("hi", "lo")), "lo", "left_anti")
        )
    return removed


def _order_cut(df: DataFrame, size: int, buckets: int = 4096) -> int:
    """An id with about ``size`` to ``2 * size`` rows up to it, by counts in equal slices of the id range.

    A slice that holds too many is sliced again; the driver sees ``buckets`` counts a time.
    """
    low, high = df.agg(F.min("id"), F.max("id")).first()
    before = 0
    while True:
        width = max(1, -(-(high - low + 1) // buckets))
        counts = df.filter(F.col("id").between(low, high)).groupBy(F.floor((F.col("id") - low) / width).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
        for k, n in sorted((r["k"], r["n"]) for r in counts):
            if before + n >= size:
                break
            before += n
        if width == 1 or before + n <= 2 * size:
            return low + (k + 1) * width - 1
        low, high = low + k * width, low + (k + 1) * width - 1


def fuzzy_survivors(nodes: DataFrame, threshold: float, by: list[str], first_batch: int = FIRST_BATCH) -> DataFrame:
    """Ids the greedy scan keeps among distinct nodes ``(id, __s, __d, by...)``.

    Nodes are taken in growing batches of the given order. Each batch is settled
    on its own, then its kept nodes prune everything behind it, so a dense
    cluster of variants is cut down by its first member instead of yielding
    all of its pairs.
    """
    undecided = cut_lineage(nodes)
    left = undecided.count()
    size, kept_all = first_batch, []
    while left > 0:
        if left <= 2 * size:
            kept_all.append(_settle(undecided, threshold, by))
            break
        cut = _order_cut(undecided, size)
        batch, rest = undecided.filter(F.col("id") <= cut), undecided.filter(F.col("id") > cut)
        kept = cut_lineage(batch.join(shuffled(_settle(batch, threshold, by)), "id", "left_semi"))
        kept_all.append(kept.select("id"))
        undecided = cut_lineage(rest.join(shuffled(_struck(kept, rest, threshold, by)), "id", "left_anti"))
        left = undecided.count()
        size *= BATCH_GROWTH
    out = nodes.select("id").limit(0)
    for part in kept_all:
        out = out.unionByName(part)
    return out


def dedup_fuzzy(df: DataFrame, order_col: str = "ord", threshold: float = DEFAULT_THRESHOLD,
                by: list[str] | None = None, first_batch: int = FIRST_BATCH) -> DataFrame:
    """Greedy in-order fuzzy de-duplication (within ``by``).

    A kept row removes later rows with ratio >= threshold and a compatible
    district. Rows with equal sorted name and district collapse to the first
    beforehand: they share every neighbour.
    """
    by = by or []
    keyed = with_name_keys(df)
    nodes = keyed.groupBy(*by, "__s", "__d").agg(F.min(order_col).alias("id"))
    survivors = fuzzy_survivors(nodes, threshold, by, first_batch)
    return df.join(shuffled(survivors.withColumnRenamed("id", order_col)), order_col, "left_semi")


# ---------------------------------------------------------------- production


def dedup_vs_production(new: DataFrame, production: DataFrame, order_col: str = "ord",
                        threshold: float = DEFAULT_THRESHOLD, any_match: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows not in production, fuzzy matches) of a new batch.

    Exact keys go first. Each remaining row is judged by its best production
    name (highest score, then earliest row): a match needs a compatible
    district *of that row*. ``any_match`` accepts any similar production row.
    """
    candidates = with_name_keys(exact_new(new, production))
    prod = with_name_keys(production.select("nombre", "partido", F.col(order_col).alias("prod_ord")))
    keys = ["__s", "__d"] if any_match else ["__s"]
    prod_names = cut_lineage(first_per_group(prod, keys, ["prod_ord"]))
    new_names = cut_lineage(candidates.groupBy("__s").agg(F.min(order_col).alias("id")))
    prod_nodes = prod_names.groupBy("__s").agg(F.min("prod_ord").alias("id"))
    equal = new_names.join(shuffled(prod_nodes.withColumnRenamed("id", "id_b")), "__s").select(
        F.col("id").alias("id_a"), "id_b", F.lit(100.0).alias("score"))
    if any_match:
        open_names = new_names
    else:
        open_names = new_names.join(shuffled(prod_nodes.select("__s")), "__s", "left_anti")
    fuzzy = similar_pairs(
        open_names.select("id", F.col("__s").alias("s")), prod_nodes.select("id", F.col("__s").alias("s")), threshold
    )
    scored = (fuzzy if any_match else equal.unionByName(fuzzy))
    prod_rows = prod_names.select(
        F.col("prod_ord"), F.col("nombre").alias("prod_nombre"), F.col("partido").alias("prod_partido"),
        F.col("__d").alias("__pd"), F.col("__s").alias("__ps"),
    )
    if any_match:
        firsts = prod_nodes.select(F.col("id").alias("id_b"), F.col("__s").alias("__ps"))
        options = scored.join(shuffled(firsts), "id_b").join(shuffled(prod_rows), "__ps")
    else:
        options = scored.withColumnRenamed("id_b", "prod_ord").join(shuffled(prod_rows), "prod_ord")
    named = options.join(shuffled(new_names.select(F.col("id").alias("id_a"), "__s")), "id_a")
    best_of = ["__s"] if not any_match else ["__s", "__pd"]
    best = named.groupBy(*best_of).agg(
        F.max_by(F.struct("prod_ord", "prod_nombre", "prod_partido", "score", F.col("__pd").alias("pd")),
                 F.struct("score", -F.col("prod_ord"))).alias("best")
    )
    joined = candidates.join(shuffled(best.select("__s", "best")), "__s", "left")
    hit = joined.filter(F.col("best").isNotNull() & same_district("__d", F.col("best.pd")))
    if any_match:
        hit = first_per_group(hit, [order_col], [-F.col("best.score"), F.col("best.prod_ord")])
    matches = hit.select(
        F.col(order_col).alias("ord_a"), F.col("nombre").alias("nombre_a"), F.col("partido").alias("partido_a"),
        F.col("best.prod_ord").alias("ord_b"), F.col("best.prod_nombre").alias("nombre_b"),
        F.col("best.prod_partido").alias("partido_b"), F.col("best.score").alias("score"),
        F.lit("vs_production").alias("match_type"),
    )
    unique = candidates.drop("__s", "__d").join(shuffled(matches.select(F.col("ord_a").alias(order_col))), order_col, "left_anti")
    return unique, matches
