"""Pairs of sections that share names, without a list of sections joined with itself.

The names of a section are put in order, rare ones first; a pair is found at the first name that
both have, and so once. From there on a pair cannot share more names than either section has left,
so the place of a name bounds what it can lead to.

Rare names are met as they are: their lists are short. The pairs that share rare names give the
k-th best so far. Lists of frequent names are then cut into blocks, of sections that have equally
many names left and stand together in the order of pairs. Pairs of blocks are looked at in rounds,
those first that can give the best pairs; after each round only those are left that can still beat the k-th
best, which is compared by the number of shared names and, among equals, by the order of pairs. Where one name
stands in every section, a few pairs of blocks decide. The result is the exact top-k.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import values as V
from lexispark.operators.numbering import numbered_within
from lexispark.sources.work import kept

#: A name in more sections than this is frequent; sections of a block at least, blocks of a list at most.
RARE, BLOCK, MOST_BLOCKS = 8, 256, 2048
#: Pairs of blocks of a first round, for each group that has its own top-k, and how many times more the next one takes.
FIRST, GROW = 64, 8


def _order() -> list:
    return [F.desc("n_shared"), "source_a", "doc_a", "source_b", "doc_b"]


def meaningful(sections: DataFrame) -> DataFrame:
    """Sections with names (array): nouns as they are and terms in small letters, names common to all left out.

    Nouns meet only nouns and terms only terms, so each keeps its kind in front.
    """
    common = [n.lower() for n in V.COMMON_NAMES]
    terms = F.array_distinct(F.transform("terms", lambda t: F.concat(F.lit("t:"), F.lower(t))))
    nouns = F.transform("nouns", lambda n: F.concat(F.lit("n:"), n))
    drop = lambda a: F.filter(a, lambda x: ~F.lower(F.substring(x, 3, 1 << 20)).isin(common))
    return sections.where(F.col("n_words") >= V.MIN_WORDS).select("source", "doc_id", "heading", drop(F.concat(nouns, terms)).alias("names"))


def distinct_strings(names: Column) -> Column:
    """Distinct strings among names of both kinds."""
    return F.size(F.array_distinct(F.transform(names, lambda x: F.substring(x, 3, 1 << 20))))


def _sets(sections: DataFrame, within: bool, used: Iterable) -> DataFrame:
    """(home, source, doc_id, heading, used, names, frequent), a stored table: names that can be shared, rare ones first, ``frequent`` of them not rare.

    home is what a pair has in common: its source inside sources, nothing between them.
    """
    # Names are found in the texts once.
    own = kept(meaningful(sections).where("size(names) > 0 and source is not null and doc_id is not null").withColumn("home", F.col("source") if within else F.lit("")), "names")
    listed = own.select("home", "source", "doc_id", F.explode(F.array_distinct("names")).alias("name"))
    rated = listed.join(listed.groupBy("home", "name").agg(F.count("*").alias("df")).where("df > 1"), ["home", "name"])
    named = rated.groupBy("source", "doc_id").agg(F.array_sort(F.collect_set(F.struct("df", "name"))).alias("x"))
    frequent = F.size(F.filter("x", lambda x: x["df"] > RARE)).alias("frequent")
    # ``used`` is a bounded set.
    marked = own.select("source", "doc_id", "home", "heading").join(F.broadcast(_used(sections, used)), "doc_id", "left").withColumn("used", F.coalesce("used", F.lit(False)))
    return kept(marked.join(named, ["source", "doc_id"]).select("home", "source", "doc_id", "heading", "used", F.transform("x", lambda x: x["name"]).alias("names"), frequent), "pair-sets")


def _used(sections: DataFrame, used: Iterable) -> DataFrame:
    return sections.sparkSession.createDataFrame([(u, True) for u in sorted(set(used))], "doc_id long, used boolean")


def _ends(rows: DataFrame, within: bool, *carried: str) -> DataFrame:
    """Rows with the columns of two sections (x_, y_) as rows of an ordered pair (_a, _b), where the two make one."""
    x, y = F.struct("x_source", "x_doc_id"), F.struct("y_source", "y_doc_id")
    good = (F.col("x_heading") != F.col("y_heading")) if within else (F.col("x_source") != F.col("y_source"))
    side = lambda c, first: F.when((x < y) == F.lit(first), F.col(f"x_{c}")).otherwise(F.col(f"y_{c}"))
    ends = [side(c, first).alias(f"{to}_{s}") for s, first in (("a", True), ("b", False)) for c, to in (("source", "source"), ("doc_id", "doc"), *((c, c) for c in carried))]
    return rows.where(good & ~(F.col("x_used") & F.col("y_used"))).select(*(c for c in rows.columns if c[:2] not in ("x_", "y_")), *ends)


def _side(rows: DataFrame, x: str, *keys: str) -> DataFrame:
    return rows.select(*keys, *(F.col(c).alias(f"{x}_{c}") for c in rows.columns if c not in keys))


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs of each group, with their place r."""
    order = Window.partitionBy("group").orderBy(*_order())
    return pairs.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def _bounds(best: DataFrame, k: int) -> DataFrame:
    """(group, least, last): the number of shared names and the place of the k-th best pair of the groups that have one."""
    return best.where(F.col("r") == k).select("group", F.col("n_shared").alias("least"), F.struct("source_a", "doc_a").alias("last"))


def _rare_pairs(sets: DataFrame, within: bool, k: int, group: Column) -> DataFrame:
    """Pairs that share rare names, exactly counted where they can be among the k best."""
    rare = sets.select("home", "source", "doc_id", "heading", "used", "frequent", F.explode(F.slice("names", F.lit(1), F.size("names") - F.col("frequent"))).alias("name"))
    x, y = (_side(rare, s, "home", "name") for s in "xy")
    met = x.join(y, ["home", "name"]).where(F.struct("x_source", "x_doc_id") < F.struct("y_source", "y_doc_id"))
    kind = F.left("name", F.lit(1))
    counted = _ends(met, within, "frequent").groupBy("source_a", "doc_a", "source_b", "doc_b").agg(
        F.count("*").alias("most"), F.greatest(F.count_if(kind == "n"), F.count_if(kind == "t")).alias("n_shared"), F.max(F.least("frequent_a", "frequent_b")).alias("more"))
    found = kept(counted.withColumn("group", group), "pair-counts")
    bound = _bounds(_top(found, k), k).drop("last")
    near = found.drop("n_shared").join(bound, "group", "left").where(F.col("most") + F.col("more") >= F.coalesce("least", F.lit(0)))
    names = lambda s: sets.select(F.col("source").alias(f"source_{s}"), F.col("doc_id").alias(f"doc_{s}"), F.col("names").alias(f"names_{s}"))
    whole = near.join(names("a"), ["source_a", "doc_a"]).join(names("b"), ["source_b", "doc_b"])
    return _pairs(whole.withColumn("n_shared", distinct_strings(F.array_intersect("names_a", "names_b"))))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select("group", "source_a", "doc_a", "source_b", "doc_b", "n_shared")


def _blocks(sets: DataFrame, least: DataFrame, group: Column) -> DataFrame | None:
    """(home, name, block, source, doc_id, rest) of frequent names from which enough names are left to reach a group's bound; None without any."""
    place = F.posexplode("names").alias("p", "name")
    entries = sets.where("frequent > 0").select("home", "source", "doc_id", F.size("names").alias("n"), "frequent", place).where("p >= n - frequent")
    bounded = entries.withColumns({"rest": F.col("n") - F.col("p"), "group": group}).join(least, "group", "left").where(F.col("rest") >= F.coalesce("least", F.lit(1)))
    placed = numbered_within(bounded.select("home", "name", "rest", "source", "doc_id"), ["home", "name"], F.desc("rest"), "source", "doc_id")
    size = F.greatest(F.lit(BLOCK), F.ceil(F.col("n") / MOST_BLOCKS))
    return kept(placed.where("n > 1").select("home", "name", F.floor(F.col("ord") / size).alias("block"), "source", "doc_id", "rest"), "pair-blocks")


def _block_pairs(blocks: DataFrame, within: bool, group: Column) -> DataFrame:
    """(group, home, name, x, y, most, first): pairs of blocks, the most names and the first place that a pair from them can have."""
    whole = blocks.groupBy("home", "name", "block").agg(F.max("rest").alias("rest"), F.min(F.struct("source", "doc_id")).alias("first"), F.min("source").alias("low"), F.max("source").alias("high"), F.count("*").alias("n"))
    x, y = (_side(whole, s, "home", "name") for s in "xy")
    met = x.join(y, ["home", "name"]).where("x_block < y_block or (x_block = y_block and x_n > 1)")
    if not within:
        met = met.where("x_low <> y_high or y_low <> x_high")
    return met.select(F.lit(None).cast("string").alias("source_a") if not within else F.col("home").alias("source_a"), "home", "name", F.col("x_block").alias("x"), F.col("y_block").alias("y"), F.least("x_rest", "y_rest").alias("most"), F.least("x_first", "y_first").alias("first")).withColumn("group", group).drop("source_a")


def _expanded(chosen: DataFrame, blocks: DataFrame, sets: DataFrame, within: bool) -> DataFrame:
    """The pairs of chosen pairs of blocks that have no common name before the block's."""
    key = ["home", "name", "x", "y"]
    sides = []
    for s in "xy":
        members = blocks.withColumnRenamed("block", s).join(chosen.select("group", *key), ["home", "name", s]).join(sets.drop("home", "frequent"), ["source", "doc_id"])
        sides.append(_side(members.drop("rest") if s == "x" else members.drop("rest", "group"), s, *key, *(["group"] if s == "x" else [])))
    met = sides[0].join(sides[1], key).where((F.col("x") != F.col("y")) | (F.struct("x_source", "x_doc_id") < F.struct("y_source", "y_doc_id")))
    rows = _ends(met, within, "names").withColumn("shared", F.array_intersect("names_a", "names_b"))
    return _pairs(rows.where(F.get("shared", F.lit(0)) == F.col("name")).withColumn("n_shared", distinct_strings(F.col("shared"))))


def best_pairs(sections: DataFrame, k: int, within: bool, used: Iterable = (), by_source: bool = False) -> DataFrame:
    """(group, r, source_a, doc_a, source_b, doc_b, n_shared): the k best pairs of all, or of each source; pairs of two sections of ``used`` are left out."""
    group = F.col("source_a") if by_source else F.lit("")
    home = F.col("home") if by_source else F.lit("")
    sets = _sets(sections, within, used)
    best = kept(_top(_rare_pairs(sets, within, k, group), k), "pairs")
    blocks = _blocks(sets, _bounds(best, k).drop("last"), home)
    if blocks.isEmpty():
        return best
    pairs, cut, m = kept(_block_pairs(blocks, within, home), "block-pairs"), None, FIRST
    order = F.struct((-F.col("most")).alias("most"), "first", "home", "name", "x", "y")
    while True:
        alive = pairs.withColumn("place", order).join(_bounds(best, k), "group", "left").where("least is null or most > least or (most = least and first <= last)")
        if cut is not None:  # a group with none in the last round has none now
            alive = alive.join(cut, "group").where(F.col("place") > F.col("done"))
        window = Window.partitionBy("group").orderBy("place")
        chosen = kept(alive.drop("least", "last").withColumn("n", F.row_number().over(window)).where(F.col("n") <= m), "chosen-blocks")
        if chosen.isEmpty():
            return best
        best = kept(_top(best.drop("r").unionByName(_expanded(chosen, blocks, sets, within)), k), "pairs")
        cut, m = chosen.groupBy("group").agg(F.max("place").alias("done")), m * GROW


def top_pairs(sections: DataFrame, k: int = 10, within: bool = True, used: Iterable = ()) -> DataFrame:
    """(rank, doc_a, doc_b, source_a, source_b, n_shared) of the k best pairs, inside sources or between them.

    Pairs of two sections that are both among the doc_ids of ``used``, a bounded set, are left out.
    """
    return best_pairs(sections, k, within, used).withColumnRenamed("r", "rank").drop("group")


def linked_sources(sections: DataFrame, used: Iterable = ()) -> int:
    """How many sources have a pair inside: two headings and an unused section meet in a name."""
    own = meaningful(sections).join(F.broadcast(_used(sections, used)), "doc_id", "left")  # a bounded set
    named = own.where("heading is not null").select("source", "heading", F.col("used").isNull().alias("free"), F.explode("names").alias("name"))
    met = named.groupBy("source", "name").agg(F.min("heading").alias("low"), F.max("heading").alias("high"), F.max("free").alias("free"))
    return met.where("free and low < high").agg(F.count_distinct("source")).first()[0]


def top_pairs_by_source(sections: DataFrame, k: int, sources: int, used: Iterable = ()) -> DataFrame:
    """(doc_a, doc_b, source_a, source_b, n_shared) of the k best pairs inside each of the ``sources`` sources whose best pairs lead."""
    best = best_pairs(sections, k, True, used, by_source=True)
    leading = best.where("r = 1").orderBy(*_order()).limit(sources).select("source_a")
    return best.join(F.broadcast(leading), "source_a", "left_semi").drop("r", "group")  # at most ``sources`` names


def deciding_pairs(sections: DataFrame, count: int, used: Iterable, within: bool) -> tuple[list, int | None]:
    """The pairs in order that decide ``capped``, and inside sources the number of sources with a pair.

    Twice what is wanted is fetched at first, and more only while a choice hangs on pairs behind
    what is known. The first round inside sources is decided when each of the leading ``count``
    sources has reached its cap or has no more pairs, as it ends with the best pair of the last of them; the
    second when what it takes are leading pairs of all.
    """
    own, first, n = [], [], None
    if within:
        n = linked_sources(sections, used)
        cap = source_cap(count, n)
        m = 2 * cap
        while True:
            own = _collected(top_pairs_by_source(sections, m, count, used))
            first, _ = _accepted(own, count, set(used), cap, [])
            known, got = Counter(p["source_a"] for p in own), Counter(p["source_a"] for p in first)
            if all(known[s] < m or got[s] >= cap for s in known):
                break
            m *= 4
    k = 2 * count
    while True:
        every = _collected(top_pairs(sections, k, within, used).drop("rank"))
        found = sorted({tuple(p): p for p in own + every}.values(), key=lambda p: (-p["n_shared"], p["source_a"], p["doc_a"], p["source_b"], p["doc_b"]))
        taken, leading = capped(found, count, used, within, n), {tuple(p) for p in every}
        if len(every) < k or (len(taken) >= count and all(p in first or tuple(p) in leading for p in taken)):
            return found, n
        k *= 4


def _collected(pairs: DataFrame) -> list:
    """The rows of a bounded table of pairs."""
    return pairs.select("doc_a", "doc_b", "source_a", "source_b", "n_shared").orderBy(*_order()).collect()


def _accepted(pairs: list, count: int, used: set, cap: int, taken: list) -> tuple[list, set]:
    """One round over pairs in order: those taken, up to count of all and cap of a source, and the used sections after it."""
    taken, seen = list(taken), Counter()
    for p in pairs:
        if len(taken) < count and p not in taken and seen[p["source_a"]] < cap and not {p["doc_a"], p["doc_b"]} <= used:
            seen[p["source_a"]] += 1
            used |= {p["doc_a"], p["doc_b"]}
            taken.append(p)
    return taken, used


def source_cap(count: int, n_sources: int) -> int:
    return max(1, count // max(1, n_sources))


def capped(pairs: Iterable, count: int, used: set, per_source: bool, n_sources: int | None = None) -> list:
    """The accepted pairs of an ordered, bounded list of rows (doc_a, doc_b, source_a).

    A pair is skipped when both ends are used. Inside sources, a first round takes at most
    max(1, count // sources) pairs of a source, a second one fills up; the sources are those of
    all pairs, of the list where ``n_sources`` is not given.
    """
    pairs, used, taken = list(pairs), set(used), []
    if per_source:
        cap = source_cap(count, len({p["source_a"] for p in pairs}) if n_sources is None else n_sources)
        taken, used = _accepted(pairs, count, used, cap, taken)
    return _accepted(pairs, count, used, count, taken)[0]
