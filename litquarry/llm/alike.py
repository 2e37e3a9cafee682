"""Components of texts that are alike, among those that share a band of a MinHash signature."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.llm.components import components
from litquarry.session import TURNS, discard, in_turns, materialize, materialize_all

BROADCAST_ROWS = 500_000
"""Most rows, of a few numbers each, that a join sends to all executors; beyond it both sides are shuffled."""

FEW_MEMBERS = 16
"""Members of a band whose pairs are listed; those of wider ones are found by what sets them apart from a center, with the same links."""

TURN_ROWS = 5_000_000
"""Rows of (h1, band) from which on they are shuffled in turns."""

Shingles = Callable[[Column], Column]


def sized(df: DataFrame) -> DataFrame:
    """A written table, to be sent to all executors if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def with_jaccard(df: DataFrame, a: str, b: str, shingles: Shingles, name: str) -> DataFrame:
    """``df`` with the Jaccard similarity of the shingle sets of two columns; null if both sets are empty."""
    sets = df.withColumns({"_a": F.array_distinct(shingles(F.col(a))), "_b": F.array_distinct(shingles(F.col(b)))})
    both = sets.withColumn("_both", F.size(F.array_intersect("_a", "_b")))
    jaccard = F.try_divide(F.col("_both"), F.size("_a") + F.size("_b") - F.col("_both"))
    return both.select(*df.columns, F.explode(F.array(jaccard)).alias(name))


def alike_links(banded: DataFrame, texts_of: Callable[[DataFrame], list[DataFrame]], shingles: Shingles, least: float) -> DataFrame:
    """(a, b) of hashes h1; their components are at least those of all pairs that share a band and are ``least`` alike.

    ``banded`` is a written table of (h1, band) without repeats, which goes when it has been read; ``texts_of`` gives (h1, norm, times) of the
    h1 it is handed, in parts without a common h1, ``times`` being how often each is found; ``shingles`` makes the hashes of the shingles of a ``norm``.

    Every member of a band is compared with the band's smallest, and if they are not alike with its
    largest one, which joins groups of copies at a cost that grows with members and not with pairs.
    A band of two is done by its smallest and largest alone, so only the members of wider ones are
    looked up. Of those that then are in different components, all pairs are listed in a band of few, and
    the others are found by ``_meet_early``.
    """
    parts = in_turns(banded, F.col("band"), min(TURNS, 1 + banded.count() // TURN_ROWS))
    counted = [p.groupBy("band").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.count(F.lit(1)).alias("n")) for p in parts]
    shared = materialize_all([p.filter("n > 1") for p in counted], "bands")
    wide = materialize(shared.filter("n > 2").select("band", "low", "high"), "wide_bands")
    few_wide = sized(wide)
    inner = materialize_all([p.join(few_wide, "band").filter("h1 <> low and h1 <> high") for p in parts], "inner_members")
    discard(banded, wide)
    ends = shared.select(F.explode(F.array("low", "high")).alias("h1"))
    wanted = materialize(ends.unionByName(inner.select("h1")).distinct(), "wanted")
    texts = [t.withColumn("size", F.size(F.array_distinct(shingles(F.col("norm"))))) for t in texts_of(wanted)]
    texts = materialize_all(texts, "member_texts")
    discard(wanted)
    sizes = sized(texts.select("h1", "size"))
    n_texts = texts.count()

    def alike(pairs: DataFrame) -> DataFrame:
        # Sets that are alike have sizes that are, which spares most other pairs their texts.
        near = pairs.join(sizes.select(F.col("h1").alias("a"), F.col("size").alias("x")), "a").join(sizes.select(F.col("h1").alias("b"), F.col("size").alias("y")), "b")
        near = materialize(near.filter(F.least("x", "y") >= F.greatest("x", "y") * least - 1e-9).select("a", "b"), "pairs")
        # Pairs may be far more than texts, so no more of them than there are texts are shuffled with both at a time.
        turns = 1 + max(0, near.count() - 1) // max(1, n_texts)
        compared = []
        for some, own in zip(in_turns(near, F.col("a"), turns), in_turns(texts, F.col("h1"), turns), strict=True):
            with_a = some.join(own.select(F.col("h1").alias("a"), F.col("norm").alias("a_norm")), "a")
            both = with_a.join(texts.select(F.col("h1").alias("b"), F.col("norm").alias("b_norm")), "b")
            compared.append(with_jaccard(both, "a_norm", "b_norm", shingles, "s").filter(F.col("s") >= least).select("a", "b"))
        found = materialize_all(compared, "alike")
        discard(near)
        return found

    to_low = shared.select(F.col("low").alias("a"), F.col("high").alias("b")).unionByName(inner.select(F.col("low").alias("a"), F.col("h1").alias("b")))
    near_low = alike(to_low.distinct())
    left = inner.join(near_low, (F.col("low") == F.col("a")) & (F.col("h1") == F.col("b")), "left_anti")
    near_high = alike(left.select(F.col("high").alias("a"), F.col("h1").alias("b")).distinct())
    stars = materialize(components(near_low.unionByName(near_high)), "roots")
    mixed = _mixed(inner.select("band", "h1"), stars)
    few = mixed.filter(F.col("n") <= FEW_MEMBERS)
    a = few.select("band", F.col("h1").alias("a"), F.col("root").alias("a_root"))
    b = few.select("band", F.col("h1").alias("b"), F.col("root").alias("b_root"))
    listed = a.join(b, "band").filter("a < b and a_root <> b_root").select("a", "b")
    apart = _from_center(mixed.filter(F.col("n") > FEW_MEMBERS).select("band", "h1", "root"), texts, shingles)
    # Those that are alike with their center are linked by it, so they count as of its component.
    to_center = F.size("apart") <= (F.col("size") + F.col("base")) * ((1 - least) / (1 + least)) + 1e-9
    center_root = apart.filter("h1 = center").select("center", F.col("root").alias("center_root"))
    joined = apart.join(center_root, "center").withColumn("root", F.when(to_center, F.col("center_root")).otherwise(F.col("root")))
    near_center = apart.filter(to_center & F.expr("h1 <> center")).select(F.col("center").alias("a"), F.col("h1").alias("b"))
    more = alike(listed.unionByName(_meet_early(joined.drop("center_root"), least)).distinct())
    discard(texts, shared, inner, near_low, near_high, mixed)
    return stars.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(near_center).unionByName(more)


def _mixed(inner: DataFrame, stars: DataFrame) -> DataFrame:
    """(band, h1, root, n) of the inner members of bands that hold more than one component, n being a band's inner members.

    A band's smallest and largest member are left out, as all have been compared with them or are
    alike to the smallest.
    """
    rooted = inner.join(sized(stars), F.col("h1") == F.col("node"), "left").select("band", "h1", F.coalesce("root", "h1").alias("root"))
    rooted = materialize(rooted, "inner")
    mixed = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n"))
    mixed = materialize(mixed.filter("x <> y").select("band", "n"), "mixed")
    held = materialize(rooted.join(sized(mixed), "band"), "inner")
    discard(rooted, mixed)
    return held


def _from_center(members: DataFrame, texts: DataFrame, shingles: Shingles) -> DataFrame:
    """(center, h1, root, size, base, apart) of members (band, h1, root): in which shingles each differs from its band's center.

    The center is the member whose text is found most often, by the column ``times`` of ``texts`` if
    it has one, and then the smallest; bands of one center are one group. ``apart`` holds the shingles
    that only one of the two has, ``size`` and ``base`` count those of the member and of the center.
    """
    times = F.col("times") if "times" in texts.columns else F.lit(1)
    ranked = members.join(texts.select("h1", (-times).alias("rank")), "h1")
    centers = ranked.groupBy("band").agg(F.min(F.struct("rank", "h1")).alias("c")).select("band", F.col("c.h1").alias("center"))
    grouped = materialize(members.join(centers, "band").select("center", "h1", "root").distinct(), "centers")
    with_base = grouped.join(texts.select(F.col("h1").alias("center"), F.col("norm").alias("_base")), "center")
    both = with_base.join(texts.select("h1", F.col("norm").alias("_own")), "h1")
    sets = both.withColumns({"_own": F.array_distinct(shingles(F.col("_own"))), "_base": F.array_distinct(shingles(F.col("_base")))})
    apart = F.concat(F.array_except("_own", "_base"), F.array_except("_base", "_own"))
    found = materialize(sets.select("center", "h1", "root", F.size("_own").alias("size"), F.size("_base").alias("base"), apart.alias("apart")), "apart")
    discard(grouped)
    return found


def _pairs_by_prefix(members: DataFrame, texts: DataFrame, shingles: Shingles, least: float) -> DataFrame:
    """(a, b) of members (band, h1, root) of a band in different components that may be alike; none that is alike is missing."""
    return _meet_early(_from_center(members, texts, shingles), least)


def _meet_early(apart: DataFrame, least: float) -> DataFrame:
    """(a, b) of the members of ``_from_center`` that have one center, different roots and may be alike; none that is alike is missing.

    What two sets differ in is what their differences from the center do not share, so two that are
    alike share some of these, unless both are alike with the center (then they are near). How many at
    least follows from the size of a set and of its difference, and if the other one is not near,
    it is about half of the difference. A difference is put in order, from the shingles that few members
    of the group differ in to those that many do, and so many of its last ones can be left out, as the
    first shared one is before them. What the group has in common is in no difference, so members
    meet in what sets them apart. Components meet in a shingle first, if the sizes and places of
    their members allow it, so the members of one, which may be very many, are not paired with each other.
    """
    far = (1 - least) / (1 + least)
    # Of all sizes that an alike set can have, the one that asks for the fewest shared shingles.
    other = F.greatest(F.least(F.col("base"), F.col("size") / least), F.col("size") * least)
    by_size = F.ceil((F.size("apart") + F.abs(other - F.col("base")) - (F.col("size") + other) * far) / 2 - 1e-9)
    # The other's difference can be smaller by no more than the two may differ.
    need = F.greatest(by_size, F.ceil(F.size("apart") - F.col("size") * (far * (1 + 1 / least)) - 1e-9))
    with_far = F.ceil((F.size("apart") + (F.col("base") - F.col("size")) * far) / 2 - 1e-9)
    sets = apart.select("center", "h1", "root", "size", F.size("apart").alias("n"), need.alias("need"), F.greatest(need, with_far, F.lit(1)).alias("with_far"), "apart")
    own = ["center", "h1", "root", "size", "n", "need", "with_far"]
    each = sets.select(*own, F.explode("apart").alias("shingle"))
    often = each.groupBy("center", "shingle").agg(F.count(F.lit(1)).alias("times"), F.max(F.col("need") > 0).alias("far")).filter("times > 1 and far").drop("far")
    # Shingles of one member alone, or of near ones alone, come first and meet none; only their number counts.
    # Spark sizes exploded rows, and rows that repeat their columns, by files that are far smaller, and would broadcast them.
    ordered = each.hint("merge").join(often, ["center", "shingle"]).groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("s"))
    early = ordered.select(*own, (F.col("n") - F.size("s")).alias("alone"), F.posexplode("s").alias("at", "e"))
    early = early.select(*own, (F.col("alone") + F.col("at")).alias("at"), F.col("e.shingle").alias("shingle"))
    kind = F.when(F.col("at") > F.col("n") - F.col("with_far"), "late").when(F.col("need") <= 0, "near").otherwise("far")
    early = early.withColumn("kind", kind).filter("kind <> 'late' or need > 0 and at <= n - need")
    near = sets.filter("need <= 0").select(*own, F.lit(0).alias("at"), F.lit(0).cast("long").alias("shingle"), F.lit("all near").alias("kind"))
    early = materialize(early.unionByName(near).drop("need", "with_far"), "prefix")
    spans = [F.min("size").alias("low"), F.max("size").alias("high"), F.min("n").alias("least_n"), F.max(F.col("n") - F.col("at")).alias("rest")]
    roots = early.groupBy("center", "shingle", "root", "kind").agg(*spans)
    x, y = (roots.select("center", "shingle", *[F.col(c).alias(f"{c}_{i}") for c in ("root", "kind", "low", "high", "least_n", "rest")]) for i in "xy")
    meets = "kind_x = kind_y and kind_x in ('far', 'all near') and root_x < root_y or kind_x = 'near' and kind_y in ('far', 'late') and root_x <> root_y"
    fit = (F.col("high_x") >= F.col("low_y") * least - 1e-9) & (F.col("high_y") >= F.col("low_x") * least - 1e-9)
    left = F.least("rest_x", "rest_y") >= (F.col("least_n_x") + F.col("least_n_y") - (F.col("high_x") + F.col("high_y")) * far) / 2 - 1e-9
    meet = x.join(y, ["center", "shingle"]).filter(meets).filter(fit & left).select("center", "shingle", "root_x", "kind_x", "root_y", "kind_y")

    def side(i: str, name: str) -> DataFrame:
        given = (("root", "root_" + i), ("kind", "kind_" + i), ("h1", name), ("size", name + "_size"), ("n", name + "_n"), ("at", name + "_at"))
        return early.select("center", "shingle", *[F.col(c).alias(to) for c, to in given]).hint("merge")

    found = meet.join(side("x", "a"), ["center", "shingle", "root_x", "kind_x"]).join(side("y", "b"), ["center", "shingle", "root_y", "kind_y"])
    rest = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    shared = (F.col("a_n") + F.col("b_n") - (F.col("a_size") + F.col("b_size")) * far) / 2
    alike_sizes = F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * least - 1e-9
    return found.filter(alike_sizes & (rest >= shared - 1e-9)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
