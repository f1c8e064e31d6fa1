"""Compare the captures of each group (one comparison per ``group_id``).

Input: handoff rows with ``group_id, pos`` (member order inside the group;
unique per group), ``kind, title, save_target, file_name, entities, tags``.
Failed captures take part as ``mixed_unknown`` with an empty title.

Plan, built so that a group holding a third of all rows is still spread out:

1. Every member is unrolled into one fact row and one row per entity and tag, and these are counted by
   ``(group_id, dimension, value)`` with map-side combine: counts, first positions, min/max of kind, title and
   target.  No member is collected, ties and gaps in ``pos`` are fine.
2. A window over the few rows of a group (its facts and its distinct values) keeps the values that all members
   share; one row per group comes out.

Members are a long table of their own (``compared_members``).  ``render_compare`` shows a group in one row and joins its
member lists at the very end; ``compare_lines`` gives the same block as numbered pieces, one row per member and list, so that no row or
task holds a group.  ``similar_classes`` (G6) compares the distinct tag sets of a group, never its members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsight.functions import rules as R

def members(handoffs: DataFrame) -> DataFrame:
    """Project handoff rows onto the columns the comparison needs."""
    # The normalized source name: empty for captures that failed.
    fname = F.col("source.file_name") if "source" in handoffs.columns else F.col("file_name")
    return handoffs.select("group_id", "pos", "kind", F.coalesce("title", F.lit("")).alias("title"), "save_target", fname.alias("file_name"),
                           "entities", "tags")


def compared_members(handoffs: DataFrame, min_members: int = 2) -> DataFrame:
    """The compared records in long form: ``group_id, pos, file_name, kind, title, save_target`` of groups that are compared."""
    m = members(handoffs).drop("entities", "tags")
    large = m.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_members).select("group_id")
    return m.join(large, "group_id", "left_semi")


def _listed(dimension: str, values: str) -> Column:
    return F.transform(F.array_distinct(F.coalesce(values, F.array().cast("array<string>"))),
                       lambda v, i: F.struct(F.lit(dimension).alias("dimension"), v.alias("value"), i.alias("idx")))


def compare_groups(handoffs: DataFrame, min_members: int = 2) -> DataFrame:
    """One comparison row per group of at least ``min_members`` captures.

    Columns: ``group_id, n_members, schema_id, summary, same_kind, kinds, shared_entities, shared_tags, similarities,
    differs_in, save_recommendation``; lists are arrays.  ``kinds`` stand in the order of their first members, shared
    values in the order of the first member; ``differs_in`` names what differs (``kind``, ``title``, ``save target``).
    """
    c = F.col
    m = members(handoffs)
    fact = F.array(F.struct(F.lit("member").alias("dimension"), F.lit("").alias("value"), F.lit(0).alias("idx")),
                   F.struct(F.lit("kind").alias("dimension"), c("kind").alias("value"), F.lit(0).alias("idx")))
    rows = m.select("group_id", "pos", "title", "save_target", F.explode(F.concat(fact, _listed("entity", "entities"), _listed("tag", "tags"))).alias("x"))
    own = c("x.dimension") == "member"
    counted = rows.groupBy("group_id", c("x.dimension").alias("dimension"), c("x.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", c("x.idx"))).alias("first"),
        F.min(F.when(own, c("title"))).alias("tmin"), F.max(F.when(own, c("title"))).alias("tmax"),
        F.min(F.when(own, c("save_target"))).alias("smin"), F.max(F.when(own, c("save_target"))).alias("smax"),
        F.bool_or(own & (c("save_target") == "knowledge")).alias("any_knowledge"), F.bool_or(own & (c("save_target") == "memory")).alias("any_memory"))
    of_group = F.max(F.when(c("dimension") == "member", c("n"))).over(Window.partitionBy("group_id"))  # facts and distinct values only
    kept = counted.withColumn("n_members", of_group).where((c("n_members") >= min_members) & (c("dimension").isin("member", "kind") | (c("n") == c("n_members"))))

    def values(dimension: str) -> Column:
        some = F.collect_list(F.when(c("dimension") == dimension, F.struct("first", "value")))
        return F.transform(F.sort_array(some), lambda x: x["value"])

    g = kept.groupBy("group_id").agg(
        F.max("n_members").alias("n_members"), values("kind").alias("kinds"), values("entity").alias("shared_entities"), values("tag").alias("shared_tags"),
        (F.max("tmin") != F.max("tmax")).alias("titles"), (F.max("smin") != F.max("smax")).alias("targets"),
        F.bool_or("any_knowledge").alias("any_knowledge"), F.bool_or("any_memory").alias("any_memory"))
    same = F.size("kinds") == 1
    n = c("n_members").cast("string")
    rec = F.when(c("any_knowledge"), "knowledge").when(c("any_memory"), "memory").otherwise("none")
    return g.select(
        "group_id", "n_members", F.lit(R.COMPARE_SCHEMA).alias("schema_id"),
        F.when(same, F.concat(F.lit("Compared "), n, F.lit(" images of the same kind: "), c("kinds")[0], F.lit(".")))
         .otherwise(F.concat(F.lit("Compared "), n, F.lit(" images across kinds: "), F.array_join(c("kinds"), ", "),
                             F.lit("."))).alias("summary"),
        same.alias("same_kind"), "kinds", "shared_entities", "shared_tags",
        F.array_compact(F.array(
            F.when(same, F.concat(F.lit("all images classified as "), c("kinds")[0])),
            F.when(F.size(c("shared_entities")) > 0,
                   F.concat(F.lit("shared entities: "), F.array_join(c("shared_entities"), ", "))),
            F.when(F.size(c("shared_tags")) > 0, F.concat(F.lit("shared tags: "), F.array_join(c("shared_tags"), ", "))),
        )).alias("similarities"),
        F.array_compact(F.array(F.when(~same, "kind"), F.when(c("titles"), "title"), F.when(c("targets"), "save target"))).alias("differs_in"),
        rec.alias("save_recommendation"),
    )


def with_member_lists(compared: DataFrame, listed: DataFrame) -> DataFrame:
    """G3 and the block's lists: adds ``differences`` and ``compared`` (records with file name, kind, title) to each group.

    ``listed`` is ``compared_members``.  A group's output row holds all its members here, as the text block asks for; use
    the long table for groups that are too large for one row.
    """
    c = F.col
    lists = listed.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("pos", "file_name", "kind", "title", "save_target"))).alias("_m"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("_m", lambda x: x[field]), " vs ")

    differences = F.array_compact(F.array(
        F.when(F.array_contains("differs_in", "kind"), F.concat(F.lit("kind mismatch: "), joined("kind"))),
        F.when(F.array_contains("differs_in", "title"), F.concat(F.lit("titles differ: "), joined("title"))),
        F.when(F.array_contains("differs_in", "save target"), F.concat(F.lit("save targets differ: "), joined("save_target")))))
    records = F.transform("_m", lambda x: F.struct(x["file_name"].alias("file_name"), x["kind"].alias("kind"), x["title"].alias("title")))
    return compared.join(lists, "group_id").withColumn("differences", differences).withColumn("compared", records).drop("_m")


def render_compare() -> Column:
    """The 8-line comparison block of a row of ``with_member_lists``."""
    c = F.col
    records = F.array_join(F.transform("compared", lambda x: F.concat(x["file_name"], F.lit(":"), x["kind"])), " | ")

    def listed(col, sep, empty):
        return F.when(F.size(c(col)) > 0, F.array_join(c(col), sep)).otherwise(F.lit(empty))

    return F.concat_ws(
        "\n",
        F.lit(R.COMPARE_HEADER),
        F.concat(F.lit("Summary: "), c("summary")),
        F.concat(F.lit("SameKind: "), F.when(c("same_kind"), "true").otherwise("false")),
        F.concat(F.lit("Kinds: "), listed("kinds", ", ", "(mixed)")),
        F.concat(F.lit("Similarities: "), listed("similarities", " | ", "(none)")),
        F.concat(F.lit("Differences: "), listed("differences", " | ", "(none)")),
        F.concat(F.lit("SaveRecommendation: "), c("save_recommendation")),
        F.concat(F.lit("Compared: "), records),
    )


MEMBER_ORDER = ("pos", "file_name", "kind", "title", "save_target")


def compare_lines(compared: DataFrame, listed: DataFrame, range_rows: int | None = None) -> DataFrame:
    """G3 and G5 for groups of any size: the block of ``render_compare`` as ``group_id, line_no, piece_no, piece``.

    ``listed`` is ``compared_members``.  A line is its pieces in the order of ``piece_no``, without gaps from 0.  Members are
    numbered by sampled ranges and running counts (``with_positions``), so a group of a third of all rows is many tasks' work.
    """
    from capsight.operators.context import RANGE_ROWS, with_positions
    from capsight.session import write_scratch
    c = F.col
    compared = write_scratch(compared, "compare-lines")

    def text(col: str, sep: str, empty: str) -> Column:
        return F.when(F.size(col) > 0, F.array_join(col, sep)).otherwise(F.lit(empty))

    def line(number: int, label: str, value: Column) -> Column:
        return F.struct(F.lit(number).alias("line_no"), F.lit(0).cast("long").alias("piece_no"), F.concat(F.lit(label), value).alias("piece"))

    none = F.when(F.size("differs_in") == 0, line(6, "Differences: ", F.lit("(none)")))
    fixed = F.array_compact(F.array(
        F.struct(F.lit(1).alias("line_no"), F.lit(0).cast("long").alias("piece_no"), F.lit(R.COMPARE_HEADER).alias("piece")),
        line(2, "Summary: ", c("summary")), line(3, "SameKind: ", F.when(c("same_kind"), "true").otherwise("false")),
        line(4, "Kinds: ", text("kinds", ", ", "(mixed)")), line(5, "Similarities: ", text("similarities", " | ", "(none)")), none,
        line(7, "SaveRecommendation: ", c("save_recommendation"))))
    heads = compared.select("group_id", F.explode(fixed).alias("x")).select("group_id", "x.*")
    placed = with_positions(listed, range_rows or RANGE_ROWS, "group_id", MEMBER_ORDER)
    placed = placed.join(compared.select("group_id", "n_members", "differs_in"), "group_id")
    first = c("position") == 0

    def difference(name: str, label: str, column: str) -> Column:
        at = F.array_position("differs_in", name)  # from 1; 0 where it does not differ
        lead = F.when(first, F.concat(F.when(at == 1, "Differences: ").otherwise(" | "), F.lit(label))).otherwise(" vs ")
        return F.when(at > 0, F.struct(F.lit(6).alias("line_no"), ((at - 1) * c("n_members") + c("position")).cast("long").alias("piece_no"), F.concat(lead, column).alias("piece")))

    record = F.struct(F.lit(8).alias("line_no"), c("position").alias("piece_no"),
                      F.concat(F.when(first, "Compared: ").otherwise(" | "), "file_name", F.lit(":"), "kind").alias("piece"))
    pieces = F.array_compact(F.array(difference("kind", "kind mismatch: ", "kind"), difference("title", "titles differ: ", "title"),
                                     difference("save target", "save targets differ: ", "save_target"), record))
    return heads.unionByName(placed.select("group_id", F.explode(pieces).alias("x")).select("group_id", "x.*"))


SIMILAR = 0.5


def similar_classes(handoffs: DataFrame, at_least: float = SIMILAR) -> DataFrame:
    """Similarity within groups, one row per distinct tag set of a group.

    ``group_id, tags, n_members, n_linked, best_tags, best_similarity``: how many members have the set, with how many other members
    each of them is linked (Jaccard similarity of the tag sets of ``at_least``), and the most similar other set of the group (ties to the
    smaller set in array order; null where none shares a tag).  Members of one set are linked with each other; members without tags
    with nobody.

    Equal sets are one class before anything is compared, so the work depends on the distinct sets (bounded by the tags that the
    rules give), not on the members; classes are written once and meet through the tags they share.
    """
    from capsight.session import write_scratch
    c = F.col
    tags = F.array_sort(F.array_distinct(F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: t.isNotNull())))
    classes = write_scratch(handoffs.select("group_id", tags.alias("tags")).groupBy("group_id", "tags").agg(F.count(F.lit(1)).alias("n_members")), "similar")
    each = classes.select("group_id", "tags", "n_members", F.explode("tags").alias("tag"))
    other = each.select("group_id", "tag", c("tags").alias("other"), c("n_members").alias("n_other"))
    shared = each.join(other, ["group_id", "tag"]).where("tags <> other").groupBy("group_id", "tags", "other", "n_other").agg(F.count(F.lit(1)).alias("common"))
    score = c("common") / (F.size("tags") + F.size("other") - c("common"))
    best = F.min(F.struct((-c("score")).alias("away"), "other"))
    linked = (shared.withColumn("score", score).groupBy("group_id", "tags")
              .agg(F.sum(F.when(c("score") >= at_least, c("n_other")).otherwise(0)).alias("linked"), best.alias("best")))
    out = classes.join(linked, ["group_id", "tags"], "left")
    own = F.when(F.size("tags") > 0, c("n_members") - 1).otherwise(F.lit(0))
    return out.select("group_id", "tags", "n_members", (own + F.coalesce("linked", F.lit(0))).cast("long").alias("n_linked"),
                      c("best.other").alias("best_tags"), (-c("best.away")).alias("best_similarity"))
