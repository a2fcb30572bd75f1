"""J and actual I (survey G11-G16, C6-C9).

* source actors: core contributors (S, a) of every citing repository S; output (S, S, a).
* reference actors: (F, D, a) for each focal edge F -> D and each actor a with a pull-request event in D.
* J: (S, S, D) when a core contributor of citing repository S pulled in a repository D that is the destination of
  some focal edge. The focal column repeats the source (the survey takes it from the source-actor side).
* actual I: citation edges whose source repository never appears in J, de-duplicated.

J and actual I only use the reference actors' (D, a) columns, so they are planned on semi-joins: the destinations
reduce the pull pairs, the citing sources reduce the core set, and the sources that make it into J are found without
building J. Counts need no pairs either: repositories are coded as bits of 64-bit words, an actor's set is a few words, and a
repository's count is the number of bits of its actors' words joined by "or" (:func:`word_sets`, :func:`union_counts`); the
words of popular repositories, which occur together, fill up and are combined before they are shuffled. Only :func:`j_edges` itself forms (S, D) pairs, and it emits them de-duplicated. Right sides of semi- and
anti-joins are sets, and a hot key's left rows are dealt over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.operators.cites import citation_edges, citations, core_rows
from refnet.plans.skew import balanced_join


def citing_sources(core: DataFrame, pull_pairs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(repo_id): repositories with at least one citation, without the citation table.

    S cites something iff a core actor a of S pulled in some repository other than S, i.e. a's number of pulled
    repositories minus [a pulled in S] is positive.
    """
    rows, pairs = core_rows(core).dropna(), pull_pairs.dropna().select("repo_id", "actor_id")
    pulled = pairs.groupBy("actor_id").agg(F.count(F.lit(1)).alias("pulled"))
    own = pairs.select(F.col("repo_id").alias("cc_repo_id"), "actor_id", F.lit(1).alias("own"))
    scored = balanced_join(rows, pulled, ["actor_id"], "left", hot=hot).join(own, ["cc_repo_id", "actor_id"], "left")
    citing = scored.filter(F.col("pulled") - F.coalesce(F.col("own"), F.lit(0)) > 0)
    return citing.select(F.col("cc_repo_id").alias("repo_id")).distinct()


def _named(hot: DataFrame | None, key: str) -> DataFrame | None:
    return None if hot is None else hot.withColumnRenamed("repo_id", key)


def source_actors(core: DataFrame, sources: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, source_repo_citing_focal_repo, actor_id): core rows of the repositories ``sources`` (a set in
    ``repo_id``)."""
    kept = balanced_join(core_rows(core), sources.select(F.col("repo_id").alias("cc_repo_id")), ["cc_repo_id"], "left_semi", hot=_named(hot, "cc_repo_id"))
    return kept.select(
        F.col("cc_repo_id").alias("focal_repo_id"),
        F.col("cc_repo_id").alias("source_repo_citing_focal_repo"),
        "actor_id",
    )


def reference_actors(f_edges: DataFrame, pull_pairs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, destination_repo_id, actor_id): focal edges JOIN pull pairs ON destination = repo (survey C7).

    Both inputs are sets and the output keeps all three columns, so no distinct is needed.
    """
    edges = f_edges.select("focal_repo_id", "destination_repo_id")
    pairs = pull_pairs.select(F.col("repo_id").alias("destination_repo_id"), "actor_id")
    return balanced_join(pairs, edges, ["destination_repo_id"], hot=_named(hot, "destination_repo_id")).select("focal_repo_id", "destination_repo_id", "actor_id")


def destination_pullers(f_edges: DataFrame, pull_pairs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(destination_repo_id, actor_id): pull pairs in repositories that some focal edge points to."""
    destinations = f_edges.select("destination_repo_id").distinct()
    pairs = pull_pairs.filter(F.col("actor_id").isNotNull()).select(F.col("repo_id").alias("destination_repo_id"), "actor_id")
    return balanced_join(pairs, destinations, ["destination_repo_id"], "left_semi", hot=_named(hot, "destination_repo_id"))


def j_edges(src_actors: DataFrame, dest_pullers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, source_repo_citing_focal_repo, destination_repo_id): J, a set (survey C8, G13).

    ``dest_pullers`` is :func:`destination_pullers`, the (D, a) columns of the reference actors without repeats.
    """
    sources = src_actors.select(F.col("source_repo_citing_focal_repo").alias("src"), "actor_id").dropna()
    pullers = dest_pullers.select("destination_repo_id", "actor_id").dropna()
    joined = balanced_join(pullers, sources, ["actor_id"], hot=hot)
    return joined.select(
        F.col("src").alias("focal_repo_id"),
        F.col("src").alias("source_repo_citing_focal_repo"),
        "destination_repo_id",
    ).distinct()


def j_counts(j: DataFrame) -> DataFrame:
    """(focal_repo_id, J_Count)."""
    return j.groupBy("focal_repo_id").agg(F.count(F.lit(1)).alias("J_Count"))


def j_sources(src_actors: DataFrame, dest_pullers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(repo_id): sources that appear in J, found with a semi-join on the actor (no (S, D) pairs)."""
    actors = dest_pullers.select("actor_id").dropna().distinct()
    sources = src_actors.select(F.col("source_repo_citing_focal_repo").alias("repo_id"), "actor_id")
    return balanced_join(sources, actors, ["actor_id"], "left_semi", hot=hot).select("repo_id").distinct()


def actual_i_edges(core: DataFrame, pull_pairs: DataFrame, in_j: DataFrame, hot_actors: DataFrame | None = None, hot_repos: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, source_repo_citing_focal_repo, destination_focal_repo): citation edges whose source is not in J
    (``in_j`` holds J's sources in ``repo_id``)."""
    return actual_i_edges_of(outside_core(core, in_j, hot_repos), pull_pairs, hot_actors)


def actual_i_edges_of(outside: DataFrame, pull_pairs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """:func:`actual_i_edges` from :func:`outside_core`: only citations of the remaining sources are formed, and de-duplicated
    to (F, S, F)."""
    return citation_edges(citations(outside, pull_pairs, hot)).distinct()


def actual_i_counts(ai: DataFrame) -> DataFrame:
    """(focal_repo_id, count)."""
    return ai.groupBy("focal_repo_id").agg(F.count(F.lit(1)).alias("count"))


def repo_codes(members: DataFrame, key: str) -> DataFrame:
    """(key, code): a number for each repository of ``members`` (key, actor_id), those with the most actors first, without
    long gaps. Write the result before it is used: numbers follow the order of a run."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.orderBy(F.desc("_n"), key).select(key, F.monotonically_increasing_id().alias("code"))


def word_sets(members: DataFrame, codes: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """(actor_id, word, bits): the repositories ``key`` of each actor of ``members`` (key, actor_id), a bit for each code."""
    coded = balanced_join(members.select(key, "actor_id").dropna(), codes, [key], "left", left_salt=["actor_id"], hot=_named(hot, key)).filter("code is not null")
    bit = F.expr("shiftleft(1L, CAST(code & 63 AS INT))")
    return coded.groupBy("actor_id", F.shiftright("code", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def unions(rows: DataFrame, key: str, words: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(key, word, bits): for each ``key`` of ``rows`` (key, actor_id) the union of its actors' sets."""
    met = balanced_join(rows.select(key, "actor_id").dropna(), words, ["actor_id"], left_salt=[key], right_salt=["word"], hot=hot)
    return met.groupBy(key, "word").agg(F.bit_or("bits").alias("bits"))


def union_sizes(united: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the sizes of :func:`unions`."""
    return united.groupBy(key).agg(F.sum(F.bit_count("bits").cast("long")).alias(name))


def union_counts(rows: DataFrame, key: str, words: DataFrame, name: str, hot: DataFrame | None = None) -> DataFrame:
    """(key, name): for each ``key`` of ``rows`` (key, actor_id) the size of the union of its actors' sets."""
    return union_sizes(unions(rows, key, words, hot), key, name)


def spelled(united: DataFrame, codes: DataFrame, key: str, member: str, hot: DataFrame | None = None) -> DataFrame:
    """(key, member): the members of :func:`unions`, each pair once. ``hot`` are words that very many unions have."""
    names = codes.groupBy(F.shiftright("code", 6).alias("word")).agg(F.collect_list(F.struct(F.expr("CAST(code & 63 AS INT)").alias("bit"), F.col(member).alias("name"))).alias("_names"))
    met = balanced_join(united, names, ["word"], "left", left_salt=[key], hot=hot)
    inside = F.expr("transform(filter(_names, m -> shiftright(bits, m.bit) & 1 = 1), m -> m.name)")
    return met.select(key, F.explode(inside).alias(member))


def source_rows(src_actors: DataFrame) -> DataFrame:
    return src_actors.select(F.col("source_repo_citing_focal_repo").alias("focal_repo_id"), "actor_id")


def j_counts_by_words(src_actors: DataFrame, words: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, J_Count): J's destinations per source as the union of its actors' words of destinations."""
    return union_counts(source_rows(src_actors), "focal_repo_id", words, "J_Count", hot)


def j_edges_by_words(united: DataFrame, codes: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """J from the :func:`unions` of its sources' words."""
    pairs = spelled(united, codes, "focal_repo_id", "destination_repo_id", hot)
    return pairs.select("focal_repo_id", F.col("focal_repo_id").alias("source_repo_citing_focal_repo"), "destination_repo_id")


def outside_core(core: DataFrame, in_j: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(cc_repo_id, actor_id): core rows of the repositories that are no source in J."""
    gone = in_j.select(F.col("repo_id").alias("cc_repo_id"))
    return balanced_join(core_rows(core), gone, ["cc_repo_id"], "left_anti", hot=_named(hot, "cc_repo_id"))


def actual_i_counts_by_words(outside: DataFrame, pull_pairs: DataFrame, words: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, count): sources outside J per focal repository, from ``outside`` (:func:`outside_core`) and its words of
    sources; a repository that one of its own core actors pulled in is among them and doesn't count."""
    pairs = pull_pairs.dropna().select(F.col("repo_id").alias("focal_repo_id"), "actor_id")
    unions = union_counts(pairs, "focal_repo_id", words, "_all", hot)
    itself = outside.dropna().select(F.col("cc_repo_id").alias("focal_repo_id"), "actor_id").join(pairs, ["focal_repo_id", "actor_id"], "left_semi")
    own = itself.select("focal_repo_id").distinct().withColumn("_own", F.lit(1))
    counts = unions.join(own, "focal_repo_id", "left").select("focal_repo_id", (F.col("_all") - F.coalesce("_own", F.lit(0))).alias("count"))
    return counts.filter(F.col("count") > 0)
