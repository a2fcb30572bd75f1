"""The whole run: log -> core contributors -> focal references -> citations -> J -> actual I.

:class:`ReferenceNetwork` has every stage as a DataFrame, built on first access. The raw log is read once, by the first stage
that needs it: :func:`refnet.operators.activity.activity` adds it up by repository and actor, and that table, the core, the
pulls of core actors and a few more that stages share are written once (:class:`refnet.plans.handoff.Store`) and read from
there. What a caller asks for itself stays lazy.

:func:`run_network` executes every stage once into ``out_dir``. Shared tables are bucketed by actor, lineage is cut at each,
rows are counted while they are written, and a run that was killed goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refnet.operators import activity, cites, core, disrupt, refs
from refnet.operators.normalize import normalize_log
from refnet.plans.handoff import Store
from refnet.plans.reduce import reduced
from refnet.plans.skew import hot_keys
from refnet.session import work_dir

STAGES = (
    "core_contributors",
    "core_tenure",
    "focal_refs",
    "focal_edges",
    "focal_counts",
    "distinct_pull_pairs",
    "citations",
    "citation_edges",
    "citation_counts",
    "theta_pair_counts",
    "theta_reference_counts",
    "source_actors",
    "reference_actors",
    "j_edges",
    "j_counts",
    "actual_i_edges",
    "actual_i_counts",
)

BROADCAST_BYTES = 64 << 20  # of the core side of citations_broadcast
CORE_ROW_BYTES = 32  # two ids and a hash table's overhead


class ReferenceNetwork:
    """Every stage of one run over a raw log.

    ``shares`` as in ``refnet.plans.skew``; ``dedup_keys`` are columns that identify an event, if there are any; ``store`` is
    where shared tables go (a fresh folder under ``spark.checkpoint.dir``); ``count_log`` also counts the normalised log.
    """

    def __init__(self, raw: DataFrame, shares: int | None = None, dedup_keys: list[str] | None = None, store: Store | None = None, count_log: bool = False):
        self.raw = raw
        self.shares = shares
        self.dedup_keys = dedup_keys
        self.count_log = count_log
        self._store = store

    @property
    def store(self) -> Store:
        if self._store is None:
            self._store = Store(self.raw.sparkSession, work_dir(self.raw.sparkSession, "network"))
        return self._store

    @property
    def counts(self) -> dict[str, int]:
        """Rows of the tables written so far."""
        return self.store.counts

    @cached_property
    def log(self) -> DataFrame:
        return normalize_log(self.raw, dedup_keys=self.dedup_keys)

    # Shared tables, each written when a stage first needs it -------------------------------------------------
    @cached_property
    def activity(self) -> DataFrame:
        """With ``count_log`` its count, ``activity``, is that of the normalised log, else its number of rows."""
        build = lambda: activity.activity(self.raw, self.dedup_keys, self.count_log)
        return self.store.keep("activity", build, counted="n" if self.count_log else None)

    @cached_property
    def core_table(self) -> DataFrame:
        """(repo_id, actor_id, min_d, max_d) of the core."""
        return self.store.keep("core_table", lambda: self._core, by="actor_id")

    @cached_property
    def core_pulls(self) -> DataFrame:
        """The pull pairs of core actors, all that joins with the core can use."""
        build = lambda: self._of_core(activity.pull_pairs(self.activity).dropna(), ["repo_id"])
        return self.store.keep("core_pulls", build, by="actor_id")

    @cached_property
    def focal_refs(self) -> DataFrame:
        return self.store.keep("focal_refs", lambda: self._focal_refs)

    @cached_property
    def source_actors_table(self) -> DataFrame:
        return self.store.keep("source_actors_table", lambda: self._source_actors, by="actor_id")

    @cached_property
    def destination_pullers(self) -> DataFrame:
        build = lambda: disrupt.destination_pullers(self.focal_edges, self.core_pulls, self.hot_repos)
        return self.store.keep("destination_pullers", build, by="actor_id")

    @cached_property
    def destination_codes(self) -> DataFrame:
        return self.store.keep("destination_codes", lambda: disrupt.repo_codes(self.destination_pullers, "destination_repo_id"))

    @cached_property
    def j_sources(self) -> DataFrame:
        build = lambda: disrupt.j_sources(self.source_actors_table, self.destination_pullers, self.hot_actors)
        return self.store.keep("j_sources", build)

    @cached_property
    def outside_core(self) -> DataFrame:
        return self.store.keep("outside_core", lambda: disrupt.outside_core(self.core_table, self.j_sources, self.hot_repos), by="actor_id")

    @cached_property
    def source_codes(self) -> DataFrame:
        return self.store.keep("source_codes", lambda: disrupt.repo_codes(self.outside_core.dropna(), "cc_repo_id"))

    # Hot keys, counted on the pairs of core rows and core pulls that every join below has a part of -------------
    @cached_property
    def hot_actors(self) -> DataFrame:
        return hot_keys(self.core_pulls, self.core_table, ["actor_id"], self.shares)

    @cached_property
    def hot_repos(self) -> DataFrame:
        return hot_keys(self.core_pulls.select("repo_id").unionAll(self.core_table.select("repo_id")), None, ["repo_id"], self.shares)

    @cached_property
    def hot_pullers(self) -> DataFrame:
        return hot_keys(activity.pull_rows(self.activity), None, ["actor_id"], self.shares)

    def _of_core(self, pulls: DataFrame, salt: list[str]) -> DataFrame:
        """Rows of pull requests by core actors, taken out before any join by pairs."""
        actors = self.core_table.select("actor_id").dropna().distinct()
        return reduced(pulls, actors, "actor_id", self.counts["core_table"], salt, lambda: self.hot_pullers)

    # core ---------------------------------------------------------------------------------------------------
    @cached_property
    def _core(self) -> DataFrame:
        return core.core_by_window(activity.pushes(self.activity)).select("repo_id", "actor_id", "min_d", "max_d")

    @cached_property
    def core_contributors(self) -> DataFrame:
        return self.__dict__.get("core_table", self._core).select("repo_id", "actor_id")

    @cached_property
    def core_tenure(self) -> DataFrame:
        return core.tenure_of(self.__dict__.get("core_table", self._core))

    # references ---------------------------------------------------------------------------------------------
    @cached_property
    def pull_spans(self) -> DataFrame:
        own = activity.pull_rows(self.activity)
        return activity.pull_spans(self._of_core(own, ["repo_id", "at"]))

    @cached_property
    def _focal_refs(self) -> DataFrame:
        return refs.focal_refs_by_times(core.tenure_of(self.core_table), self.pull_spans, self.hot_actors)

    @cached_property
    def focal_edges(self) -> DataFrame:
        return refs.focal_edges(self.focal_refs)

    @cached_property
    def focal_counts(self) -> DataFrame:
        return refs.focal_counts(self.focal_refs)

    # citations ----------------------------------------------------------------------------------------------
    @cached_property
    def distinct_pull_pairs(self) -> DataFrame:
        return activity.pull_pairs(self.activity)

    @cached_property
    def citations(self) -> DataFrame:
        return cites.citations(self.core_table, self.core_pulls, self.hot_actors)

    @cached_property
    def citations_broadcast(self) -> DataFrame:
        """The citations with the core broadcast, if its counted rows are few enough."""
        table = self.core_table
        return cites.citations_within(table, self.core_pulls, CORE_ROW_BYTES * self.counts["core_table"], BROADCAST_BYTES, self.hot_actors)

    @cached_property
    def citation_edges(self) -> DataFrame:
        return cites.citation_edges(self.citations)

    @cached_property
    def citation_counts(self) -> DataFrame:
        return cites.citation_counts(self.core_table, self.core_pulls, self.hot_actors)

    @cached_property
    def theta_pair_counts(self) -> DataFrame:
        return cites.theta_pair_counts(self.core_table, self.core_pulls, self.hot_actors, self.hot_repos)

    @cached_property
    def theta_reference_counts(self) -> DataFrame:
        return cites.theta_reference_counts(self.core_table, self.core_pulls, self.focal_refs, self.hot_actors, self.hot_repos)

    # J and actual I -----------------------------------------------------------------------------------------
    @cached_property
    def _source_actors(self) -> DataFrame:
        sources = disrupt.citing_sources(self.core_table, self.core_pulls, self.hot_actors)
        return disrupt.source_actors(self.core_table, sources, self.hot_repos)

    @cached_property
    def source_actors(self) -> DataFrame:
        return self.__dict__.get("source_actors_table", self._source_actors)

    @cached_property
    def reference_actors(self) -> DataFrame:
        return disrupt.reference_actors(self.focal_edges, self.distinct_pull_pairs)

    @cached_property
    def destination_words(self) -> DataFrame:
        """The destinations that each actor pulled in, as words; a table of its own where tables are bucketed."""
        build = lambda: disrupt.word_sets(self.destination_pullers, self.destination_codes, "destination_repo_id", self.hot_repos)
        return self.store.keep("destination_words", build, by="actor_id") if self.store.buckets else build()

    @cached_property
    def _j_words(self) -> DataFrame:
        return disrupt.unions(disrupt.source_rows(self.source_actors_table), "focal_repo_id", self.destination_words, self.hot_actors)

    @cached_property
    def j_words(self) -> DataFrame:
        """J as words of destinations by source."""
        return self.store.keep("j_words", lambda: self._j_words)

    @cached_property
    def j_edges(self) -> DataFrame:
        return disrupt.j_edges_by_words(self.j_words, self.destination_codes, hot_keys(self.j_words, None, ["word"], self.shares))

    @cached_property
    def j_counts(self) -> DataFrame:
        return disrupt.union_sizes(self.__dict__.get("j_words", self._j_words), "focal_repo_id", "J_Count")

    @cached_property
    def actual_i_edges(self) -> DataFrame:
        return disrupt.actual_i_edges_of(self.outside_core, self.core_pulls, self.hot_actors)

    @cached_property
    def actual_i_counts(self) -> DataFrame:
        words = disrupt.word_sets(self.outside_core, self.source_codes, "cc_repo_id", self.hot_repos)
        return disrupt.actual_i_counts_by_words(self.outside_core, self.core_pulls, words, self.hot_actors)

    def stages(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAGES}


def run_signature(raw: DataFrame, **settings) -> str:
    """Tells runs apart: the log's files and columns, and the settings."""
    files = hashlib.sha256("\n".join(sorted(raw.inputFiles())).encode()).hexdigest()
    return hashlib.sha256(json.dumps([files, raw.schema.jsonValue(), settings], sort_keys=True).encode()).hexdigest()


def run_network(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    shares: int | None = None,
    dedup_keys: list[str] | None = None,
    skip: tuple[str, ...] = (),
    resume: bool = False,
    count_log: bool = False,
    buckets: int | None = None,
    after: Callable[[str], None] | None = None,
) -> ReferenceNetwork:
    """Execute the run stage by stage into ``out_dir`` (one sub-folder per stage); returns the network, whose ``counts`` has
    the rows of all it has written.

    The log is read once. Reused tables are Parquet, bucketed by actor (into ``buckets``, the number of
    shuffle partitions unless given), so types survive any ``fmt``. ``skip`` leaves out outputs. With ``resume`` whole tables and
    outputs of an earlier run over the same log into the same folder are taken as they are. ``after`` is called with the name
    of each table or output (``out-`` before it) when it is whole.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    signature = run_signature(raw, fmt=fmt, shares=shares, dedup_keys=dedup_keys, count_log=count_log)
    store = Store(spark, out_dir, buckets=buckets, resume=resume, signature=signature, after=after)
    net = ReferenceNetwork(raw, shares, dedup_keys, store, count_log)
    _ = net.core_table  # written before the stages that are parts of it
    for name in STAGES:
        if name not in skip:
            if name == "source_actors":
                _ = net.source_actors_table
            store.publish(name, lambda name=name: getattr(net, name), fmt)
    return net


def stage_counts(net: ReferenceNetwork) -> DataFrame:
    """(stage, rows) of the four stages that the survey counts (D8), observed while the run's tables were written: the
    normalised log (of a network with ``count_log``), the core, the focal references and the pull pairs."""
    _ = net.activity, net.core_table, net.focal_refs
    pairs = net.store.keep("pull_pairs", lambda: net.distinct_pull_pairs)
    names = {"normalized_log": "activity", "core_contributors": "core_table", "focal_refs": "focal_refs", "distinct_pull_pairs": "pull_pairs"}
    lines = F.array(*(F.struct(F.lit(stage).alias("stage"), F.lit(net.counts[table]).cast("long").alias("rows")) for stage, table in names.items()))
    return pairs.sparkSession.range(1).select(F.inline(lines))
