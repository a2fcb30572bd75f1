"""The SQL surface (survey A9): publish stages as temp views and as table functions, and query them with ``spark.sql``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(stages: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """``createOrReplaceTempView`` for each stage; returns the view names. Views are session-scoped."""
    names = []
    for name, df in stages.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def sql_focal_counts(spark: SparkSession, refs_view: str = "focal_refs") -> DataFrame:
    """References per focal repository, as SQL text over a registered view."""
    return spark.sql(
        f"SELECT focal_repo_id, COUNT(*) AS count_focal_repo_id FROM {refs_view} GROUP BY focal_repo_id"
    )


def register_functions(spark: SparkSession, stages: Mapping[str, DataFrame], prefix: str = "refnet_") -> list[str]:
    """Each stage as a table function ``<prefix><stage>(repo)`` of the session, over one registration of all their views.

    Called without an argument it gives the stage's rows, with a repository those whose first column is that one, a filter
    that Spark pushes into the stage. Functions combine in SQL like tables, and in each other's bodies.
    """
    views = register_views(stages, f"{prefix}view_")
    names = []
    for (stage, df), view in zip(stages.items(), views, strict=True):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        key = df.schema[0]
        listed = ", ".join(f"v.`{c}`" for c in df.columns)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{stage}(only_repo {key.dataType.simpleString()} DEFAULT NULL) RETURNS TABLE ({columns}) "
            f"RETURN SELECT {listed} FROM {view} v WHERE only_repo IS NULL OR v.`{key.name}` = only_repo"
        )
        names.append(f"{prefix}{stage}")
    return names


def sql_repo_profile(spark: SparkSession, prefix: str = "refnet_") -> DataFrame:
    """(focal_repo_id, references, citing_sources, outside): of each focal repository how many repositories it references, how
    many cite it, and how many of these are outside J; three stages put together in SQL alone."""
    return spark.sql(f"""
        WITH cited AS (
          SELECT focal_repo_id, count(DISTINCT source_repo_citing_focal_repo) AS citing_sources FROM {prefix}citation_edges() GROUP BY focal_repo_id),
        outside AS (SELECT focal_repo_id, count(*) AS outside FROM {prefix}actual_i_edges() GROUP BY focal_repo_id)
        SELECT r.focal_repo_id, count(*) AS `references`, coalesce(any_value(c.citing_sources), 0) AS citing_sources, coalesce(any_value(o.outside), 0) AS outside
        FROM {prefix}focal_refs() r LEFT JOIN cited c ON c.focal_repo_id = r.focal_repo_id LEFT JOIN outside o ON o.focal_repo_id = r.focal_repo_id
        GROUP BY r.focal_repo_id""")
