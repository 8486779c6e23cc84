"""reelstar — video-engagement analytics on Spark.

Lands paged engagement events incrementally against a per-media high-water
mark, removes redelivered events deterministically, keeps the latest
metadata / statistics / visitor attributes per key and builds a star schema
(``dim_media``, ``dim_visitor``, ``fact_media_engagement``) with analytics,
data-quality and profiling queries on top. Everything is DataFrame / Spark SQL;
there are no Python UDFs.
"""

from reelstar.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
