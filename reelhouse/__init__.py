"""Layered (bronze, silver, gold) film-log analytics on Spark DataFrames.

Main entry points::

    from reelhouse import run, build, check_layers        # the layered run (K7, K8, Q4)
    from reelhouse.plans.silver import silver_ratings     # D1-D6, one builder per dataset
    from reelhouse.plans.gold import gold_best_movie_year # G1-G6
    from reelhouse.operators.checks import run_checks     # declared data checks
    from reelhouse.sources import raw, bronze, ingest     # raw zone, bronze loads, uploads
"""

__version__ = "0.1.0"

from reelhouse.plans.run import build, check_layers, run  # noqa: E402

__all__ = ["build", "check_layers", "run", "__version__"]
