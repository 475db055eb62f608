"""sparkfold: fit/apply feature steps, folds, metrics, searches and blends as Spark jobs.

Every fitted step is a pair: ``fit(df, ...)`` returns a statistics DataFrame,
``apply(df, stats)`` adds columns.  Nothing is collected except bounded
statistics (a row count, a grid of at most a few hundred points).
"""

from sparkfold.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
