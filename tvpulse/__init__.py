"""tvpulse: Spark-native analytics for TV viewing intervals.

Loads per-station interval logs, cleans them, builds device-by-day and
minute-by-minute audience marts, checks every stage with data-quality queries,
answers reach / viewing-time / trend / peak / prediction questions, folds
overlapping intervals, trains and explains a device classifier with MLlib and
ranks texts by similarity. Every operator takes and returns DataFrames.
"""

from tvpulse import schemas  # noqa: F401
