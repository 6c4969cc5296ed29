"""lexis — a PySpark-native toolkit for profiling, cleaning, featurising,
splitting, classifying and evaluating large collections of labelled text.

Layout
------
functions/  Column -> Column expressions (regex cleaning steps, label codecs)
operators/  DataFrame -> DataFrame operators (pipelines, packing, splits,
            profiles, features, models, metrics)
sources/    table loading, derived views, log parsing, file round trips
plans/      the query catalogue used by the driver contract + DuckDB oracles
streaming/  the file-driven scoring stream
"""

from lexis.session import get_session, scratch_path  # noqa: F401
