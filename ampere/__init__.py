"""ampere: Spark-native pipeline for monthly electricity statistics.

Layers follow the pipeline: landing JSON -> raw (payload, source_file,
ingested_at) -> staging (typed, deduplicated, upserted) -> marts (rolling
z-score, fuel shares, demand profiles) -> flat exports and quality reports.
Every operator is a DataFrame -> DataFrame function; nothing is collected
to the driver except bounded scalars (row counts, one pointer row).
"""

__version__ = "0.1.0"
