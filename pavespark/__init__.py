"""pavespark: road-condition survey processing as Spark DataFrame operators.

Every operator is a DataFrame -> DataFrame function. The run name
(``file_name``) is carried on every row and is part of every join key,
window partition and group key, so any number of survey runs is processed
in one job.

Sub-packages:
  sources    exported survey tables, fixed schemas, fixtures from driver data
  functions  column expressions (predicates, code decoding, padding, clamp)
  operators  range joins, islands, ordered windows, polyline geometry, repairs
  plans      stage tables, QA reports, deliverables, the end-to-end stage chain

Entry points: ``plans.stages.SurveyStages`` (all stages, in order, each written
once), ``python -m pavespark`` (tables in, deliverables out), and
``__spark_entry__.py`` at the repository root (registered queries).
"""

from pavespark.session import get_spark, materialize  # noqa: F401
