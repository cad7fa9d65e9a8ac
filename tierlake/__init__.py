"""tierlake: a yearly-survey data lake (raw text -> bronze -> silver -> gold) and its
analyses, as plain PySpark DataFrame functions."""

from tierlake.spec import DOCUMENTS_SPEC, EXAM_SPEC, LINEITEM_SPEC, CsvDialect, LakeSpec, year_from_name

__all__ = ["CsvDialect", "DOCUMENTS_SPEC", "EXAM_SPEC", "LINEITEM_SPEC", "LakeSpec", "year_from_name"]
