from .index_run import IndexSettings, IndexTables, SurveyTables, haul_metrics, run_index, score_hauls, survey_counts, survey_hauls

__all__ = [
    "IndexSettings",
    "IndexTables",
    "SurveyTables",
    "haul_metrics",
    "run_index",
    "score_hauls",
    "survey_counts",
    "survey_hauls",
]
