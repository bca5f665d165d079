"""Data-quality ETL on Spark: check, separate, transform and load tables."""

from .operators.rules import Expectation, ExpectationResult, RuleSet, ValidationReport
from .operators.split import split
from .operators.transforms import apply_steps, register_transform
from .operators.validate import register_expectation, register_row_rule, validate
from .plans.stage import Places, Stage, run_pipeline, run_stage, stages_from_config
from .session import build_session, clear_intermediates
from .sinks.tables import Table
from .sources import Source, extract, register_source

__all__ = [
    "Expectation", "ExpectationResult", "Places", "RuleSet", "Source", "Stage", "Table",
    "ValidationReport", "apply_steps", "build_session", "clear_intermediates", "extract",
    "register_expectation", "register_row_rule", "register_source", "register_transform", "run_pipeline", "run_stage",
    "split", "stages_from_config", "validate",
]
