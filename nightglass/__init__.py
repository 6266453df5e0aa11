"""Security detections on Spark: rules over events, and analytics over the rule corpus."""

from nightglass.operators.changelog import change_rows as history
from nightglass.operators.detect import detect
from nightglass.operators.expect import check
from nightglass.operators.lint import lint
from nightglass.operators.rules import Profile, compile_rules, rules_table
from nightglass.operators.validate import validate
from nightglass.streaming.streams import detect_stream

__all__ = ["Profile", "check", "compile_rules", "detect", "detect_stream", "history", "lint", "rules_table", "validate"]
