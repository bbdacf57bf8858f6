from dqflow.functions.rules import (
    RULES,
    RuleEntry,
    build_predicate,
    param_hints,
    parse_entry,
    register_rule,
    rule_names,
)

__all__ = ["RULES", "RuleEntry", "build_predicate", "param_hints", "parse_entry", "register_rule", "rule_names"]
