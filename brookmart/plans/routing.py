"""Plans that follow run-time rules."""
from __future__ import annotations

from brookmart.operators.rules import (current_rules, dim_changes, match_rules, merge_cells,
                                       project_by_rule, routed_payload)


def dim_sync(ods, rule_changes, database, order="seq"):
    """Current dimension rows: valid changes, selected by rule, merged cell by cell."""
    rules = current_rules(rule_changes, ["source_table"], "seq")
    return merge_cells(dim_changes(ods, rules, database, order), order)


def route_facts(ods, rule_changes):
    """(topic, value) of row changes that a (table, type) rule selects."""
    rules = current_rules(rule_changes, ["source_table", "source_type"], "seq")
    return routed_payload(project_by_rule(match_rules(ods, rules, ["table", "type"])))
