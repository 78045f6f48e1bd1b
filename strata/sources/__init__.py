"""Sources and sinks: history, changesets, candidates, rules, geo files."""
