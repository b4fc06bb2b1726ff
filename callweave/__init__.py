"""Call and outcome linkage on Spark: interval matching, validity lookups, best-row
dedupe, schema harmonisation, rate reports and rerunnable slice writes."""
