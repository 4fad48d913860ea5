"""All registered queries of the warehouse: its own rules and the opt-in mechanisms."""

from flightmart.plans import scenario, scenario_options

QUERIES = scenario.QUERIES | scenario_options.QUERIES
