"""Row rules, joins, aggregates and views over event frames."""
