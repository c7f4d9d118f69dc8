"""Plan building blocks shared by the operators: ordering, joins and stored tables."""
