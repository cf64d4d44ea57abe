"""Tables to triples, and the queries that browse them."""
