"""All registered queries with the SQL that checks them."""

from textspark.registry import features, graph, labels, models, roundtrips, softmax, text

MODULES = (text, labels, features, softmax, graph, models, roundtrips)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: check for module in MODULES for name, check in module.ORACLES.items()}
