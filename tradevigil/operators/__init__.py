"""DataFrame operators: joins, features, investigation tables, graph, model, reports."""
