"""Operators on document tables: clauses, ranking, facets, paging, lookups, writes."""
