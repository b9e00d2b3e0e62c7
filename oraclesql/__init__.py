"""Independent DuckDB SQL for every registered query (the correctness oracle).

``with_entities(sql)`` prefixes a query with the entity CTEs it references
(and their dependencies); the CTE text mirrors FIXTURES.md section 4.
"""

from oraclesql.entities import with_entities  # noqa: F401
